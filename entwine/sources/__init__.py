"""Scans, sinks and file layout."""
