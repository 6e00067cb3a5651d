"""Memory of Python workers."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa


def freed() -> None:
    """Memory that is no longer used goes back to the system, which a worker's allocators would keep for its next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)
