"""Small files (reports, metadata) in any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(path: str):
    spark = SparkSession.getActiveSession()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(path: str) -> bool:
    fs, where = _at(path)
    return fs.exists(where)


def write_text(path: str, text: str) -> None:
    """Replaces the file; it is there with the new text or not at all."""
    fs, where = _at(path)
    fs.mkdirs(where.getParent())
    aside = _at(f"{path}.new")[1]
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(where, False)
    fs.rename(aside, where)


def read_text(path: str) -> str | None:
    """None if there is no such file."""
    fs, where = _at(path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        size = fs.getFileStatus(where).getLen()
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def list_names(path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, where = _at(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []
