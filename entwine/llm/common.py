"""Shared helpers: reading tables, cutting lineage in the shared folder, vectorised words."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at once by the numpy operators; bounds a worker's memory.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session may fall back to a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
        found = tempfile.mkdtemp(prefix="entwine-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_folders: set[str] = set()


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: later steps neither recompute it nor depend on one executor."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/entwine-{spark.sparkContext.applicationId}"
    if folder not in _folders:  # goes with the application, since what reads it is lazy
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
        _folders.add(folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


#: Bits of a sieve: 8 MB, whatever goes in.
SIEVE_BITS = 26


def bitmap(hashes: DataFrame, bits: int = SIEVE_BITS) -> np.ndarray:
    """Words of a bitmap in which the upper bits of each hash (the one column of hashes, a long) are marked."""
    bit = hashes.select(F.shiftrightunsigned(hashes.columns[0], 64 - bits).alias("bit"))
    words = bit.groupBy(F.expr("cast(shiftright(bit, 5) as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(bit, 32) as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def in_bitmap(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (as unsigned) are marked."""
    bit = hashes >> np.uint64(64 - (len(words).bit_length() - 1 + 5))
    return (words[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1 == 1


def sieve(keys: DataFrame) -> Callable[[Column], Column]:
    """A test of a column for being among the keys (one column): never false for a key, seldom true for another value. It
    keeps rows out of a join before they are dealt; what it lets through too much the join drops. Null is no key."""
    kind = keys.dtypes[0][1]
    sent = keys.sparkSession.sparkContext.broadcast(bitmap(keys.select(F.xxhash64(keys.columns[0]).alias("h")).filter(F.col(keys.columns[0]).isNotNull())))

    @F.arrow_udf("boolean")
    def marked(h: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(sent.value, h.to_numpy(zero_copy_only=False).view(np.uint64)))

    return lambda column: column.isNotNull() & marked(F.xxhash64(column.cast(kind)))


def give_back() -> None:
    """Return what a worker has freed to the system: workers outlive their tasks, and an executor has several."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


_held: dict[object, object] = {}


def held(name: object, make: Callable[[], object]) -> object:
    """What make() gives, kept by a worker for its next tasks, and only until it needs a thing of another name."""
    if name not in _held:
        let_go()
        _held[name] = make()
    return _held[name]


def let_go() -> None:
    """What a worker keeps for the tasks of one operator is not kept while it works for another."""
    if _held:
        _held.clear()
    give_back()


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def string_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `limit` bytes (one longer row alone): first row, end row, their bytes, offsets from 0. Null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at, n = 0, len(column)
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, end, buf[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def _separators(keep: str) -> np.ndarray:
    out = np.zeros(256, bool)
    if keep == "space":
        out[[9, 10, 11, 12, 13, 32]] = True
    else:
        out[:128] = [not chr(i).isalnum() for i in range(128)]
    return out


SPACE, NON_WORD = _separators("space"), _separators("word")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256).astype(np.uint64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, min(2 * len(_powers[0]), CHUNK_BYTES + 2) if _powers else 1 << 16)
        _powers[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, p, np.uint64)]) for p in (_P, _P_INV)]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def spans(buf: np.ndarray, offs: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of other bytes than separators, within rows."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[start:end] for all spans at once, from prefix sums of a polynomial."""
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class WordCache:
    """A value for each of many 64-bit hashes, in a table of fixed size: a newer hash replaces an older one in its place."""

    def __init__(self, bits: int = 20):
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.float32)

    def get(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, and which of the hashes have none."""
        at = (hashes >> self.shift).astype(np.int64)
        return self.values[at], self.keys[at] != hashes

    def put(self, hashes: np.ndarray, values: np.ndarray) -> None:
        at = (hashes >> self.shift).astype(np.int64)
        self.keys[at] = hashes
        self.values[at] = values
        lost = self.keys[at] != hashes  # two new hashes in one place: the last key stays, and so must its value
        self.values[at[~lost]] = values[~lost]
