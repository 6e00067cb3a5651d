"""Removal of repeated substrings by merged Burrows-Wheeler transforms.

A byte goes if a substring of LENGTH bytes that covers it also starts anywhere else in the corpus. Every such
substring (window) has an anchor: the leftmost of its GRAM-byte grams with the smallest hash. Equal windows
have equal anchors, so the corpus falls apart into buckets by anchor that never share a window:

1. Anchors with the HALF bytes before them, and with those behind them, are counted over distinct texts; every
   window holds one of the two. Those that recur are marked in a bitmap of fixed size; a bit shared by chance
   only lets more through, never less.
2. Runs of windows with one anchor and a marked side become pieces (the bytes that the run spans). Equal pieces
   are counted as one before they are dealt out, so a passage of a third of all texts costs one piece.
   A bucket of more than BLOCK_BYTES falls apart once more: windows are told by where the anchor stands in them, in
   steps of CLASS bytes, and by the bytes that all such windows have. Equal windows stay together, and a group of
   many variants of one passage is dealt to many tasks.
3. A bucket's pieces are split into shards; each shard gets its transform, the transforms are merged by
   interleave refinement, and the runs of LENGTH common bytes that hold two places or more are the repeats.
4. The repeated places go back to the texts, are joined into spans there, and the rest is kept.

Texts of which there are exact copies, by 128 bits, are repeated as a whole; their copies count once in steps 1 to 3,
where 64 bits tell texts apart (a chance equality could only matter between two texts that share a passage).

Texts are UTF-8 bytes; a null text is empty. Matches never cross texts. Texts under LENGTH bytes lose nothing.
Repeated rows (same id and text) are copies of each other. Windows are judged on the input. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import repeated
from .common import bitmap, in_bitmap, materialize, mix, powers, sieve, string_chunks

LENGTH, GRAM = 200, 32
HALF = (LENGTH - GRAM) // 2
#: Bytes of whole buckets that are merged at once; a larger bucket falls apart first.
BLOCK_BYTES = 1 << 19
#: Places of the anchor in a window that count as one; bytes around the anchor that all such windows have.
CLASS = 24
SURE = LENGTH - CLASS + 1

_BYTE = np.random.default_rng(31).integers(1, 1 << 63, 256).astype(np.uint64)


class _Runs:
    """Runs of windows with one anchor: row, first window and end (from the row's start), the anchor's hash; and
    for the windows that reach HALF bytes or more before (L) and behind (R) the anchor the hash of these bytes
    and the anchor, which equal windows share, and where they end or begin."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.n = 0
        if len(buf) < LENGTH:
            return
        up, down = powers(len(buf) + 1)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[: len(buf)], out=total[1:])
        grams = len(buf) - GRAM + 1
        hashes = mix((total[GRAM:] - total[:-GRAM]) * down[:grams])
        # the upper bits of the hash, then the place: the smallest is the leftmost of the smallest
        value = (hashes & ~np.uint64((1 << 28) - 1)) | np.arange(grams, dtype=np.uint64)
        width, span = LENGTH - GRAM + 1, 1
        while 2 * span <= width:
            value = np.minimum(value[:-span], value[span:])
            span *= 2
        if span < width:
            value = np.minimum(value[: len(value) - (width - span)], value[width - span :])
        anchor = (value & np.uint64((1 << 28) - 1)).astype(np.int64)
        row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(anchor)]
        windows = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= offs[row + 1])
        if not len(windows):
            return
        anchor, row = anchor[windows], row[windows]
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
        last = np.r_[first[1:], len(windows)] - 1
        at, self.row = anchor[first], row[first]
        low = offs[self.row]
        self.n, self.first, self.end, self.bucket = len(first), windows[first] - low, windows[last] + 1 - low, hashes[at]
        self.at = at - low
        self.middle = at - HALF - low  # the window that reaches HALF bytes to both sides
        has = self.first <= self.middle, self.end > self.middle
        begin = np.where(has[0], at - HALF, 0), np.where(has[1], at, 0)
        size = HALF + GRAM
        self.sides = [(h, mix((total[x + size] - total[x]) * down[x] + np.uint64(k + 1))) for k, (h, x) in enumerate(zip(has, begin, strict=True))]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text, F.octet_length(text)).alias("th"), text.alias("text"))


def marked_anchors(texts: DataFrame) -> np.ndarray:
    """Bitmap of the anchors that occur in two distinct texts, or twice in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            th = batch.column(0).to_numpy()
            for at, _, buf, offs in string_chunks(batch.column(1)):
                runs = _Runs(buf, offs)
                if runs.n:
                    h = np.concatenate([h[has] for has, h in runs.sides])
                    row = np.concatenate([runs.row[has] for has, _ in runs.sides])
                    order = np.lexsort((h, row))
                    h, row = h[order], row[order]
                    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
                    twice = np.diff(np.r_[first, len(h)]) > 1
                    yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(th[at + row[first]]), pa.array(twice)], ["h", "th", "twice"])

    found = texts.select("th", "text").mapInArrow(run, "h long, th long, twice boolean")
    some = found.groupBy("h").agg(F.min("th").alias("a"), F.max("th").alias("b"), F.max("twice").alias("twice")).filter("twice or a <> b")
    return bitmap(some.select("h"))


def pieces(texts: DataFrame, marks: np.ndarray) -> DataFrame:
    """(id, th, start, at, bucket, piece): the runs of windows whose anchor is marked; at: the anchor's place in the piece."""
    sent = texts.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            for at, _, buf, offs in string_chunks(batch.column(2)):
                runs = _Runs(buf, offs)
                if not runs.n:
                    continue
                marked = []
                for has, h in runs.sides:
                    marked.append(has & in_bitmap(bits, h))
                first = np.where(marked[0], runs.first, np.maximum(runs.first, runs.middle))
                end = np.where(marked[1], runs.end, np.minimum(runs.end, runs.middle + 1))
                keep = np.flatnonzero((marked[0] | marked[1]) & (first < end))
                row, first, end, h, anchor = runs.row[keep], first[keep], end[keep], runs.bucket[keep], runs.at[keep]
                for k in range(0, len(row), 5000):
                    part = slice(k, k + 5000)
                    low = offs[row[part]] + first[part]
                    size = end[part] - first[part] + LENGTH - 1
                    edge = np.concatenate([[0], np.cumsum(size)])
                    data = buf[np.arange(edge[-1]) + np.repeat(low - edge[:-1], size)]
                    piece = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(data)])
                    where = pa.array(at + row[part])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where), pa.array(first[part]), pa.array(anchor[part] - first[part]), pa.array(h[part].view(np.int64)), piece], ["id", "th", "start", "at", "bucket", "piece"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, th long, start long, at long, bucket long, piece binary")


def parted(found: DataFrame) -> DataFrame:
    """Pieces of large buckets, each as several by where the anchor stands in its windows, in buckets by the bytes that
    all windows of a part have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 500):
                rows = batch.slice(k, 500)
                which, start, at, bucket, piece = [], [], [], [], []
                for i, (s, p, b, x) in enumerate(zip(*[rows.column(c).to_pylist() for c in (2, 3, 4, 5)], strict=True)):
                    for c in range((LENGTH - GRAM) // CLASS + 1):
                        sure = p - c * CLASS  # where the bytes begin that every window of the part has
                        low, high = max(0, sure - CLASS + 1), min(len(x) - LENGTH, sure)
                        if low <= high:
                            key = hashlib.blake2b(x[sure : sure + SURE], digest_size=8, salt=b"%d" % c, key=b.to_bytes(8, "little", signed=True))
                            which.append(i)
                            start.append(s + low)
                            at.append(p - low)
                            bucket.append(int.from_bytes(key.digest(), "little", signed=True))
                            piece.append(x[low : high + LENGTH])
                where = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column(0).take(where), rows.column(1).take(where), pa.array(start, pa.int64()), pa.array(at, pa.int64()), pa.array(bucket, pa.int64()), pa.array(piece, pa.binary())], ["id", "th", "start", "at", "bucket", "piece"])

    return found.select("id", "th", "start", "at", "bucket", "piece").mapInArrow(run, f"id {found.schema['id'].dataType.simpleString()}, th long, start long, at long, bucket long, piece binary")


def repeated_places(counted: DataFrame) -> DataFrame:
    """(bucket, name, places array<struct<a, b>>): by piece, where repeated windows start. counted: (bucket,
    name, piece, weight), each piece of a bucket once."""
    span = pa.struct([("a", pa.int32()), ("b", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str, bytes, int]] = []
        size = 0

        def block() -> Iterator[pa.RecordBatch]:
            # The windows of a piece have its anchor at different distances, so no two are equal: a bucket of
            # one piece is settled by its weight.
            per = Counter(x[0] for x in held)
            several = [x for x in held if per[x[0]] > 1]
            merged = iter(repeated([x[2] for x in several], np.array([x[3] for x in several]), LENGTH) if several else [])
            found = [next(merged) if per[x[0]] > 1 else np.arange(len(x[2]) - LENGTH + 1 if x[3] > 1 else 0) for x in held]
            rows = []
            for (bucket, name, _, _), places in zip(held, found, strict=True):
                if len(places):
                    cut = np.flatnonzero(np.diff(places) > 1)
                    rows.append((bucket, name, [{"a": int(a), "b": int(b) + 1} for a, b in zip(places[np.r_[0, cut + 1]], places[np.r_[cut, len(places) - 1]], strict=True)]))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.list_(span))], ["bucket", "name", "places"])

        for batch in batches:
            for bucket, name, piece, weight in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if size > BLOCK_BYTES and bucket != held[-1][0]:
                    yield from block()
                    held, size = [], 0
                held.append((bucket, name, piece, weight))
                size += len(piece)
        if held:
            yield from block()

    dealt = counted.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.select("bucket", "name", "piece", "weight").mapInArrow(run, "bucket long, name string, places array<struct<a:int,b:int>>")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, starts array<struct<a, b>>): for each (id, hash of text) with repeats, where repeated windows start."""
    texts = _texts(docs, id_col, text_col)
    named = lambda df: df.withColumn("name", F.md5("piece"))
    place = F.struct("th", "start")
    weighed = lambda df: df.groupBy("bucket", "name", "piece").agg(F.when(F.min(place) == F.max(place), 1).otherwise(2).alias("weight"))
    found = named(materialize(pieces(texts, marked_anchors(texts))))
    counted = materialize(weighed(found))
    large = materialize(counted.groupBy("bucket").agg(F.sum(F.octet_length("piece")).alias("bytes")).filter(F.col("bytes") > BLOCK_BYTES).select("bucket"))
    parts = named(materialize(parted(found.join(large, "bucket"))))
    small = lambda df: df.join(large, "bucket", "left_anti")
    places = materialize(repeated_places(small(counted).unionByName(weighed(parts))))
    columns = ["id", "th", "start", "bucket", "name"]
    found = small(found).select(columns).unionByName(parts.select(columns))
    own = found.select("id", "th", "start", "bucket", "name").distinct().join(places, ["bucket", "name"])
    some = own.select("id", "th", F.explode(F.transform("places", lambda p: F.struct((F.col("start") + p["a"]).alias("a"), (F.col("start") + p["b"]).alias("b")))).alias("s"))
    keys = texts.select("id", "th", F.octet_length("text").alias("n"), F.md5("text").alias("name")).filter(F.col("n") >= LENGTH)
    copied = materialize(keys.groupBy("name").agg(F.count("*").alias("copies")).filter("copies > 1"))
    whole = keys.join(copied, "name").select("id", "th", F.struct(F.lit(0).cast("long").alias("a"), (F.col("n") - LENGTH + 1).cast("long").alias("b")).alias("s")).distinct()
    return some.unionByName(whole).groupBy("id", "th").agg(F.array_sort(F.collect_list("s")).alias("starts"))


def _kept(raw: bytes, starts: list[dict]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed spans of a text, and the bytes that stay."""
    out: list[list[int]] = []
    for s in starts:
        a, b = s["a"], s["b"] + LENGTH - 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    edges = [0, *[x for pair in out for x in pair], len(raw)]
    return [tuple(x) for x in out], b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans array<struct<a, b>>, kept binary): each text's removed spans and the bytes that stay
    (null: all of them stay)."""
    texts = _texts(docs, id_col, text_col)
    gone = materialize(spans(docs, id_col, text_col).withColumnsRenamed({"id": "gid", "th": "gth"}))
    has = sieve(gone.select("gth"))
    some = texts.filter(has(F.col("th"))).repartition(F.col("th")).join(gone, F.col("id").eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left")
    kind = texts.schema["id"].dataType.simpleString()
    whole = texts.filter(~has(F.col("th")))  # not dealt anew: nothing goes
    kept = whole.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("spans"), F.lit(None).cast("binary").alias("kept"), F.sha2("text", 256).alias("kept_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            cut, kept, sha = [], [], []
            for text, starts in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_buffer().to_pybytes()
                spans_, rest = _kept(raw, starts.as_py() or [])
                cut.append([{"a": a, "b": b} for a, b in spans_])
                kept.append(rest if spans_ else None)
                sha.append(hashlib.sha256(rest).hexdigest())
            n = pc.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(cut, pa.list_(span)), pa.array(kept, pa.binary()), pa.array(sha)], ["id", "n_bytes", "spans", "kept", "kept_sha256"])

    return kept.unionByName(some.select("id", "text", "starts").mapInArrow(run, f"id {kind}, n_bytes long, spans array<struct<a:bigint,b:bigint>>, kept binary, kept_sha256 string"))
