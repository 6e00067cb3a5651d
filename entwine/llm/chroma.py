"""Chroma fingerprints of audio columns, and alignment of recordings by them.

A recording is cut into overlapping frames; each frame's spectrum is folded into 12 pitch classes. Filters
that compare rectangles of the smoothed pitch-class image, summed by an integral image, give two bits each;
16 of them are packed into one integer for each frame position. Two recordings are aligned by the histogram
of offsets at which their integers are equal. An offset stands if the two overlap over LEAST_OVERLAP of the
shorter one, if a share LEAST_HITS of the overlap has equal integers, and if at most MOST_ERROR of all bits differ.

The search is a join on seeds: two integers GAP places apart, where a run of equal seeds (a silence, a held
tone) counts once. Every offset at which SEEDS seeds agree is looked at, however frequent these are; two recordings
that share fewer (a silence and nothing else) are no alignment.
Recordings of equal fingerprints are searched as one class and named by their smallest id.

A null, empty or too short recording has no integers and matches nothing; non-finite samples count as 0.
Ties between offsets go to the smaller absolute one, then to the positive. Silence gives integers like any
other sound. Repeated ids keep their rows. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix, sieve

RATE = 5512
FRAME, HOP = 1024, 170
LOW_HZ, HIGH_HZ = 55.0, 2200.0
#: Width of a filter in frames, by its number mod 4; its height and place follow from its number.
WIDTHS = (8, 12, 16, 24)
STEP = 0.5
#: Share of the shorter recording that must overlap, of the overlap that must have equal integers, and of its bits
#: that may differ. Measured on rendered tunes: excerpts under noise of up to half their loudness differ in 0.07 of their
#: bits at most and share 0.18 of their integers at least; tunes of which a fifth or more is another differ in 0.11 or more.
LEAST_OVERLAP, LEAST_HITS, MOST_ERROR = 0.5, 0.15, 0.09
#: Places between the two integers of a seed; equal seeds that an alignment has at least; seeds of a query left out.
GAP, SEEDS, SKIPPED = 24, 2, 0


@cache
def _fold() -> np.ndarray:
    """Weights that fold a frame's spectrum into pitch classes."""
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    out = np.zeros((len(hz), 12))
    ok = np.flatnonzero((hz >= LOW_HZ) & (hz <= HIGH_HZ))
    out[ok, np.round(12 * np.log2(hz[ok] / 440)).astype(int) % 12] = 1
    return out


def chroma(samples: np.ndarray) -> np.ndarray:
    """One row of 12 normalised pitch classes for each frame."""
    n = (len(samples) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(np.nan_to_num(samples.astype(np.float32), posinf=0, neginf=0), FRAME)[::HOP]
    fold, window = _fold().astype(np.float32), np.hanning(FRAME).astype(np.float32)
    out = np.concatenate([np.abs(np.fft.rfft(frames[k : k + 256] * window)) ** 2 @ fold for k in range(0, len(frames), 256)])
    kernel = np.array([0.25, 0.75, 1.0, 0.75, 0.25])
    padded = np.pad(out, ((2, 2), (0, 0)), mode="edge")
    out = sum(w * padded[k : k + len(out)] for k, w in enumerate(kernel))
    norm = np.sqrt((out**2).sum(axis=1, keepdims=True))
    return (out / np.where(norm > 1e-6, norm, 1)).astype(float)


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """Packed 32-bit integers, one for each place of the widest filter."""
    image = chroma(samples)
    widest = max(WIDTHS)
    places = len(image) - widest + 1
    if places < 1:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(image) + 1, 25))
    np.cumsum(np.cumsum(np.concatenate([image, image], axis=1), axis=0), axis=1, out=total[1:, 1:])  # classes go round
    at = np.arange(places)

    def area(x: np.ndarray, width: int, low: int, height: int) -> np.ndarray:
        return total[x + width, low + height] - total[x, low + height] - total[x + width, low] + total[x, low]

    out = np.zeros(places, np.uint32)
    for k in range(16):
        width, low, height = WIDTHS[k % 4], (5 * k) % 12, 2 + 2 * (k // 4 % 3)
        half = width // 2
        if k % 3 == 0:  # earlier against later
            a, b = area(at, half, low, height), area(at + half, half, low, height)
        elif k % 3 == 1:  # lower against upper classes
            a, b = area(at, width, low, height // 2), area(at, width, low + height // 2, height // 2)
        else:  # both diagonals
            a = area(at, half, low, height // 2) + area(at + half, half, low + height // 2, height // 2)
            b = area(at + half, half, low, height // 2) + area(at, half, low + height // 2, height // 2)
        value = np.log1p(a) - np.log1p(b)
        level = np.digitize(value, (-STEP, 0.0, STEP)).astype(np.uint32)
        out |= (level ^ (level >> np.uint32(1))) << np.uint32(2 * k)  # Gray code: neighbours differ in one bit
    return out


def decode_pcm(raw: bytes | None) -> np.ndarray:
    """Samples of 16-bit little-endian mono PCM, with or without a RIFF header."""
    raw = raw or b""
    if raw[:4] == b"RIFF" and b"data" in raw[:512]:
        raw = raw[raw.index(b"data") + 8 :]
    return np.frombuffer(raw[: len(raw) // 2 * 2], "<i2").astype(np.float32) / 32768


def encode_pcm(samples: np.ndarray) -> bytes:
    return (np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()


def fingerprints(media: DataFrame, id_col: str, audio_col: str, decode: Callable[[object], np.ndarray] = decode_pcm) -> DataFrame:
    """(id, values array<bigint>): the fingerprint of each recording. decode: what makes samples at RATE of a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                found = [fingerprint(decode(x.as_py())).astype(np.int64) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "values"])

    return media.select(F.col(id_col).alias("id"), F.col(audio_col).alias("audio")).mapInArrow(run, f"id {media.schema[id_col].dataType.simpleString()}, values array<bigint>")


def classes(prints: DataFrame) -> DataFrame:
    """(id, class, print, values): recordings with integers, each with the smallest id of those of the same fingerprint."""
    found = prints.filter(F.size("values") > 0).withColumn("print", F.md5(F.array_join(F.col("values").cast("array<string>"), ",")))
    least = found.groupBy("print").agg(F.min("id").alias("class"))
    return found.join(least, "print").select("id", "class", "print", "values")  # a class of rows without an id has none


def _seeds(prints: DataFrame, key: str) -> DataFrame:
    """(key, place, seed): the places of each fingerprint at which a run of equal seeds begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                size = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = part.column(1).flatten().to_numpy().view(np.uint64)
                row = np.repeat(np.arange(len(part)), size)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
                at = np.flatnonzero(place < size[row] - GAP)
                seed = mix(flat[at] | (flat[at + GAP] << np.uint64(32)))  # one to one: two 32-bit integers
                new = np.ones(len(at), bool)
                new[1:] = (seed[1:] != seed[:-1]) | (row[at][1:] != row[at][:-1])
                at, seed = at[new], seed[new]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row[at])), pa.array(place[at]), pa.array(seed.view(np.int64))], [key, "place", "seed"])

    return prints.select(key, "values").mapInArrow(run, f"{key} {prints.schema[key].dataType.simpleString()}, place long, seed long")


def search(queries: DataFrame, known: DataFrame) -> DataFrame:
    """(query, class, offset, hits, bit_error): for each query its best alignment with every class of recordings that it
    aligns with. queries: (id, values); known: as classes gives it. offset: where the query begins in the recording."""
    reps = materialize(known.filter(F.col("id").eqNullSafe(F.col("class"))).dropDuplicates(["print"]).select("print", "class", "values"))
    asked = materialize(queries.filter(F.size("values") > 0).select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("query"), "values"))
    put = materialize(_seeds(asked, "row"))
    places = _seeds(reps, "print").withColumnRenamed("place", "at")
    places = places.filter(sieve(put.select("seed"))(F.col("seed")))  # seeds of no query are not dealt
    seeds = put.join(places, "seed").groupBy("row", "print", (F.col("at") - F.col("place")).alias("offset")).agg(F.count("*").alias("n"))
    found = materialize(seeds.filter(F.col("n") >= SEEDS).select("row", "print", "offset"))
    whole = found.join(reps.withColumnRenamed("values", "r"), "print").join(asked.withColumnRenamed("values", "a"), "row")
    low, high = F.greatest(F.lit(0), F.col("offset")), F.least(F.size("r"), F.size("a") + F.col("offset"))
    cut = whole.select("row", "query", "print", "class", "offset", F.least(F.size("a"), F.size("r")).alias("n"), F.slice("r", low + 1, high - low).alias("v"), F.slice("a", low - F.col("offset") + 1, high - low).alias("q"))
    differ = F.zip_with("q", "v", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    judged = cut.select("row", "query", "print", "class", "offset", "n", differ.alias("differ")).select(
        "row", "query", "print", "class", "offset", "n", F.size("differ").alias("overlap"), F.size(F.filter("differ", lambda x: x == 0)).alias("hits"), (F.aggregate("differ", F.lit(0), lambda n, x: n + x) / (32.0 * F.size("differ"))).alias("bit_error")
    )
    stands = judged.filter((F.col("overlap") >= F.ceil(F.col("n") * LEAST_OVERLAP)) & (F.col("hits") >= F.ceil(F.col("overlap") * LEAST_HITS)) & (F.col("bit_error") <= MOST_ERROR))
    best = F.min(F.struct((-F.col("hits")).alias("h"), F.abs("offset").alias("o"), (-F.col("offset")).alias("s"), "bit_error")).alias("b")
    return stands.groupBy("row", "query", "print", "class").agg(best).select("query", "class", (-F.col("b.s")).cast("long").alias("offset"), (-F.col("b.h")).cast("long").alias("hits"), F.col("b.bit_error").alias("bit_error"))


@cache
def _notes(samples: int) -> np.ndarray:
    """25 semitones from 220 Hz up, each with two overtones."""
    t = np.arange(samples) / RATE
    return np.stack([(np.sin(2 * np.pi * f * t) + 0.5 * np.sin(4 * np.pi * f * t) + 0.25 * np.sin(6 * np.pi * f * t)) * 0.5 for f in 220 * 2 ** (np.arange(25) / 12)]).astype(np.float32)


def tune(vector: list[float] | None, seconds: float = 0.2) -> np.ndarray:
    """The sound of a vector, as 16-bit samples hold it: a stand-in for a recording where a table has none. Component after
    component sounds for `seconds`, at a semitone by where it lies between -0.4 and 0.4. Equal vectors sound equal, near
    ones alike."""
    v = np.nan_to_num(np.array([0 if x is None else x for x in vector or []], float))
    return decode_pcm(encode_pcm(_notes(int(RATE * seconds))[np.clip(np.round((v + 0.4) * 30), 0, 24).astype(int)].ravel()))


def heard(vector: list[float] | None, seconds: float = 0.2) -> np.ndarray:
    """The middle three fifths of a vector's tune, quieter and under white noise of a tenth of its loudness."""
    whole = tune(vector, seconds)
    noise = np.random.default_rng(zlib.crc32(whole.tobytes())).normal(0, 1, len(whole)).astype(np.float32)
    loud = float(np.sqrt((whole**2).mean())) if len(whole) else 0.0
    return decode_pcm(encode_pcm((0.7 * (whole + 0.1 * loud * noise))[len(whole) // 5 : len(whole) - len(whole) // 5]))
