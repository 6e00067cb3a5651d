"""Toxicity from class-conditional Kneser-Ney models.

Expressions are lower-cased words spelt as bytes between two edge marks. For each class an interpolated
Kneser-Ney model predicts every byte from up to ORDER - 1 bytes before it; only the highest order is counted
by class, and rare expressions fall back on continuation counts that both classes share, so what neither
class has seen weighs nothing. A word's log-likelihood ratio is the sum over its bytes; a text is scored by
length-normalised ratios (mean over the text, best window, share of strongly toxic words), turned into a
probability by a logistic fit on cross-fitted ratios of a bounded sample of labelled rows. Its odds are multiplied by
MISS_COST, since a toxic text that is kept costs more than an ordinary one that goes.

Counts cover every labelled training row. An n-gram of up to ORDER bytes and its length fill one 64-bit integer, so
all counts are kept by their exact n-grams, without a hash; tables grow with the distinct n-grams of the labelled texts
(0.5, 0.9 and 1.6 million in 11, 75 and 370 MB of words), and reach the driver packed, some five bytes each.

Null and empty texts count as empty: they have a ratio of 0 and get the score of such a text. Rows without
a label train nothing. Without a single labelled row of either class the score is 0 and nothing is toxic.
Repeated rows are scored alike, each on its own row. Columns other than id, text and label are ignored.
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_WORD, WordCache, give_back, held, let_go, materialize, mix, span_hashes, spans, string_chunks

ORDER = 7
DISCOUNT = 0.75
WINDOW = 24
#: Longest spelling of a word that is scored as one expression; longer ones go on in a further expression.
#: (No part of a text is left out.)
SPELLING = 48
#: Labelled rows at most (the first by a hash of the id) on which the logistic layer is fitted.
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.7
MISS_COST = 4.0
_FEATURES = 6
_GROUPS = ("o0", "o1", "t0", "t1")
#: Words a task holds before it spells them out as n-grams, words spelt out at once, and n-grams held: they bound its
#: memory.
_HELD_WORDS, _BLOCK_WORDS, _HELD_GRAMS = 200_000, 10_000, 400_000
#: Texts that are put in lower case at once.
_ROWS = 500
#: Labels are broadcast up to so many rows (about 40 MB as a hash table); of more, the training texts are
#: dealt out by id once.
BROADCAST_LABELS = 1_000_000


def _expressions(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the expressions; very long words are cut into pieces."""
    starts, ends, row = spans(buf, offs, NON_WORD)
    pieces = (ends - starts + SPELLING - 1) // SPELLING
    if len(pieces) and pieces.max() > 1:
        at = np.repeat(np.arange(len(starts)), pieces)
        k = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, row = starts[at] + k * SPELLING, row[at]
        ends = np.minimum(starts + SPELLING, ends[at])
    return starts, ends, row


def _spelt(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The expressions one after another, each between bytes 1 and 2; the bytes, and each byte's expression and place in it."""
    size = ends - starts + 2
    which = np.repeat(np.arange(len(starts)), size)
    place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    inner = np.clip(starts[which] + place - 1, 0, max(len(buf) - 1, 0))
    out = np.where(place == 0, 1, np.where(place == size[which] - 1, 2, buf[inner] if len(buf) else 0)).astype(np.uint8)
    return out, which, place


_LENGTH = np.uint64(56)
_BYTE = np.uint64(8)


def _grams(spelt: np.ndarray) -> list[np.ndarray]:
    """By order n from 0 up: the last n bytes before and at each byte as an integer (meaningful within an expression)."""
    out = [np.zeros(len(spelt), np.uint64)]
    for _ in range(ORDER):
        before = np.concatenate([np.zeros(1, np.uint64), out[-1][:-1]]) if len(spelt) else out[-1]
        out.append(before << _BYTE | spelt)
    return out


def _key(n: int | np.ndarray, value: np.ndarray) -> np.ndarray:
    """An n-gram as one integer: its length in the first byte, then its bytes."""
    return np.asarray(n, np.uint64) << _LENGTH | value


def _cut(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The context (all but the last byte) and the suffix (all but the first) of n-grams, and the suffix's context
    (empty where there is none)."""
    n, one = keys >> _LENGTH, np.uint64(1)
    value = keys & ((one << _LENGTH) - one)
    suffix = value & ((one << (_BYTE * (np.maximum(n, one) - one))) - one)
    return _key(n - one, value >> _BYTE), _key(n - one, suffix), _key(np.maximum(n, np.uint64(2)) - np.uint64(2), suffix >> _BYTE)


def _top(keys: np.ndarray) -> np.ndarray:
    """Whether n-grams are of the highest order where they stand: of ORDER bytes, or from the edge mark on."""
    n = keys >> _LENGTH
    return (n == ORDER) | ((keys >> (_BYTE * (np.maximum(n, np.uint64(1)) - np.uint64(1)))) & np.uint64(255) == 1)


class _Table:
    """Values by 64-bit keys, found by a bucket of the mixed key and a comparison of the whole key."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        bits = max(4, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        bucket = (mix(keys) >> self.shift).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        self.keys, self.values = keys[order], [v[order].astype(np.float32) for v in values]
        self.start = np.searchsorted(bucket[order], np.arange((1 << bits) + 1)).astype(np.int32)

    def get(self, keys: np.ndarray) -> list[np.ndarray]:
        """For each of the values an array, 0 where there is no key."""
        bucket = (mix(keys) >> self.shift).astype(np.int64)
        at, end = self.start[bucket].astype(np.int64), self.start[bucket + 1]
        where = np.full(len(keys), -1, np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            hit = self.keys[at[open_]] == keys[open_]
            where[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        found = where >= 0
        return [np.where(found, v[where] if len(v) else 0, 0) for v in self.values]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sums of its rows of counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first, axis=0) if len(first) else counts


class _Words:
    """Distinct words of a task with their counts in four groups (toxic or not, two folds)."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, text: pa.Array, group: np.ndarray) -> None:
        for at, end, buf, offs in string_chunks(pc.utf8_lower(text)):
            starts, ends, row = _expressions(buf, offs)
            if len(starts):
                hashes, first, back = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
                counts = np.bincount(back * 4 + group[at:end][row], minlength=len(first) * 4).reshape(-1, 4)
                size = (ends - starts)[first]
                flat = buf[np.arange(size.sum()) + np.repeat(starts[first] - np.cumsum(size) + size, size)]
                self.parts.append((hashes, counts, size, flat))
                self.n += len(first)

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, starts, ends and counts of the words so far, each once."""
        hashes, counts, size, flat = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.n = [], 0
        _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.stack([np.bincount(back, weights=counts[:, k], minlength=len(first)) for k in range(4)], axis=1)
        starts = np.cumsum(size) - size
        return flat, starts[first], (starts + size)[first], total


def _grams_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of all orders, with the counts of those of the highest order (the others: 0)."""
    spelt, which, place = _spelt(buf, starts, ends)
    grams, keys, sums = _grams(spelt), [], []
    for n in range(1, ORDER + 1):
        p = np.flatnonzero(place >= max(n - 1, 1))
        k, back = np.unique(_key(n, grams[n][p]), return_inverse=True)
        total = np.stack([np.bincount(back, weights=counts[which[p], g], minlength=len(k)) for g in range(4)], axis=1).astype(np.int64)
        keys.append(k)
        sums.append(np.where(_top(k)[:, None], total, 0))
    return np.concatenate(keys), np.concatenate(sums)


def ngram_sums(train: DataFrame) -> DataFrame:
    """(g, o0, o1, t0, t1): the distinct n-grams and their counts by class and fold. train: (text, toxic int, fold int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        words = _Words()

        def spill() -> Iterator[pa.RecordBatch]:
            if not words.n:
                return
            buf, starts, ends, counts = words.take()
            keys, sums = np.zeros(0, np.uint64), np.zeros((0, 4), np.int64)
            for k in range(0, len(starts), _BLOCK_WORDS):
                at = slice(k, k + _BLOCK_WORDS)
                low, high = starts[at].min(), ends[at].max()
                more, new = _grams_of(buf[low:high], starts[at] - low, ends[at] - low, counts[at])
                keys, sums = _summed(np.concatenate([keys, more]), np.concatenate([sums, new]))
                if len(keys) > _HELD_GRAMS or k + _BLOCK_WORDS >= len(starts):
                    for i in range(0, len(keys), 100_000):
                        part = slice(i, i + 100_000)
                        yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), *[pa.array(sums[part, g]) for g in range(4)]], ["g", *_GROUPS])
                    keys, sums = keys[:0], sums[:0]

        for batch in batches:
            group = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) * 2 + batch.column(2).to_numpy(zero_copy_only=False)
            for k in range(0, len(batch), _ROWS):
                words.add(batch.column(0).slice(k, _ROWS), group[k : k + _ROWS])
                if words.n > _HELD_WORDS:
                    yield from spill()
        yield from spill()
        del words
        give_back()

    return train.mapInArrow(run, "g long, " + ", ".join(f"{k} long" for k in _GROUPS)).groupBy("g").agg(*[F.sum(k).alias(k) for k in _GROUPS])


def _collected(grams: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams in order and their counts, sent as compressed differences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            order = np.argsort(keys)
            counts = np.stack([batch.column(1 + g).to_numpy()[order] for g in range(4)])
            raw = np.diff(keys[order], prepend=np.uint64(0)).tobytes() + counts.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([len(keys)], pa.int64()), pa.array([zlib.compress(raw, 6)], pa.binary())], ["n", "packed"])

    keys, counts = [np.zeros(0, np.uint64)], [np.zeros((0, 4), np.int64)]
    for row in grams.mapInArrow(run, "n long, packed binary").collect():
        raw = zlib.decompress(bytes(row["packed"]))
        keys.append(np.cumsum(np.frombuffer(raw, np.uint64, row["n"])))
        counts.append(np.frombuffer(raw, np.int64, offset=8 * row["n"]).reshape(4, -1).T)
    return _summed(np.concatenate(keys), np.concatenate(counts))


class Model:
    """Kneser-Ney tables of both classes: discounted counts by n-gram, totals and backoff weights by context."""

    def __init__(self, sums: tuple[np.ndarray, np.ndarray], folds: tuple[int, ...] = (0, 1)):
        self.name = uuid.uuid4().hex
        keys, counts = sums
        top = _top(keys)
        context, suffix, suffix_context = _cut(keys)
        by_class = np.stack([sum(counts[:, 2 * c + f] for f in folds) for c in (0, 1)], axis=1)
        seen = top & (by_class.sum(axis=1) > 0)
        self.share = _Table(keys[seen], *np.maximum(by_class[seen] - DISCOUNT, 0).T)
        # by context: total and number of different n-grams, of each class
        ctx, total = _summed(context[seen], np.concatenate([by_class[seen], by_class[seen] > 0], axis=1))
        self.backoff = _Table(ctx, *total.T)
        # lower orders: in how many different places n-grams go on, shared by the classes
        longer = keys >> _LENGTH > 1
        low, times = _summed(suffix[longer], np.ones((longer.sum(), 1), np.int64))
        self.lower = _Table(low, np.maximum(times[:, 0] - DISCOUNT, 0))
        ctx = np.concatenate([suffix_context[longer], context[~top]])
        ones = np.concatenate([np.repeat([[1, 0]], longer.sum(), axis=0), np.repeat([[0, 1]], (~top).sum(), axis=0)])
        ctx, total = _summed(ctx, ones)
        self.shared = _Table(ctx, *total.T)

    def ratios(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log P(expression | toxic) - log P(expression | ordinary)."""
        out = np.zeros(len(starts))
        for k in range(0, len(starts), _BLOCK_WORDS):
            at = slice(k, k + _BLOCK_WORDS)
            out[at] = self._ratios(buf, starts[at], ends[at])
        return out

    def _ratios(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spelt, which, place = _spelt(buf, starts, ends)
        grams = _grams(spelt)
        p = np.flatnonzero(place > 0)
        low = np.full(len(p), 1 / 256)
        for n in range(1, ORDER):
            at = np.flatnonzero(place[p] >= n)  # what starts with the edge mark is of the highest order there
            q = p[at]
            total, types = self.shared.get(_key(n - 1, grams[n - 1][q - 1]))
            ok = total > 0
            at, q, total, types = at[ok], q[ok], total[ok], types[ok]
            low[at] = np.maximum((self.lower.get(_key(n, grams[n][q]))[0] + types * DISCOUNT * low[at]) / total, 1e-9)
        size = np.minimum(place[p] + 1, ORDER)
        stack = np.stack(grams)
        share = self.share.get(_key(size, stack[size, p]))
        *total, types_o, types_t = self.backoff.get(_key(size - 1, stack[size - 1, p - 1]))
        logs = [np.log(np.where(t > 0, (s + DISCOUNT * k * low) / np.maximum(t, 1) + 1e-9, low)) for s, t, k in zip(share, total, (types_o, types_t), strict=True)]
        return np.bincount(which[p], weights=logs[1] - logs[0], minlength=len(starts))


def _packed(*models: Model) -> tuple[str, bytes, list[bytes]]:
    """Models for a broadcast: their arrays apart and compressed."""
    arrays: list[pickle.PickleBuffer] = []
    frame = pickle.dumps(models, protocol=5, buffer_callback=arrays.append)
    return models[0].name, frame, [zlib.compress(x.raw(), 1) for x in arrays]


def _unpacked(sent: tuple[str, bytes, list[bytes]]) -> tuple:
    """The models, array by array, so that none is in memory twice, each with a cache of its word ratios."""
    name, frame, arrays = sent

    def make() -> tuple:
        models = pickle.loads(frame, buffers=(zlib.decompress(x) for x in arrays))
        return models, [WordCache() for _ in models]

    return held(("toxicity", name), make)


def features(text: pa.Array, model: Model, cache: WordCache) -> np.ndarray:
    """Length-normalised ratios of each whole text. cache: ratios of this model's words met before."""
    if len(text) > _ROWS:
        return np.concatenate([features(text.slice(k, _ROWS), model, cache) for k in range(0, len(text), _ROWS)])
    out = np.zeros((len(text), _FEATURES))
    for at, end, buf, offs in string_chunks(pc.utf8_lower(text)):
        n = end - at
        starts, ends, row = _expressions(buf, offs)
        if not len(starts):
            continue
        hashes = span_hashes(buf, starts, ends)
        _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        ratio, new = cache.get(hashes[first])
        new = np.flatnonzero(new)
        ratio[new] = np.clip(model.ratios(buf, starts[first[new]], ends[first[new]]), -6, 12)
        cache.put(hashes[first[new]], ratio[new])
        ratio = ratio[back].astype(float)
        words = np.bincount(row, minlength=n)
        some = np.maximum(words, 1)
        strong = np.maximum(ratio - 2, 0)
        total = np.concatenate([[0], np.cumsum(ratio)])
        begin = (np.cumsum(words) - words)[row]
        here = np.arange(len(row))
        since = np.maximum(here + 1 - WINDOW, begin)
        window = (total[here + 1] - total[since]) / np.maximum(here + 1 - since, 8)
        best = np.full(n, -6.0)
        np.maximum.at(best, row, window)
        sums = np.bincount(row, weights=strong, minlength=n)
        out[at:end] = np.stack([
            np.bincount(row, weights=ratio, minlength=n) / some,
            sums / some,
            np.where(words > 0, best, 0),
            np.log1p(sums),
            np.sqrt(np.bincount(row, weights=ratio > 4, minlength=n) / some),
            np.log1p(words),
        ], axis=1)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; weights of the standardised columns folded into the raw ones."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(z.shape[1])
    penalty = np.diag(np.r_[1e-6, np.full(z.shape[1] - 1, ridge)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slope = w[1:] / scale
    return np.r_[w[0] - slope @ mean, slope]


def fit(train: DataFrame) -> tuple[Model, np.ndarray] | None:
    """The models and the logistic weights. train: (id, text, toxic int). None if a class is missing."""
    spark = train.sparkSession
    train = materialize(train.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int")))
    sums = _collected(ngram_sums(train.select("text", "toxic", "fold")))
    if not sums[1][:, :2].sum() or not sums[1][:, 2:].sum():
        return None
    ids = train.select("id").distinct().orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(CALIBRATION_ROWS)
    sample = train.join(ids, "id", "left_semi").select("text", "fold", "toxic")
    kinds = ", ".join(f"f{k} double" for k in range(_FEATURES)) + ", y int"

    def crossed(fold: int) -> DataFrame:
        """The rows of a fold by the counts of the other: one model at a time in a worker."""
        sent = spark.sparkContext.broadcast(_packed(Model(sums, (1 - fold,))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (model,), (cache,) = _unpacked(sent.value)
            for batch in batches:
                x = features(batch.column(0), model, cache)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, k]) for k in range(_FEATURES)] + [batch.column(1)], [f"f{k}" for k in range(_FEATURES)] + ["y"])

        return sample.filter(F.col("fold") == fold).select("text", "toxic").mapInArrow(run, kinds)

    found = crossed(0).union(crossed(1)).toArrow()
    x = np.stack([found.column(k).to_numpy() for k in range(_FEATURES)], axis=1)
    weights = fit_logistic(x, found.column("y").to_numpy().astype(float))
    return Model(sums), weights + np.r_[np.log(MISS_COST), np.zeros(_FEATURES)]


def scorer(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_filter: Column | None = None):
    """A function from a text column to its score. labels: (id_col, toxic). train_filter: condition on id_col
    for the rows that may train."""
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isin(0, 1)).filter(F.lit(True) if train_filter is None else train_filter)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.filter(F.lit(True) if train_filter is None else train_filter).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    model = fit(rows.join(known, "id").select("id", "text", "toxic"))
    if model is None:
        return lambda text: F.lit(0.0)
    w = model[1]
    sent = spark.sparkContext.broadcast(_packed(model[0]))

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        (tables,), (cache,) = _unpacked(sent.value)
        z = features(text, tables, cache) @ w[1:] + w[0]
        return pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return lambda text: run(text.cast("string"))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_filter: Column | None = None) -> DataFrame:
    """(id, score, toxic): probability that each whole text is toxic, and whether it reaches THRESHOLD."""
    value = scorer(docs, labels, id_col, text_col, train_filter)
    return docs.select(F.col(id_col).alias("id"), value(F.col(text_col)).alias("score")).withColumn("toxic", F.col("score") >= THRESHOLD)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that are rejected as toxic."""
    value = scorer(docs, labels, id_col, text_col)
    return docs.filter(value(F.col(text_col)) < THRESHOLD)
