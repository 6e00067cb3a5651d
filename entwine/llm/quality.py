"""Quality by regularised quadratic discriminant analysis of document statistics.

Each whole text gives a few transformed statistics (shares of symbols, capitals, repeats, short words, line
shape). Means and covariances of both classes are sums over every labelled training row, gathered in Spark as
a fixed number of cells. A class covariance is shrunk towards the pooled one and a multiple of its diagonal;
its Cholesky factor is inverted once on the driver, and a text's score is the logistic of the difference of
the two Mahalanobis log-densities plus the log prior odds.

Null and empty texts are texts without words: all their statistics are 0, which lies far from ordinary texts, and they
meet the densities with the weight of a text of one word.
Rows without a label train nothing; without a labelled row of either class every score is the share of good
rows (0.5 if there is none). Repeated rows are scored alike. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, materialize, mix, span_hashes, spans, string_chunks

STATISTICS = ("words", "word_length", "capitals", "symbols", "bare", "repeats", "distinct", "double_lines", "digits", "sentence_ends", "top_word", "short_words", "line_length")
THRESHOLD = 0.3
#: Weight of the pooled covariance, and of the diagonal, in a class covariance.
POOLED, DIAGONAL = 0.1, 0.05
#: The log-odds are divided by this: densities of dependent statistics are surer than they should be.
TEMPERATURE = 2.0
#: A text of so many words has half of the weight of a long one: shares over a handful of words say little.
EVIDENCE_WORDS = 30

_CLASS = np.zeros((6, 256))
_CLASS[0, 65:91] = 1  # capitals
_CLASS[1, [*range(65, 91), *range(97, 123)]] = 1  # letters
_CLASS[2, [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,'-"]] = 1  # symbols
_CLASS[3, 48:58] = 1  # digits
_CLASS[4, [i for i in range(256) if i < 128 or i >= 192]] = 1  # first bytes of characters
_CLASS[5, [*range(65, 91), *range(97, 123), *range(128, 256)]] = 1  # of words with letters
_CLASS = _CLASS.astype(np.int8)
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True


def _totals(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def _distinct(row: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of distinct hashes and the count of the most frequent."""
    order = np.argsort(hashes ^ mix(row.astype(np.uint64)), kind="stable")
    h, r = hashes[order], row[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(h)])
    most = np.zeros(n)
    np.maximum.at(most, r[first], size)
    return np.bincount(r[first], minlength=n), most


def statistics(text: pa.Array) -> np.ndarray:
    out = np.zeros((len(text), len(STATISTICS)))
    for at, end, buf, offs in string_chunks(text):
        n = end - at
        capitals, letters, symbols, digits, chars, _ = (_totals(c[buf], offs) for c in _CLASS)
        starts, ends, row = spans(buf, offs, SPACE)
        words = np.bincount(row, minlength=n)
        some, size = np.maximum(words, 1), np.maximum(chars, 1)
        hashes = span_hashes(LOWER[buf], starts, ends)
        lettered = np.concatenate([[0], np.cumsum(_CLASS[5][buf], dtype=np.int64)])
        bare = np.bincount(row, weights=lettered[ends] == lettered[starts], minlength=n)
        again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1]))
        repeats = np.bincount(row[again], minlength=n)
        distinct, most = _distinct(row, hashes, n)
        stops = np.bincount(row, weights=buf[ends - 1] == 46, minlength=n) if len(row) else np.zeros(n)
        first = np.concatenate([[0], np.cumsum(_CLASS[4][buf], dtype=np.int64)])
        short = np.bincount(row, weights=first[ends] - first[starts] <= 3, minlength=n)
        a, b, line = spans(buf, offs, _LINE)
        lines = np.bincount(line, minlength=n)
        single, _ = _distinct(line, span_hashes(buf, a, b), n)
        out[at:end] = np.stack([
            np.log1p(words),
            np.log1p(chars / some),
            np.sqrt(capitals / np.maximum(letters, 1)),
            np.sqrt(symbols / size),
            np.sqrt(bare / some),
            np.sqrt(repeats / some),
            np.log1p(distinct) / np.log1p(some),
            np.sqrt((lines - single) / np.maximum(lines, 1)),
            np.sqrt(digits / size),
            np.sqrt(stops / some),
            np.sqrt(most / some),
            short / some,
            np.log1p(chars / np.maximum(lines, 1)),
        ], axis=1) * (words > 0)[:, None]
    return out


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, one double column for each of STATISTICS)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x[:, k]) for k in range(x.shape[1])]], ["id", *STATISTICS])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, " + ", ".join(f"{k} double" for k in STATISTICS))


def moments(train: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """By class: rows, sum and second moments of the statistics. train: (good int, STATISTICS)."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.stack([batch.column(k + 1).to_numpy() for k in range(d)], axis=1)
            for c in (0, 1):
                z = x[y == c]
                total[c] += np.r_[len(z), z.sum(axis=0), (z.T @ z).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()), pa.array(np.tile(np.arange(total.shape[1]), 2), pa.int32()), pa.array(total.ravel())], ["good", "cell", "value"])

    cells = train.select("good", *STATISTICS).mapInArrow(run, "good int, cell int, value double").groupBy("good", "cell").agg(F.sum("value").alias("value"))
    out = {c: np.zeros(1 + d + d * d) for c in (0, 1)}
    for row in cells.collect():  # two times 1 + d + d * d cells, whatever the input
        out[row["good"]][row["cell"]] = row["value"]
    return {c: (v[0], v[1 : d + 1], v[d + 1 :].reshape(d, d)) for c, v in out.items()}


class Discriminant:
    """Class means and inverse Cholesky factors of the shrunk covariances."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        self.n = {c: v[0] for c, v in sums.items()}
        self.mean, cov = {}, {}
        for c, (n, s, ss) in sums.items():
            self.mean[c] = s / max(n, 1)
            cov[c] = ss / max(n, 1) - np.outer(self.mean[c], self.mean[c])
        total = max(sum(self.n.values()), 1)
        pooled = sum(cov[c] * self.n[c] for c in cov) / total
        self.inverse, self.log_det = {}, {}
        for c, s in cov.items():
            s = (1 - POOLED) * s + POOLED * pooled
            s = (1 - DIAGONAL) * s + DIAGONAL * np.diag(np.diag(s)) + 1e-4 * np.eye(len(s))
            low = np.linalg.cholesky(s)
            self.inverse[c] = np.linalg.inv(low)
            self.log_det[c] = np.log(np.diag(low)).sum()
        self.prior = np.log(max(self.n[1], 1) / max(self.n[0], 1))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        if min(self.n.values()) == 0:
            return np.full(len(x), self.n[1] / sum(self.n.values()) if sum(self.n.values()) else 0.5)
        density = {c: -0.5 * (((x - self.mean[c]) @ self.inverse[c].T) ** 2).sum(axis=1) - self.log_det[c] for c in (0, 1)}
        words = np.expm1(x[:, 0])
        weight = (words + 1) / (words + 1 + EVIDENCE_WORDS) / TEMPERATURE  # a text without words counts as one word
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) * weight + self.prior, -40, 40)))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_filter: Column | None = None) -> DataFrame:
    """(id, score, good): probability that each whole text is of good quality, and whether it reaches THRESHOLD.

    labels: (id_col, quality). train_filter: condition on id_col for the rows that may train."""
    known = labels.filter(F.col("quality").isin(0, 1))
    if train_filter is not None:
        known = known.filter(train_filter)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max("quality").cast("int").alias("good"))
    rows = materialize(described(docs, id_col, text_col))
    model = Discriminant(moments(rows.join(known, "id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(k + 1).to_numpy() for k in range(len(STATISTICS))], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["id", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double").withColumn("good", F.col("score") >= THRESHOLD)
