"""SimHash near-duplicates, candidates thinned by pivot distance tables.

Fingerprints are grouped first, so a text with a million copies costs one row from there on. Six blocks of
the 64 bits make 20 tables keyed by three blocks: two fingerprints that differ in at most 3 bits leave three
blocks untouched and so share a key in one table at least, whatever the size of the input. Within a key, a
table of Hamming distances to many reference fingerprints discards every pair whose largest coordinate
difference exceeds the radius (triangle inequality, so no link is lost); the survivors are verified bit by bit.

Null and empty texts have no words: their fingerprint is zero and links like any other. Ties of the vote
(exactly half) leave a bit 0. Repeated ids keep their rows. An empty table gives an empty result. Columns
other than the id and the text are ignored and may have any name. A row without an id takes part in no link of its own.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LOWER, SPACE, let_go, materialize, mix, sieve, spans, string_chunks, unused
from .components import connected
from .xxh64 import xxh64_spans

SEED = 42
RADIUS = 3
#: Six blocks of the 64 bits: (shift, width).
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
TABLES = tuple(combinations(range(6), 3))
#: Reference fingerprints of the pivot tables.
PIVOTS = np.random.default_rng(20).integers(0, 1 << 64, (24, 4), dtype=np.uint64)
#: Up to so many rows of a key, all their links are given; of more, a spanning forest.
PAIR_ROWS = 32

#: Min-hashes of a set of shingles, for a similarity below what 3 bits can tell: BANDS keys of ROWS minima each.
#: They only bring candidates together: a pair at the least Jaccard similarity SHARED / OF shares no key with a chance of
#: (1 - 0.8^5)^32, 3 in a million. Within a key the sets' SimHash fingerprints of WORDS words and their distances to
#: reference fingerprints thin the pairs, and every link is verified on the sets.
BANDS, ROWS, SHARED, OF = 32, 5, 4, 5
#: Of the 512 bits of two sets at that similarity each differs with a chance of 0.1875 at most (four shingles and one
#: more), so over 160 do with a chance of 4 in a million millions; of unrelated sets half differ.
WORDS, WIDE_RADIUS = 8, 160
_TURN, _SPIN = np.random.default_rng(2000).integers(0, 1 << 64, (2, WORDS), dtype=np.uint64) | np.array([[0], [1]], np.uint64)
_XOR, _TIMES = np.random.default_rng(1000).integers(0, 1 << 64, (2, BANDS * ROWS), dtype=np.uint64) | np.array([[0], [1]], np.uint64)

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def squeezed(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with A-Z in lower case and each run of white space as one space (none at the start); bytes and offsets."""
    low = LOWER[buf]
    space = SPACE[low]
    first = np.zeros(len(buf) + 1, bool)
    first[offs] = True
    kept = ~space
    kept[1:] |= space[1:] & ~space[:-1] & ~first[1:-1]
    total = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(kept, out=total[1:])
    out = low[kept]
    out[SPACE[out]] = 32
    return out, total[offs]


def shingles(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the word shingles in squeezed rows; a row of fewer words has one, all of it."""
    starts, ends, row = spans(buf, offs, SPACE)
    words = np.bincount(row, minlength=len(offs) - 1)
    first = np.cumsum(words) - words
    last = np.minimum(np.arange(len(row)) + width, (first + words)[row]) - 1
    keep = (last - np.arange(len(row)) == width - 1) | (np.arange(len(row)) == first[row])
    return starts[keep], ends[last[keep]], row[keep]


def _fingerprints(column: pa.Array, width: int) -> np.ndarray:
    """Bit i of a row's fingerprint is set if it is set in over half of its shingles' hashes. One row of one
    word for each text."""
    out = np.zeros((len(column), 1), np.uint64)
    for at, end, raw, raw_offs in string_chunks(column):
        buf, offs = squeezed(raw, raw_offs)
        starts, ends, row = shingles(buf, offs, width)
        out[at:end, 0] = _voted(xxh64_spans(buf, starts, ends, SEED), row, end - at)
    return out


def _sets(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of rows: the hashes of each row's shingles, each once and in order, and the rows' offsets in them."""
    for at, end, raw, raw_offs in string_chunks(column):
        buf, offs = squeezed(raw, raw_offs)
        starts, ends, row = shingles(buf, offs, width)
        hashes = xxh64_spans(buf, starts, ends, SEED)
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(row), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        yield hashes[new], np.searchsorted(row[new], np.arange(end - at + 1))


def _voted(words: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows the bits that are set in over half of its 64-bit words."""
    one, half = words.view(np.uint8).reshape(-1, 8), np.bincount(row, minlength=n)[:, None]
    counts = [np.bincount(row * 256 + one[:, i], minlength=n * 256).reshape(n, 256) @ _BITS for i in range(8)]
    return np.packbits(2 * np.concatenate(counts, axis=1) > half, axis=1, bitorder="little").view("<u8")[:, 0]


def _set_prints(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The SimHash fingerprint of each set, a row of WORDS words."""
    n = len(offs) - 1
    row = np.repeat(np.arange(n), np.diff(offs))
    return np.stack([_voted(mix((hashes ^ _TURN[k]) * _SPIN[k]), row, n) for k in range(WORDS)], axis=1)


def _digests(hashes: np.ndarray, offs: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def _band_keys(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """BANDS keys of each set; those of an empty set are 0."""
    out = np.zeros((len(offs) - 1, BANDS), np.uint64)
    some = np.flatnonzero(np.diff(offs))
    if not len(some):
        return out
    for band in range(BANDS):
        key = np.full(len(some), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((hashes ^ _XOR[k]) * _TIMES[k], offs[some]))
        out[some, band] = key
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of each whole text, as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_fingerprints(batch.column(1), width)[:, 0].view(np.int64))], ["id", "fp"])

    one = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return one.mapInArrow(run, "id long, fp long")


def distances(fps: np.ndarray, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    """The pivot table: Hamming distance of each fingerprint (a row of 64-bit words) to each reference."""
    pivots = pivots[:, : fps.shape[1]]
    return sum(np.bitwise_count(fps[:, w, None] ^ pivots[:, w]).astype(np.int16) for w in range(fps.shape[1]))


def near(a: np.ndarray, pa_: np.ndarray, b: np.ndarray, pb: np.ndarray, radius: int) -> np.ndarray:
    """Mask of the pairs (a[i], b[i]) within the radius; pivots first, bits only for the survivors. a may be one row."""
    keep = np.ones(len(b), bool)
    row = (lambda x, at: x[at]) if len(a) == len(b) else (lambda x, at: x)
    for k in range(0, len(PIVOTS), 8):
        at = np.flatnonzero(keep)
        keep[at] = np.abs(row(pa_, at)[:, k : k + 8] - pb[at, k : k + 8]).max(axis=1, initial=0) <= radius
    at = np.flatnonzero(keep)
    keep[at] = np.bitwise_count(row(a, at) ^ b[at]).sum(axis=1) <= radius
    return keep


def _forest(fps: np.ndarray, reps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join one key's fingerprints as all its pairs within the radius would: each row, once reached,
    is compared with all that no tree has reached yet. Trees grow from the smallest representative, so the same
    group gives much the same links under every key that it shares."""
    order = np.argsort(reps, kind="stable")
    fps, reps = fps[order], reps[order]
    table, rest = distances(fps), np.arange(len(fps))
    left, right = [], []
    while len(rest):
        open_, rest = [int(rest[0])], rest[1:]
        while open_ and len(rest):
            i = heapq.heappop(open_)
            hit = near(fps[i : i + 1], table[i : i + 1], fps[rest], table[rest], radius)
            new, rest = rest[hit], rest[~hit]
            left.append(np.full(len(new), reps[i]))
            right.append(reps[new])
            for j in new.tolist():
                heapq.heappush(open_, j)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _linked(radius: int, words: int, pair_rows: int):
    """A function for mapInArrow over rows (key, rep, words ..) in the order of key: links within each key."""

    def found(key: np.ndarray, rep: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.repeat(np.diff(cut), np.diff(cut))
        some = (size > 1) & (size <= pair_rows)
        k, f, r = key[some], fps[some], rep[some]
        pivot = distances(f)
        for step in range(1, pair_rows):
            at = np.flatnonzero(k[step:] == k[:-step])
            if not len(at):
                break
            at = at[near(f[at], pivot[at], f[at + step], pivot[at + step], radius)]
            left.append(r[at])
            right.append(r[at + step])
        for c in np.flatnonzero(np.diff(cut) > pair_rows):
            a, b = _forest(fps[cut[c] : cut[c + 1]], rep[cut[c] : cut[c + 1]], radius)
            left.append(a)
            right.append(b)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # batches of the key that may go on in the next one

        def whole() -> pa.RecordBatch:
            x = [np.concatenate(c) for c in zip(*held, strict=True)]
            return found(x[0], x[1], np.stack([w.view(np.uint64) for w in x[2:]], axis=1))

        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(2 + words)]
            if not len(new[0]):
                continue
            last = int(np.searchsorted(new[0], new[0][-1])) if new[0][0] != new[0][-1] else 0
            if held and (last or held[-1][0][-1] != new[0][0]):
                held.append([x[:last] for x in new])
                yield whole()
                held = []
            elif last:
                held = [[x[:last] for x in new]]
                yield whole()
                held = []
            held.append([x[last:] for x in new])
        if held:
            yield whole()

    return run


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(src, dst) links between class representatives. classes: (fp, rep), each fingerprint once."""
    keys = []
    for number, blocks in enumerate(TABLES):
        key = F.lit(number).cast("long")
        for b in blocks:
            shift, width = BLOCKS[b]
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(key)

    rows = classes.filter("rep is not null").select(F.explode(F.array(*keys)).alias("key"), "rep", "fp")
    rows = rows.repartition(F.col("key")).sortWithinPartitions("key")
    return rows.mapInArrow(_linked(radius, 1, PAIR_ROWS), "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component): each row's fingerprint and the smallest id reachable over links."""
    prints = materialize(fingerprints(docs, id_col, text_col, width))
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep")))
    members = connected(links(classes, radius))
    root = classes.join(members.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("root", "rep").alias("component"))
    return prints.join(root, "fp", "left")


def _alike(sets: list[np.ndarray], prints: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join one key's sets as all its pairs of a Jaccard similarity of SHARED / OF or more would. As
    in _forest each set, once reached, is compared with all that no tree has reached yet: by pivots, then by the
    fingerprints' bits, then what is left by the sets. References are fingerprints of the key, since those of no relation
    to it are all equally far at a radius as wide as this."""
    order = np.argsort(reps, kind="stable")
    sets, prints, reps = [sets[i] for i in order.tolist()], prints[order], reps[order]
    table = distances(prints, prints[np.unique(np.linspace(0, len(prints) - 1, len(PIVOTS)).astype(np.int64))])
    size = np.array([len(x) for x in sets])
    bounds = np.r_[0, np.cumsum(size)]
    _, item = np.unique(np.concatenate(sets), return_inverse=True)
    has = np.zeros(len(item) + 1, bool)
    rest = np.arange(len(sets))
    left, right = [], []
    while len(rest):
        open_, rest = [int(rest[0])], rest[1:]
        while open_ and len(rest):
            i = heapq.heappop(open_)
            some = np.flatnonzero(near(prints[i : i + 1], table[i : i + 1], prints[rest], table[rest], WIDE_RADIUS))
            n = size[rest[some]]
            at = np.arange(n.sum()) + np.repeat(bounds[rest[some]] - np.cumsum(n) + n, n)
            mine = item[bounds[i] : bounds[i + 1]]
            has[mine] = True
            both = np.bincount(np.repeat(np.arange(len(some)), n)[has[item[at]]], minlength=len(some))
            has[mine] = False
            hit = np.zeros(len(rest), bool)
            hit[some[OF * both >= SHARED * (size[i] + n - both)]] = True
            new, rest = rest[hit], rest[~hit]
            left.append(np.full(len(new), reps[i]))
            right.append(reps[new])
            for j in new.tolist():
                heapq.heappush(open_, j)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, rep, set, fingerprint) in the order of key: the links within each key."""
    now, reps, sets, prints = None, [], [], []

    def found() -> pa.RecordBatch:
        a, b = _alike(sets, np.stack(prints), np.array(reps, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    for batch in batches:
        for key, rep, one, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            if key != now:
                if len(sets) > 1:
                    yield found()
                now, reps, sets, prints = key, [], [], []
            reps.append(rep)
            sets.append(np.frombuffer(one.as_py(), np.uint64))
            prints.append(np.frombuffer(bits.as_py(), np.uint64))
    if len(sets) > 1:
        yield found()


def _groups(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, th, root, component) of the rows with an id: a hash of the text, the number of the group of similar texts,
    and its smallest id."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            at = 0
            for hashes, offs in _sets(batch.column(1), width):
                n = len(offs) - 1
                keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(_band_keys(hashes, offs).view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(2).slice(at, n), pa.array(_digests(hashes, offs), pa.binary()), keys], ["id", "th", "digest", "keys"])
                at += n

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for hashes, offs in _sets(batch.column(1), width):
                n = len(offs) - 1
                ids, digests, keys = (batch.column(k).slice(at, n).to_pylist() for k in (0, 2, 3))
                prints = _set_prints(hashes, offs)
                for i, digest in enumerate(_digests(hashes, offs)):
                    if digest == digests[i]:  # of rows of one id, those of the class
                        one = hashes[offs[i] : offs[i + 1]].tobytes()
                        for k in range(0, len(keys[i]), 8):
                            some = keys[i][k : k + 8]
                            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([ids[i]] * len(some), pa.int64()), pa.array([one] * len(some), pa.binary()), pa.array([prints[i].tobytes()] * len(some), pa.binary())], ["key", "rep", "shingles", "print"])
                at += n

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    made = materialize(rows.select("id", "text", F.xxhash64("text").alias("th")).mapInArrow(keyed, "id long, th long, digest binary, keys array<long>"))
    classes = made.groupBy("digest").agg(F.min("id").alias("least"), F.first("keys").alias("keys")).withColumn("rep", F.monotonically_increasing_id())
    classes = materialize(classes)
    pairs = classes.select("rep", "digest", F.explode("keys").alias("key"))
    # A key of one class links nothing, and of keys with the same classes one is enough.
    held = pairs.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("which")).filter("n > 1")
    held = held.groupBy("n", "which").agg(F.min("key").alias("key"))
    wanted = materialize(pairs.join(held, "key").groupBy("rep", "digest").agg(F.collect_list("key").alias("keys")))
    # One text of each class is spelt out: of those of its smallest id, all of which have the same set or are told apart.
    owners = classes.select("rep", F.col("least").alias("id")).join(wanted, "rep")
    owners = materialize(owners)
    # Dealt out before the join in any case, so that no task has two workers, one for the sieve and one for the sets.
    asked = rows.filter(sieve(owners.select("id"))(F.col("id"))).repartition(F.col("id"))
    sets = asked.join(owners, "id").select("rep", "text", "digest", "keys").mapInArrow(spread, "key long, rep long, shingles binary, print binary")
    found = sets.repartition(F.col("key")).sortWithinPartitions("key", "rep").mapInArrow(_verified, "src long, dst long").distinct()
    members = materialize(classes.select("rep", "digest", "least").join(connected(found).withColumnRenamed("node", "rep"), "rep", "left").select("digest", "least", F.coalesce("root", "rep").alias("root")))
    root = members.join(members.groupBy("root").agg(F.min("least").alias("component")), "root").select("digest", "root", "component")
    return made.select("id", "th", "digest").join(root, "digest", "left").select("id", "th", "root", "component")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """(id, component): for each row with an id the smallest id reachable over links between texts whose sets of word
    shingles have a Jaccard similarity of 0.8 or more. Min-hashes bring candidates together, SimHash fingerprints and
    their pivot tables thin them, the sets decide."""
    return _groups(docs, id_col, text_col, width).select("id", "component")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """docs with one row (the smallest id) of each group of similar texts. Rows without an id stay. Rows of one id whose
    texts are not similar stay; of those that are, the first by text and then by the other columns stays."""
    found = materialize(_groups(docs, id_col, text_col, width))
    gid, gth, groot, order = (unused(docs, n) for n in ("gone_id", "gone_text", "root", "order"))
    th = F.xxhash64(F.col(text_col).cast("string"))
    gone = materialize(found.filter("id <> component").select(F.col("id").alias(gid), F.col("th").alias(gth)).distinct())
    again = found.filter("id = component").groupBy("id", "root").agg(F.count("*").alias("n")).filter("n > 1").select("id", "root")
    again = materialize(found.join(again, ["id", "root"]).select(F.col("id").alias(gid), F.col("th").alias(gth), F.col("root").alias(groot)).distinct())
    same = (F.col(id_col).cast("long") == F.col(gid)) & (th == F.col(gth))
    few = gone.unionByName(again.select(gid, gth))
    may_go = sieve(few.select(gid))(F.col(id_col).cast("long"))  # the others are not dealt anew
    some = docs.filter(may_go)
    once = docs.filter(F.col(id_col).isNotNull() & ~may_go).unionByName(some.join(few, same, "left_anti"))
    ranked = some.join(again, same).withColumn(order, F.row_number().over(W.partitionBy(gid, groot).orderBy(text_col, *[F.xxhash64(F.col(c)) for c in docs.columns])))
    first = ranked.filter(F.col(order) == 1).select(docs.columns)
    return once.select(docs.columns).unionByName(first).unionByName(docs.filter(F.col(id_col).isNull()))
