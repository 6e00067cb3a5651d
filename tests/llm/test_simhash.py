import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from entwine.llm import entry, simhash, xxh64
from entwine.llm.components import connected


def brute(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, edges):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_xxh64_of_spans():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 256, 4000).astype(np.uint8)
    starts = rng.integers(0, 3000, 500)
    ends = starts + rng.integers(0, 200, 500)
    want = [xxhash.xxh64_intdigest(buf[a:b].tobytes(), 42) for a, b in zip(starts, ends, strict=True)]
    assert xxh64.xxh64_spans(buf, starts, ends, 42).tolist() == want


def test_fingerprints_are_those_of_the_definition():
    texts = [None, "", " \t\n", "a", "A b", "\n a\x0b b  c d ", "x" * 300 + " y z" + " É" * 5, "a b c d " * 3, "w " * 3000, "Ünïcode words häve Ä too"]
    assert simhash._fingerprints(pa.array(texts, pa.string()), 3)[:, 0].tolist() == [brute(t) for t in texts]


def test_links_lose_none(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(6))) for b in base for _ in range(6)})
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    got = {tuple(sorted((r.src, r.dst))) for r in simhash.links(rows).collect()}
    assert roots(len(fps), got) == roots(len(fps), near) and got <= {tuple(sorted(x)) for x in near}


def test_a_large_key_gives_the_same_components():
    rng = random.Random(2)
    fps = np.array(sorted({sum(1 << k for k in rng.sample(range(20), rng.randrange(7))) for _ in range(400)}), np.uint64)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 2]
    a, b = simhash._forest(fps[:, None], np.arange(len(fps)), 2)
    assert roots(len(fps), zip(a, b, strict=True)) == roots(len(fps), near) and len(a) < len(fps)


@pytest.mark.parametrize("n", [1, 7])
def test_components(spark, n):
    edges = [(i, i + 1) for i in range(0, 30)] + [(50, 40), (41, 50), (7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "src long, dst long").repartition(n)).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 50: 40}
    assert connected(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_near_duplicates(make):
    t = "one two three four five six seven eight nine ten"
    got = {r.id: r for r in simhash.near_duplicates(make([t, None, t.upper(), "", "other words here are not alike at all", "  "])).collect()}
    assert [got[i].component for i in range(6)] == [0, 1, 0, 1, 4, 1] and got[1].fp == 0
    assert simhash.near_duplicates(make([])).count() == 0
    clash = make([(3, t, "a"), (3, t, "b")]).withColumn("fp", F.lit(1)).withColumn("component", F.lit("x"))
    assert [(r.id, r.component) for r in simhash.near_duplicates(clash).collect()] == [(3, 3)] * 2


def test_deduplicated(make):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    copy = words[:]
    copy[200] = "changed"
    other = [f"v{rng.randrange(10**6)}" for _ in range(400)]
    rows = make([" ".join(words), " ".join(copy), " ".join(other), " ".join(words), None, ""])
    assert sorted(r.doc_id for r in simhash.deduplicated(rows).collect()) == [0, 2, 4]
    assert simhash.deduplicated(rows).columns == rows.columns
    nameless = make([(None, "a b c", "x"), (None, "a b c", "x"), (1, "a b c", "x")])
    assert simhash.deduplicated(nameless).count() == 3


def jaccard(a, b, width=5):
    a, b = ({tuple(t.split()[i : i + width]) for i in range(max(1, len(t.split()) - width + 1))} for t in (a, b))
    return len(a & b) / len(a | b)


def test_similar_is_the_exact_jaccard_of_0_8(make):
    rng = random.Random(3)
    texts = []
    for edits in [0, 1, 2, 3, 4, 5, 6, 7] * 12:
        words = [f"w{rng.randrange(10**6)}" for _ in range(184)]
        copy = words[:]
        for at in rng.sample(range(8, 176), edits):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts += [" ".join(words), " ".join(copy)]
    for _ in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(9)]
        texts += [" ".join(words), " ".join(words[:8])]  # 4 of 5 shingles
    got = {r.id: r.component for r in simhash.similar(make(texts)).collect()}
    for i in range(0, len(texts), 2):
        assert got[i] == i and (got[i + 1] == i) == (jaccard(texts[i], texts[i + 1]) >= 0.8), i


def test_sets_are_thinned_by_fingerprints_and_pivots(monkeypatch):
    rng = np.random.default_rng(5)
    sets = []
    for n in (4, 8, 12, 40, 180) * 30:
        whole = np.unique(rng.integers(0, 1 << 64, n + n // 4, dtype=np.uint64))
        sets += [np.sort(whole[rng.permutation(len(whole))[:n]]), whole]  # a similarity of 0.8
    offs = np.r_[0, np.cumsum([len(x) for x in sets])]
    prints = simhash._set_prints(np.concatenate(sets), offs)
    for i in (0, 9, 31):
        for k in (0, simhash.WORDS - 1):
            h = simhash.mix((sets[i] ^ simhash._TURN[k]) * simhash._SPIN[k]).tolist()
            assert int(prints[i, k]) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert max(np.bitwise_count(prints[i] ^ prints[i + 1]).sum() for i in range(0, len(sets), 2)) <= simhash.WIDE_RADIUS
    want = [(i, i + 1) for i in range(0, len(sets), 2)]
    reps, seen = np.arange(len(sets)), []
    near = simhash.near
    monkeypatch.setattr(simhash, "near", lambda *a: seen.append(near(*a)) or seen[-1])
    assert sorted(zip(*(x.tolist() for x in simhash._alike(sets, prints, reps)), strict=True)) == want
    assert sum(x.sum() for x in seen) < 1.1 * len(want) < sum(len(x) for x in seen) / 50  # of all pairs few reach the sets
    prints[1] = ~prints[0]
    assert sorted(zip(*(x.tolist() for x in simhash._alike(sets, prints, reps)), strict=True)) == want[1:]


def test_repeated_lines_link_nothing(make):
    rng = random.Random(4)
    line = [f"r{k}" for k in range(7)] * 100
    texts = [" ".join(line + [f"w{rng.randrange(10**6)}" for _ in range(150)]) for _ in range(6)]
    assert jaccard(texts[0], texts[1]) < 0.1
    assert {r.id: r.component for r in simhash.similar(make(texts)).collect()} == {i: i for i in range(6)}
    assert simhash.deduplicated(make(texts)).count() == 6


def test_rows_of_one_id(make):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join(reversed(words))
    rows = make([(1, a, "x"), (1, b, "x"), (1, a, "y"), (2, a, "x"), (2, "else", "x"), (None, a, "x"), (None, None, "x")]).withColumn("root", F.lit(1)).withColumn("gone_id", F.lit(2))
    first = None
    for n in (1, 5):
        got = sorted((str(r.doc_id), str(r.text), r.source) for r in simhash.deduplicated(rows.repartition(n)).collect())
        assert [g[:2] for g in got] == [("1", a), ("1", b), ("2", "else"), ("None", "None"), ("None", a)]
        first = first or got[0]
        assert got[0] == first  # the same row however the table is dealt


def test_a_key_that_spans_batches():
    key = np.repeat([1, 2, 3], [5, 40, 1])
    rep, fp = np.arange(46), np.r_[np.arange(5), np.full(40, 1 << 20) + np.arange(40) % 4, 9]
    batch = lambda a, b: pa.RecordBatch.from_arrays([pa.array(x[a:b].astype(np.int64)) for x in (key, rep, fp)], ["key", "rep", "fp"])
    want = None
    for size in (46, 1, 7, 20):
        out = simhash._linked(1, 1, 8)(iter([batch(k, min(46, k + size)) for k in range(0, 46, size)] + [batch(0, 0)]))
        links = [(a, b) for o in out for a, b in zip(o.column(0).to_pylist(), o.column(1).to_pylist(), strict=True)]
        got = roots(46, links)
        want = want or got
        assert got == want


def test_whole_query_against_the_definition(spark, make, tmp_path):
    rng = random.Random(9)
    texts = [None, "", "a", "A", " a\t", "a b", "x" * 5000]
    for _ in range(25):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([4, 30, 200]))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            copy = words[:]
            copy[rng.randrange(len(copy))] = "changed"
            texts.append("  ".join(copy))
    make(texts).write.parquet(f"{tmp_path}/documents.parquet")
    fps = [brute(t) for t in texts]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = roots(len(texts), near)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in entry.op6_simhash(spark, str(tmp_path)).collect()}
    assert got == {i: (f"{fps[i]:016x}", root[i]) for i in range(len(texts))} and len(near) > 10
