import numpy as np
from pyspark.sql import functions as F

from entwine.llm import chroma as C
from entwine.llm import entry


def tune(seed, n=40):
    rng = np.random.default_rng(seed)
    t = np.arange(1000) / C.RATE
    return np.concatenate([np.sin(2 * np.pi * 220 * 2 ** (k / 12) * t) * 0.5 for k in rng.integers(0, 24, n)])


def found(asked, known):
    return {(r["query"], r["class"]): r for r in C.search(asked, C.classes(known)).collect()}


def prints(spark, rows):
    return spark.createDataFrame(rows, "id long, values array<long>")


def test_alignment(spark):
    a, b = tune(1), tune(2)
    noisy = np.concatenate([np.zeros(C.HOP * 5), a]) + np.random.default_rng(0).normal(0, 0.01, len(a) + C.HOP * 5)
    rows = [(0, C.encode_pcm(a)), (1, C.encode_pcm(noisy)), (2, C.encode_pcm(b)), (3, None), (4, b""), (5, b"\x01"), (6, C.encode_pcm(a))]
    media = spark.createDataFrame(rows, "id long, audio binary").withColumn("values", F.lit("clash"))
    all_ = C.fingerprints(media, "id", "audio")
    got = found(all_.filter("id = 0"), all_)
    assert set(got) == {(0, 0), (0, 1)}
    assert got[0, 0].offset == 0 and got[0, 0].bit_error == 0 and got[0, 1].offset == 5 and got[0, 1].bit_error < 0.09
    assert {r.id: r["class"] for r in C.classes(all_).collect()} == {0: 0, 1: 1, 2: 2, 6: 0}


def test_filters_against_sums_over_the_image():
    samples = tune(4, 20)
    image = C.chroma(samples)
    got = C.fingerprint(samples)
    for x in (0, 7, len(got) - 1):
        want = 0
        for k in range(16):
            width, low, height = C.WIDTHS[k % 4], (5 * k) % 12, 2 + 2 * (k // 4 % 3)
            area = lambda t0, t1, c0, c1: sum(image[t, c % 12] for t in range(x + t0, x + t1) for c in range(low + c0, low + c1))
            h, m = width // 2, height // 2
            if k % 3 == 0:
                p, q = area(0, h, 0, height), area(h, 2 * h, 0, height)
            elif k % 3 == 1:
                p, q = area(0, width, 0, m), area(0, width, m, 2 * m)
            else:
                p, q = area(0, h, 0, m) + area(h, 2 * h, m, 2 * m), area(h, 2 * h, 0, m) + area(0, h, m, 2 * m)
            v = np.log1p(p) - np.log1p(q)
            want |= (0, 1, 3, 2)[sum(v >= s for s in (-C.STEP, 0, C.STEP))] << 2 * k
        assert int(got[x]) == want


def seeds(v):
    pairs = [(v[t], v[t + C.GAP]) for t in range(len(v) - C.GAP)]
    return {t: p for t, p in enumerate(pairs) if t == 0 or p != pairs[t - 1]}


def brute(q, v):
    """The best alignment over all offsets, of those with SKIPPED + SEEDS equal seeds or more."""
    best = None
    one, two = seeds(q), seeds(v)
    for off in range(-len(q) + 1, len(v)):
        pairs = [(q[t], v[t + off]) for t in range(len(q)) if 0 <= t + off < len(v)]
        hits = sum(x == y for x, y in pairs)
        error = sum(int(x ^ y).bit_count() for x, y in pairs) / (32 * len(pairs))
        equal = sum(two.get(t + off) == s for t, s in one.items())
        if equal >= C.SKIPPED + C.SEEDS and len(pairs) >= C.LEAST_OVERLAP * min(len(q), len(v)) and hits >= C.LEAST_HITS * len(pairs) and error <= C.MOST_ERROR:
            best = min(best or (1,), (-hits, abs(off), -off, round(error, 9)))
    return best


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    some = [rng.integers(0, 1 << 32, 90) for _ in range(6)]
    some += [np.concatenate([rng.integers(0, 1 << 32, 11), some[0]]), some[1][13:], np.where(np.arange(90) % 4 == 0, some[2] ^ 7, some[2]), np.full(90, 9), np.full(120, 9), rng.integers(0, 3, 90)]
    rows = [(i, [int(x) for x in v]) for i, v in enumerate(some)]
    got = found(prints(spark, rows), prints(spark, rows))
    for i, q in enumerate(some):
        for j, v in enumerate(some):
            want = brute(q, v)
            if want:
                r = got[i, j]
                assert (-r.hits, abs(r.offset), -r.offset, round(r.bit_error, 9)) == want, (i, j)
    assert {(0, 6), (6, 0), (1, 7), (2, 8)} <= set(got) and (0, 1) not in got and (9, 10) not in got  # a silence has one seed


def test_few_and_frequent_seeds_are_enough(spark):
    rng = np.random.default_rng(6)
    one = rng.integers(0, 1 << 32, 90)
    equal = np.isin(np.arange(90), [0, 1, 2, 3, 24, 25, 26, 27, *range(60, 66)])  # four seeds, 14 integers
    some = [one, np.where(equal, one, one ^ 1)]
    some += [np.where(equal, one, rng.integers(0, 1 << 32, 90)) for _ in range(5)]  # the same seeds, but other tunes
    rows = [(i, [int(x) for x in v]) for i, v in enumerate(some)]
    got = found(prints(spark, rows[:1]), prints(spark, rows))
    assert set(got) == {(0, 0), (0, 1)} and got[0, 1].hits == 14 and got[0, 1].offset == 0


def test_recall_and_precision_of_noisy_excerpts(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 0.125, 64)]) for i in range(3000)]
    rows += [(3001, rows[100][1]), (3002, rows[7][1])]  # copies
    rows += [(4001 + i, [x + float(rng.normal(0, 0.03)) for x in rows[100 * i][1]]) for i in range(30)]  # near vectors sound alike, but are other tunes
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = entry.op5_chroma(spark, str(tmp_path)).collect()
    links = {(r.query_id, r.class_id) for r in got if r.query_id is not None}
    right = {(i, i) for i in range(0, 3000, 100)}
    assert len(links & right) >= 0.9 * len(right) and links <= right
    assert {(r.vec_id, r.class_id) for r in got if r.query_id is None} == {(3001, 100), (3002, 7)}


def test_edges(spark):
    empty = C.fingerprints(spark.createDataFrame([], "id long, audio binary"), "id", "audio")
    assert C.search(empty, C.classes(empty)).count() == 0
    assert len(C.fingerprint(np.full(30000, np.nan))) == len(C.fingerprint(np.zeros(30000))) > 0
    long = C.fingerprint(np.tile(tune(5), 20))
    assert len(long) > 3000
    v = spark.createDataFrame([(0, [0.1, 0.3, -0.2, 0.0] * 10), (1, None), (2, []), (0, [0.1, 0.3, -0.2, 0.0] * 10), (None, [0.3, -0.3, 0.2, 0.1] * 10)], "vec_id long, embedding array<float>")
    all_ = C.fingerprints(v, "vec_id", "embedding", C.tune)
    got = C.search(all_, C.classes(all_)).collect()
    assert sorted((str(r["query"]), str(r["class"])) for r in got) == [("0", "0"), ("0", "0"), ("None", "None")]  # repeated ids keep their rows
