import math
import random
from itertools import combinations

from plain import holds
from pyspark.sql import functions as F

from entwine.llm import decontaminate as D


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_substitutions_are_tolerated(make, spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(30)]
    changed = item[:]
    for k in (4, 11, 18, 25):
        changed[k] = word()
    rubbish = [w if i % 3 else word() for i, w in enumerate(item)]
    pad = lambda x: " ".join([word() for _ in range(20)] + x + [word() for _ in range(20)])
    rows = make([pad(item), pad(changed).upper(), pad(rubbish), pad([]), None, "", " ".join(item[:16]), " ".join(item[:8]), " ".join(item)])
    bench = items(spark, [" ".join(item), "too short", None, " ".join(item)])
    got = {r.id: r["items"] for r in D.contaminated(rows, bench).collect()}
    assert got == {0: [0, 3], 1: [0, 3], 2: [], 3: [], 4: [], 5: [], 6: [0, 3], 7: [], 8: [0, 3]}
    assert sorted(r.doc_id for r in D.clean(rows, bench).collect()) == [2, 3, 4, 5, 7]
    assert not any(w in D.contaminated(rows, bench)._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow", "Pandas"))


def test_blocks_give_what_one_block_gives(docs, spark, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(map(tuple, D.matches(docs, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_HASHES", 700)
    assert sorted(map(tuple, D.matches(docs, bench).collect())) == one and one


def test_edges(make, spark):
    bench = items(spark, ["one two three four five six seven eight nine ten eleven"])
    assert D.contaminated(make([]), bench).count() == 0
    text = "one two three four five six seven eight nine ten eleven"
    assert [r["items"] for r in D.contaminated(make([text]), items(spark, [])).collect()] == [[]]
    rows = make([(1, text, "a"), (1, "clean", "a"), (None, text, "a"), (None, "clean", "a")]).withColumn("hash", F.lit(1)).withColumn("words", F.lit(1))
    assert [r["items"] for r in D.contaminated(rows, bench).filter("id = 1").collect()] == [[0], [0]]
    assert [r["items"] for r in D.contaminated(rows, bench).collect()] == [[0]] * 4  # rows without an id are one id
    clash = rows.withColumn("found", F.lit(1)).withColumn("_found", F.lit(1)).withColumn("same", F.lit(1)).withColumn("here", F.lit(1))
    assert D.clean(clash, bench).count() == 0 and D.clean(make(["clean"]).withColumn("found", F.lit(1)), bench).columns[-1] == "found"
    assert D.clean(rows, bench).count() == 0 and D.clean(make(["clean"]), bench).count() == 1


def test_masks_miss_nothing_that_is_accepted():
    for n in range(D.SHORT, D.OVERLAP + 1):
        for gone in combinations(range(n), n - math.ceil(n * D.SHARE)):
            assert any(all(a + k not in gone for k in mask) for mask in D.MASKS for a in range(n - mask[-1])), (n, gone)


def test_against_brute_force(make, spark):
    rng = random.Random(12)
    bench = ["", None, "alpha", "alpha beta", "beta alpha beta", "a b c d e", "a b c d e f g h"]
    bench += [" ".join(f"w{rng.randrange(40)}" for _ in range(n)) for n in (9, 10, 12, 14, 15, 20, 40) for _ in range(3)]
    texts = [None, "", "alpha", "Beta, ALPHA! beta", "x a b c d e y", "x a b c d z", "a b c d e f g h", "a b c d e f g x", "w1 " * 3000 + "alpha"]
    for item in bench[7:]:
        for subs in (0, 1, 2, 3, 4):
            ws = item.split()
            for k in rng.sample(range(len(ws)), subs):
                ws[k] = "zz"
            cut = ws[rng.randrange(3) :] if subs % 2 else ws
            texts.append(" ".join([f"v{rng.randrange(40)}" for _ in range(rng.randrange(12))] + cut + [f"v{rng.randrange(40)}" for _ in range(rng.randrange(12))]))
    got = {r.id: r["items"] for r in D.contaminated(make(texts), items(spark, bench)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [j for j, x in enumerate(bench) if holds(t, x)], (i, t)
