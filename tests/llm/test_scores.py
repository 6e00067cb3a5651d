import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from plain import Plain, plain_statistics
from pyspark.sql import functions as F

from entwine.llm import entry, quality, toxicity

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{D}/labels.parquet").collect()}


@pytest.mark.parametrize(("query", "label", "modulus", "held", "least"), [(entry.op8_quality, "quality", 5, 0, 0.93), (entry.op10_toxicity, "toxic", 3, 1, 0.9)])
def test_held_out_accuracy(spark, labels, query, label, modulus, held, least):
    got = query(spark, D).collect()
    assert len(got) == spark.read.parquet(f"{D}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) and 0 <= r.score <= 1 for r in got)
    out = [r.predicted == labels[r.doc_id][label] for r in got if r.held_out and r.doc_id in labels]
    assert sum(out) / len(out) >= least


def toy(make):
    rng = random.Random(4)
    plain = lambda n: " ".join(rng.choice(["tree", "river", "stone", "cloud", "grass", "bird"]) for _ in range(n))
    texts = [plain(40) + (" idiot scum idiot moron " if i % 3 == 0 else " ") + plain(20) for i in range(90)]
    return texts, [(i, int(i % 3 == 0)) for i in range(90)]


def test_toxic_words_are_learnt(make, spark):
    texts, known = toy(make)
    labels = spark.createDataFrame(known[:60], "doc_id long, toxic int")
    rows = make([*texts, None, "", "x" * 30000, "idiot " * 50])
    got = {r.id: r for r in toxicity.score(rows, labels).collect()}
    assert all(got[i].toxic == bool(t) for i, t in known[60:]) and got[93].toxic
    assert got[90].score == got[91].score and not got[90].toxic
    again = make([(7, texts[0], "a"), (7, texts[0], "b")]).withColumn("score", F.lit("s"))
    assert {r.score for r in toxicity.score(again, labels).collect()} == {0.0}  # one class only
    assert toxicity.accepted(rows, labels).columns == rows.columns


def test_no_labels_and_no_rows(make, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert [r.toxic for r in toxicity.score(make(["a"]), none).collect()] == [False]
    assert [r.score for r in quality.score(make(["a"]), none).collect()] == [0.5]
    some = spark.createDataFrame([(0, 1, 1), (1, 0, 0)], "doc_id long, toxic int, quality int")
    assert toxicity.score(make([]), some).count() == 0 and quality.score(make([]), some).count() == 0


def test_quality(make, spark):
    rng = random.Random(9)
    good = [" ".join(rng.choice(["Tree", "river", "stone.", "cloud", "grass,", "bird"]) for _ in range(80)) for _ in range(40)]
    bad = [" ".join(rng.choice(["TREE!!", "###", "$$$a", "|"]) for _ in range(80)) for _ in range(40)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80) if i % 4], "doc_id long, quality int")
    rows = make([*good, *bad, None, "", " \n", "é" * 20000])
    got = {r.id: r for r in quality.score(rows, labels).collect()}
    assert all(got[i].good == (i < 40) for i in range(80)) and got[80].score == got[81].score == got[82].score
    clash = make([(1, good[0], "a"), (1, good[0], "a")]).withColumn("words", F.lit(1)).withColumn("good", F.lit(1))
    assert len({r.score for r in quality.score(clash, labels).collect()}) == 1


def test_models_against_dictionaries(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ab", "c", "é", "xyz", "q", "ünd"]) for _ in range(rng.randrange(1, 6)))
    texts = [(" ".join(word() for _ in range(30)), i % 2, i // 2 % 2) for i in range(40)]
    sums = toxicity._collected(toxicity.ngram_sums(spark.createDataFrame(texts, "text string, toxic int, fold int").repartition(3)))
    probes = [word() for _ in range(60)] + ["unseen", "zz", "a" * 40]
    buf = np.frombuffer("".join(probes).encode(), np.uint8)
    size = np.array([len(w.encode()) for w in probes])
    ends = np.cumsum(size)
    for folds in ((0, 1), (0,), (1,)):
        got = toxicity.Model(sums, folds).ratios(buf, ends - size, ends)
        plain = Plain([(w, c) for t, c, f in texts for w in t.split()])
        other = Plain([(w, c) for t, c, f in texts if f in folds for w in t.split()])
        plain.top, plain.by = other.top, other.by  # a fold has its own counts, the lower orders are shared
        assert np.allclose(got, [plain.ratio(w) for w in probes], atol=2e-3), folds


def test_table_finds_only_its_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 60, 5000).astype(np.uint64))
    table = toxicity._Table(keys, np.arange(1, len(keys) + 1))
    assert (table.get(keys)[0] == np.arange(1, len(keys) + 1)).all() and not table.get(keys + np.uint64(1))[0].any()
    assert not toxicity._Table(np.zeros(0, np.uint64), np.zeros(0)).get(keys)[0].any()


def test_quality_against_plain_densities(make, spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["Tree", "river", "stone.", "cloud", "grass,", "bird\n", "é9"]) for _ in range(rng.randrange(3, 80)))
    bad = lambda: " ".join(rng.choice(["TREE!!", "###", "$$$a", "|", "for", "77"]) for _ in range(rng.randrange(3, 80)))
    texts = [good() if i % 3 else bad() for i in range(120)] + [None, "", " \n "]
    known = [(i, int(i % 3 > 0)) for i in range(100)]
    x = np.array([plain_statistics(t or "") for t in texts])
    assert np.allclose(quality.statistics(pa.array(texts, pa.string())), x)
    y = np.array([k for _, k in known])
    own = [np.cov(x[:100][y == c].T, bias=True) for c in (0, 1)]
    pooled = sum(own[c] * (y == c).sum() for c in (0, 1)) / 100
    density = []
    for c in (0, 1):
        s = (1 - quality.POOLED) * own[c] + quality.POOLED * pooled
        s = (1 - quality.DIAGONAL) * s + quality.DIAGONAL * np.diag(np.diag(s)) + 1e-4 * np.eye(len(s))
        d = x - x[:100][y == c].mean(axis=0)
        density.append(-0.5 * (np.einsum("ij,ij->i", d, np.linalg.solve(s, d.T).T) + np.linalg.slogdet(s)[1]))
    n = np.expm1(x[:, 0]) + 1
    z = (density[1] - density[0]) * n / (n + quality.EVIDENCE_WORDS) / quality.TEMPERATURE + math.log(y.sum() / (100 - y.sum()))
    got = {r.id: r for r in quality.score(make(texts), spark.createDataFrame(known, "doc_id long, quality int")).collect()}
    assert np.allclose([got[i].score for i in range(len(texts))], 1 / (1 + np.exp(-np.clip(z, -40, 40))), atol=1e-6)
    assert not any(got[i].good for i in (120, 121, 122))  # a text without words is none of the good ones


def test_held_out_toxic_texts_are_caught(spark):
    d = "/root/testdata/sf0.1"
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [r for r in entry.op10_toxicity(spark, d).collect() if r.held_out and r.doc_id in known]
    toxic = [r.predicted for r in held if known[r.doc_id]]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(r.predicted for r in held if not known[r.doc_id]) <= 0.01 * (len(held) - len(toxic))
