import random

import pyarrow as pa
import pytest
from plain import PlainToxicity, groups, holds, redacted
from pyspark.sql import functions as F

import corpus_pipeline
from entwine.llm import decontaminate, pieces, secrets, simhash, toxicity

D = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, docs):
    now, columns = docs, docs.columns
    kept = {r.doc_id: r.text for r in now.collect()}
    labels, bench = spark.read.parquet(f"{D}/labels.parquet"), spark.read.parquet(f"{D}/benchmark.parquet")
    toxic = {r.id for r in toxicity.score(docs, labels).collect() if r.toxic}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, D)
        rows = now.collect()
        now = spark.createDataFrame(rows, now.schema)
        got = {r.doc_id: r.text for r in rows}
        assert len(got) == len(rows) and set(got) <= set(kept)
        if name != "pieces":
            assert now.columns == columns
        if name == "toxicity":
            assert set(kept) - set(got) == toxic
        if name == "simhash":
            assert len(set(got.values())) == len(got)
        if name == "decontaminate":
            assert decontaminate.matches(now, bench).count() == 0
        if name == "secrets":
            assert not any(secrets.find(t or "", list(secrets.BASE)) for t in got.values()) and set(got) == set(kept)
        if name == "pieces":
            assert pieces.pieces(pieces.DEFAULT_MODEL).encode(pa.array([r.text for r in rows])).to_pylist() == [r.ids for r in rows] and set(got) == set(kept)
        kept = got
    whole = corpus_pipeline.run(spark, D)
    assert {r.doc_id: r.text for r in whole.collect()} == kept and simhash.similar(whole).filter("id <> component").count() == 0


LABELS, BENCH = "doc_id long, quality int, toxic int", "item_id long, text string"


def planted(rng):
    """Texts of every sort a stage looks for."""
    words = ["tree", "river", "stone", "cloud", "grass", "bird", "moss", "fern", "wind", "shore"]
    plain = lambda n: " ".join(f"{rng.choice(words)}{rng.choice('aeiou')}{rng.randrange(50)}" for _ in range(n))
    items = [plain(25) for _ in range(3)] + ["two words"]
    texts = [plain(60) for _ in range(24)]
    texts += [plain(30) + " idiot scum moron loser idiot " + plain(10) for _ in range(14)]
    texts += [texts[0], texts[1].upper(), texts[2] + " end", texts[3].replace(texts[3].split()[30], "changed"), plain(5) + " " + texts[4]]
    texts += [plain(10) + " " + items[0] + " " + plain(9), plain(3) + " two words " + plain(4), " ".join(w if k % 8 else "zz" for k, w in enumerate(items[1].split()))]
    texts += [plain(20) + " token = 'abcdefgh1' AKIA" + "B" * 14 + " " + "f" * 40, None, "", " ", "é" * 3000, "x " * 4000]
    return texts, items


def test_run_against_plain_versions(spark, make, tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    texts, items = planted(random.Random(21))
    make([(i, t, f"s{i}") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(bool(t) and "idiot" in t)) for i, t in enumerate(texts[:36])]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")
    folds = {r.i: r.f for r in spark.range(len(texts)).select(F.col("id").alias("i"), F.pmod(F.xxhash64("id"), F.lit(2)).alias("f")).collect()}
    model = PlainToxicity([(texts[i], c, folds[i]) for i, _, c in labels])
    kept = {i: t for i, t in enumerate(texts) if model.score(t) < toxicity.THRESHOLD}
    assert len(texts) - len(kept) >= 12
    root = groups(kept)
    kept = {i: t for i, t in kept.items() if root[i] == i}
    kept = {i: t for i, t in kept.items() if not any(holds(t, x) for x in items)}
    kept = {i: None if t is None else redacted(t) for i, t in kept.items()}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i: r.text for i, r in got.items()} == kept
    assert {i: r.ids for i, r in got.items()} == {i: library.encode(t or "") for i, t in kept.items()}
    assert all(r.n_chars == (None if kept[i] is None else len(kept[i])) for i, r in got.items())


def test_empty_tables_and_other_columns(spark, make, tmp_path):
    for name, documents in (("none", make([])), ("some", make([(1, "a b c", "x"), (1, "a b c", "x"), (None, None, None)]))):
        d = str(tmp_path / name)
        for k, c in enumerate(("found", "root", "gone_id", "further", "order", "ids", "th")):
            documents = documents.withColumn(c, F.lit(k))
        documents.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], LABELS).write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([], BENCH).write.parquet(f"{d}/benchmark.parquet")
        got = corpus_pipeline.run(spark, d)
        assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "ids" in got.columns
        assert got.count() == (0 if name == "none" else 2)  # the equal rows of an id are one
