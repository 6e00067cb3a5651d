"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chroma, decontaminate, extract, oracle, pieces, pii, quality, repeats, secrets, toxicity
from .common import materialize, table
from .simhash import near_duplicates


def _joined(spans, *kinds):
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _n(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        F.col("id").alias("doc_id"),
        *[_n(spans, k).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(_joined(spans, *secrets.BASE), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["verdict"] == "copied_example")).cast("long").alias("n_copied"),
    )


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.removed(table(spark, sf_dir, "documents"))
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda x, s: x + s["b"] - s["a"])
    return found.select(F.col("id").alias("doc_id"), "n_bytes", n.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.select(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["base"])
    return found.select(
        F.col("id").alias("doc_id"),
        *[_n(base, k).alias(f"n_{k}") for k in pii.GENERATORS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: ~s["base"])).cast("long").alias("n_added"),
        F.col("n_refused").cast("long").alias("n_refused"),
    )


def op5_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query recordings are noisy excerpts of the vectors whose ids are divisible by 100; each is searched for in the
    whole tunes of all vectors. Rows: (query_id, class_id, ..) of each alignment with a class of equal fingerprints,
    and (vec_id, class_id) of each recording that is a copy of its class's smallest id."""
    vectors = table(spark, sf_dir, "embeddings")
    known = materialize(chroma.classes(chroma.fingerprints(vectors, "vec_id", "embedding", chroma.tune)))
    asked = chroma.fingerprints(vectors.filter("vec_id % 100 = 0"), "vec_id", "embedding", chroma.heard)
    found = chroma.search(asked, known).select(F.col("query").alias("query_id"), F.lit(None).cast("long").alias("vec_id"), F.col("class").alias("class_id"), "offset", "hits", "bit_error")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("offset", "long"), ("hits", "long"), ("bit_error", "double"))]
    return found.unionByName(known.filter("id <> class").select(F.lit(None).cast("long").alias("query_id"), F.col("id").alias("vec_id"), F.col("class").alias("class_id"), *none))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def _crc(buckets: int):
    return F.crc32(F.col("doc_id").cast("string")) % buckets


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), (F.size("items") > 0).alias("contaminated"), F.array_join(F.col("items").cast("array<string>"), ",").alias("item_ids"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_filter=_crc(5) != 0)
    return found.select(F.col("id").alias("doc_id"), (F.crc32(F.col("id").cast("string")) % 5 == 0).alias("held_out"), "score", F.col("good").cast("int").alias("predicted"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.round_trips(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_ids"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.col("exact").alias("round_trip"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_filter=_crc(3) != 1)
    return found.select(F.col("id").alias("doc_id"), (F.crc32(F.col("id").cast("string")) % 3 == 1).alias("held_out"), "score", F.col("toxic").cast("int").alias("predicted"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {"op1_extract": op1_extract, "op2_secrets": op2_secrets, "op3_repeats": op3_repeats, "op4_pii": op4_pii, "op5_chroma": op5_chroma, "op6_simhash": op6_simhash, "op7_decontaminate": op7_decontaminate, "op8_quality": op8_quality, "op9_pieces": op9_pieces, "op10_toxicity": op10_toxicity, "pipeline": pipeline}


def oracle_sql():
    return oracle.oracle_sql()
