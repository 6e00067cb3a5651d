"""A leak-free split of S1 entities, stratified by country and number of matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def strata(s1: DataFrame, truth_list: DataFrame) -> DataFrame:
    """(entity_id, stratum). s1: clean records; truth_list: pairs, repeats kept. Ids are made distinct first."""
    one = s1.groupBy("entity_id").agg(F.min(F.struct("normalized_country", "original_country")).alias("c"))
    n = truth_list.groupBy(F.col("s1_entity_id").alias("entity_id")).agg(F.count("*").alias("n"))
    country = F.upper(F.when(F.col("c.normalized_country") != "", F.col("c.normalized_country")).when(F.col("c.original_country") != "", F.col("c.original_country")).otherwise("UNKNOWN"))
    bucket = F.when(F.coalesce("n", F.lit(0)) == 0, "singleton").when(F.col("n") == 1, "one_to_one").otherwise("one_to_many")
    return one.join(n, "entity_id", "left").select("entity_id", F.concat_ws("_", country, bucket).alias("stratum"))


def assigned(strata_: DataFrame, ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """(entity_id, stratum, fold): of each stratum the share `ratio` (rounded half to even) goes to val, in the
    order of a keyed hash of the id, which no partitioning changes.

    A stratum may hold a third of all ids, so ranks are not taken over it in one task: ids are counted by the
    first bits of the hash, whole slices below the cut go to val, and only the slice of the cut is ranked."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), "entity_id"))
    rows = strata_.withColumn("h", h).withColumn("slice", F.substring("h", 1, 3))
    slices = rows.groupBy("stratum", "slice").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("stratum").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(W.partitionBy("stratum"))
    cuts = slices.withColumns({"before": before, "want": F.bround(total * F.lit(ratio)).cast("long")})
    placed = rows.join(cuts, ["stratum", "slice"])
    below, beyond = F.col("before") + F.col("n") <= F.col("want"), F.col("before") >= F.col("want")
    whole = placed.filter(below | beyond).select("entity_id", "stratum", F.when(below, "val").otherwise("train").alias("fold"))
    rank = F.row_number().over(W.partitionBy("stratum", "slice").orderBy("h", "entity_id")) + F.col("before")
    cut = placed.filter(~below & ~beyond).select("entity_id", "stratum", F.when(rank <= F.col("want"), "val").otherwise("train").alias("fold"))
    return whole.unionByName(cut)


def stats(folds: DataFrame) -> DataFrame:
    """(fold, stratum, n, pct of the fold)."""
    by = folds.groupBy("fold", "stratum").agg(F.count("*").alias("n"))
    return by.select("fold", "stratum", "n", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy("fold")), 2).alias("pct"))
