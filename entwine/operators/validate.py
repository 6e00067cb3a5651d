"""Checks of the match and candidate lists before they are handed over."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _items(column: str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(F.col(column), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def issues(matches: DataFrame, candidates: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """(issue, s1_entity_id, target_entity_id) of everything wrong.

    matches: (s1_entity_id, matching_ids), candidates: (s1_entity_id, candidate_ids), comma-joined; s1 and
    targets: (entity_id). Targets are only looked up if there are any."""
    m, c = (df.select(F.trim("s1_entity_id").alias("s1"), _items(col).alias("items")) for df, col in ((matches, "matching_ids"), (candidates, "candidate_ids")))
    none = F.lit(None).cast("string")
    named = lambda df, issue, a=F.col("s1"), b=none: df.select(F.lit(issue).alias("issue"), a.alias("s1_entity_id"), b.alias("target_entity_id"))
    ids, pool = s1.select(F.col("entity_id").alias("s1")).distinct(), targets.select(F.col("entity_id").alias("t")).distinct()
    pairs = lambda df: df.select("s1", F.explode("items").alias("t"))
    mp, cp = pairs(m).distinct(), pairs(c).distinct()
    some = pool.limit(1).agg((F.count("*") > 0).alias("some"))
    found = [
        *[named(df.groupBy("s1").count().filter("count > 1"), f"duplicate_s1_in_{n}") for df, n in ((c, "candidates"), (m, "matches"))],
        *[named(pairs(df).groupBy("s1", "t").count().filter("count > 1"), f"duplicate_target_in_{n}", b=F.col("t")) for df, n in ((c, "candidates"), (m, "matches"))],
        named(mp.join(cp, ["s1", "t"], "left_anti"), "match_not_in_candidates", b=F.col("t")),
        named(mp.join(pool, "t", "left_anti").crossJoin(F.broadcast(some)).filter("some"), "match_not_a_target", b=F.col("t")),
        named(mp.join(ids.select(F.col("s1").alias("t")), "t", "left_semi"), "match_is_an_s1_entity", b=F.col("t")),
        named(ids.join(m, "s1", "left_anti"), "missing_s1_in_matches"),
        named(m.select("s1").distinct().join(ids, "s1", "left_anti"), "unexpected_s1_in_matches"),
    ]
    return reduce(DataFrame.union, found)


def columns_missing(df: DataFrame, least: int = 2) -> bool:
    return len(df.columns) < least
