"""Connected components by alternating large-star and small-star rounds over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours turn to the smallest of these. edges: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    return out.select("e.u", "e.v").filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(edges: DataFrame, most: int = 50) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component. edges: (src, dst) of longs."""
    now = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).filter("u <> v").distinct()
    now = materialize(now)
    seen = _state(now)
    for _ in range(most):
        if not seen[0]:
            break
        now = materialize(_small_star(_large_star(now)))
        new = _state(now)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()
