"""New S1 entities against fixed target postings, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocking
from ..operators.normalize import clean_records


def kept_postings(targets: DataFrame, max_block: int = blocking.MAX_BLOCK) -> DataFrame:
    """(rule, key, target_entity_id) of the blocks that are not too large; to be stored once."""
    keys = blocking.postings(targets)
    small = keys.groupBy("rule", "key").agg(F.count("*").alias("size")).filter(F.col("size") <= max_block).select("rule", "key")
    return keys.join(small, ["rule", "key"], "left_semi").select("rule", "key", F.col("entity_id").alias("target_entity_id")).distinct()


def candidate_hits(arriving: DataFrame, postings: DataFrame) -> DataFrame:
    """(s1_entity_id, target_entity_id, rule, pos) for a stream of raw entities: a stream-static join without state.
    Ranking needs an entity's hits together and is left to the sink (foreachBatch)."""
    probes = blocking.postings(clean_records(arriving), probe=True).withColumnRenamed("entity_id", "s1_entity_id")
    return probes.join(postings, ["rule", "key"]).select("s1_entity_id", "target_entity_id", "rule", "pos")
