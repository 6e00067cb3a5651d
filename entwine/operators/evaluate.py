"""Quality of matches: precision, recall and F-beta by entity, candidate recall, threshold grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def entity_counts(entities: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(s1_entity_id, n_true, n_pred, tp) for every entity of the ground truth."""
    key = ["s1_entity_id", "target_entity_id"]
    t = truth.select(key).distinct().withColumn("t", F.lit(1))
    p = predicted.select(key).distinct().withColumn("p", F.lit(1))
    per = t.join(p, key, "full_outer").groupBy("s1_entity_id").agg(F.count("t").alias("n_true"), F.count("p").alias("n_pred"), F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return entities.select("s1_entity_id").distinct().join(per, "s1_entity_id", "left").select("s1_entity_id", zero("n_true"), zero("n_pred"), zero("tp"))


def _scores(beta: float) -> tuple[Column, Column, Column]:
    t, p, tp = F.col("n_true"), F.col("n_pred"), F.col("tp").cast("double")
    both_empty = (t == 0) & (p == 0)
    precision = F.when(both_empty, 1.0).when((t == 0) | (p == 0), 0.0).otherwise(tp / F.greatest(p, F.lit(1)))
    recall = F.when(both_empty, 1.0).when((t == 0) | (p == 0), 0.0).otherwise(tp / F.greatest(t, F.lit(1)))
    below = beta * beta * precision + recall
    return precision, recall, F.when(below > 0, (1 + beta * beta) * precision * recall / F.when(below > 0, below).otherwise(1.0)).otherwise(0.0)


def entity_fbeta(entities: DataFrame, truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """Precision, recall and F-beta of each entity; right silence on a singleton is 1, anything on it is 0."""
    p, r, f = _scores(beta)
    return entity_counts(entities, truth, predicted).select("s1_entity_id", "n_true", "n_pred", "tp", p.alias("precision"), r.alias("recall"), f.alias("f_beta"))


def macro_fbeta(entities: DataFrame, truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row: means over the entities of the ground truth, singleton accuracy and totals."""
    single = F.count_if(F.col("n_true") == 0)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return entity_fbeta(entities, truth, predicted, beta).agg(
        zero(F.avg("f_beta")).alias("macro_f_beta"),
        zero(F.avg("precision")).alias("macro_precision"),
        zero(F.avg("recall")).alias("macro_recall"),
        F.count("*").alias("num_entities"),
        single.alias("num_singletons"),
        F.when(single == 0, 1.0).otherwise(F.count_if((F.col("n_true") == 0) & (F.col("n_pred") == 0)) / F.greatest(single, F.lit(1))).alias("singleton_accuracy"),
        F.coalesce(F.sum("tp"), F.lit(0)).alias("total_tp"),
        F.coalesce(F.sum(F.col("n_pred") - F.col("tp")), F.lit(0)).alias("total_fp"),
        F.coalesce(F.sum(F.col("n_true") - F.col("tp")), F.lit(0)).alias("total_fn"),
    )


def _captured(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    key = ["s1_entity_id", "target_entity_id"]
    seen = pairs.select(*key).distinct().withColumn("hit", F.lit(1))
    return truth.select(key).distinct().join(seen, key, "left").withColumn("hit", F.coalesce("hit", F.lit(0)))


def candidate_recall(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: true pairs, those among the candidates, and their share (1 without true pairs)."""
    return _captured(truth, pairs).agg(F.count("*").alias("true_pairs"), F.coalesce(F.sum("hit"), F.lit(0)).alias("captured_pairs"), F.coalesce(F.avg("hit"), F.lit(1.0)).alias("recall"))


def recall_breakdown(truth: DataFrame, pairs: DataFrame, validation: DataFrame) -> DataFrame:
    """One row: recall in per cent overall, by fold (null without pairs), and by source (100 without pairs)."""
    v = validation.select("s1_entity_id").distinct().withColumn("v", F.lit(1))
    hits = _captured(truth, pairs).join(v, "s1_entity_id", "left")
    part = lambda cond, digits: F.round(100.0 * F.avg(F.when(cond, F.col("hit"))), digits)
    s2, s3 = F.upper("target_entity_id").contains("S2"), F.upper("target_entity_id").contains("S3")
    return hits.agg(
        F.count("*").alias("total_true_pairs"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("captured_true_pairs"),
        F.coalesce(part(F.lit(True), 3), F.lit(100.0)).alias("overall_pct"),
        part(F.col("v").isNull(), 3).alias("train_pct"),
        part(F.col("v").isNotNull(), 3).alias("val_pct"),
        F.coalesce(part(s2, 2), F.lit(100.0)).alias("source2_pct"),
        F.coalesce(part(s3 & ~s2, 2), F.lit(100.0)).alias("source3_pct"),
    )


def rule_ablation(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rule, captured, coverage_pct, unique_pairs, unique_pct): true pairs that each rule, and it alone, finds.
    Per cents are of all true pairs."""
    key = ["s1_entity_id", "target_entity_id"]
    t = truth.select(key).distinct()
    total = t.agg(F.count("*").alias("total"))
    hit = t.join(pairs.select(*key, "rules"), key).select(F.explode("rules").alias("rule"), (F.size("rules") == 1).alias("alone"))
    by = hit.groupBy("rule").agg(F.count("*").alias("captured"), F.count_if("alone").alias("unique_pairs")).crossJoin(F.broadcast(total))
    return by.select("rule", "captured", F.round(100.0 * F.col("captured") / F.col("total"), 2).alias("coverage_pct"), "unique_pairs", F.round(100.0 * F.col("unique_pairs") / F.col("total"), 2).alias("unique_pct"))


def missed_pairs(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    key = ["s1_entity_id", "target_entity_id"]
    return truth.select(key).distinct().join(pairs.select(key), key, "left_anti")


def missed_sample(truth: DataFrame, pairs: DataFrame, most: int = 20) -> DataFrame:
    """(s1_entity_id, target_entity_id, target_source, total): the first missed pairs by their ids, and how many there are."""
    missed = missed_pairs(truth, pairs)
    upper = F.upper("target_entity_id")
    source = F.when(upper.contains("S2"), "S2").when(upper.contains("S3"), "S3").otherwise("OTHER")
    first = missed.orderBy("s1_entity_id", "target_entity_id").limit(most).withColumn("target_source", source)
    return first.crossJoin(F.broadcast(missed.agg(F.count("*").alias("total"))))


def threshold_grid(scored: DataFrame, entities: DataFrame, truth: DataFrame, start: float = 0.20, end: float = 0.95, step: float = 0.02, beta: float = 0.5) -> DataFrame:
    """(threshold, macro_f_beta, macro_precision, macro_recall): all thresholds in one pass. Each pair counts once, at
    the highest threshold that its score reaches. An entity's figures change only there, so it gives a row of changes
    for each such threshold, and the changes of all entities are summed from the top down over the few thresholds."""
    points = [round(start + k * step, 4) for k in range(round((end - start) / step) + 1)]
    key = ["s1_entity_id", "target_entity_id"]
    t = truth.select(key).distinct().withColumn("t", F.lit(1))
    ids = entities.select("s1_entity_id").distinct()
    known = ids.join(t.groupBy("s1_entity_id").agg(F.count("*").alias("n_true")), "s1_entity_id", "left").select("s1_entity_id", F.coalesce("n_true", F.lit(0)).alias("n_true"))
    best = scored.groupBy(key).agg(F.max("score").alias("score")).join(t, key, "left")
    reached = F.size(F.filter(F.array(*[F.lit(x) for x in points]), lambda x: F.col("score") >= x)) - 1
    steps = best.withColumn("k", reached).filter("k >= 0").groupBy("s1_entity_id", "k").agg(F.count("*").alias("n"), F.count("t").alias("hits")).join(known, "s1_entity_id")
    down = W.partitionBy("s1_entity_id").orderBy(F.desc("k"))
    so_far = down.rowsBetween(W.unboundedPreceding, W.currentRow)
    named = dict(zip(("p", "r", "f"), _scores(beta), strict=True))
    here = steps.withColumns({"n_pred": F.sum("n").over(so_far), "tp": F.sum("hits").over(so_far)}).select("s1_entity_id", "k", "n_true", *[c.alias(n) for n, c in named.items()])
    silent = (F.col("n_true") == 0).cast("double")  # what an entity without predictions scores
    changes = here.select("k", *[(F.col(n) - F.coalesce(F.lag(n).over(down), silent)).alias(n) for n in named]).groupBy("k").agg(*[F.sum(n).alias(n) for n in named])
    total = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(silent), F.lit(0.0)).alias("silent"))
    grid = entities.sparkSession.createDataFrame(list(enumerate(points)), "k int, threshold double")
    above = W.orderBy(F.desc("k")).rowsBetween(W.unboundedPreceding, W.currentRow)  # a row for each threshold
    rows = grid.join(F.broadcast(changes), "k", "left").crossJoin(F.broadcast(total)).filter("n > 0")
    mean = lambda n: ((F.col("silent") + F.sum(F.coalesce(n, F.lit(0.0))).over(above)) / F.col("n")).alias
    return rows.select("threshold", mean("f")("macro_f_beta"), mean("p")("macro_precision"), mean("r")("macro_recall"))


def best_threshold(grid: DataFrame) -> DataFrame:
    """The lowest of the thresholds with the greatest F."""
    return grid.orderBy(F.round("macro_f_beta", 9).desc(), "threshold").limit(1)
