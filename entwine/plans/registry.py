"""Registered queries of the entity-resolution engine and the DuckDB SQL they are held against.

The entity view deals `documents` to three sources; candidate pairs of the similarity queries are those that
share a name prefix. Counts are BIGINT, ratios DOUBLE, lists comma-joined strings on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import audit, blocking, evaluate, features, models, split, validate
from ..operators.normalize import CLEAN, clean_records
from ..sources.tables import entity_view, joined_lists


# ---- DataFrames -------------------------------------------------------------------------------------------


def _view(spark: SparkSession, d: str) -> DataFrame:
    return entity_view(spark.read.parquet(f"{d}/documents.parquet"))


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return clean_records(_view(spark, d), "source")


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = _clean(spark, d)
    return c.filter("source = 'S1'"), c.filter("source <> 'S1'")


def _truth(spark: SparkSession, d: str) -> DataFrame:
    """Entities of equal texts. As with blocks, a text of more than MAX_BLOCK targets says nothing."""
    v = _view(spark, d).select("source", "entity_id", F.md5("text").alias("key"))
    a, b = v.filter("source = 'S1'"), blocking.pruned(v.filter("source <> 'S1'"), by=("key",))
    return a.select(F.col("entity_id").alias("s1_entity_id"), "key").join(b.select(F.col("entity_id").alias("target_entity_id"), "key"), "key").select("s1_entity_id", "target_entity_id")


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return _view(spark, d).filter("source = 'S1'").select(F.col("entity_id").alias("s1_entity_id"))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return blocking.candidates(*_sides(spark, d))


def _folds(spark: SparkSession, d: str) -> DataFrame:
    return split.assigned(split.strata(_sides(spark, d)[0], _truth(spark, d)))


def _val(spark: SparkSession, d: str) -> DataFrame:
    return _folds(spark, d).filter("fold = 'val'").select(F.col("entity_id").alias("s1_entity_id"))


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def normalize_entities(spark: SparkSession, d: str) -> DataFrame:
    return _clean(spark, d).select(*CLEAN)


def text_stats(spark: SparkSession, d: str) -> DataFrame:
    return audit.text_stats(_view(spark, d), "business_name")


def table_audit(spark: SparkSession, d: str) -> DataFrame:
    return _long(audit.table_audit(_view(spark, d).select("entity_id", "business_name", "business_address", "country")), "num_rows", "unique_entity_ids", "duplicate_entity_ids", "total_exact_duplicate_rows")


def country_distribution(spark: SparkSession, d: str) -> DataFrame:
    return audit.distribution(_view(spark, d), "country")


def gt_cardinality(spark: SparkSession, d: str) -> DataFrame:
    return audit.truth_cardinality(_truth(spark, d), _entities(spark, d))


def suffix_frequency(spark: SparkSession, d: str) -> DataFrame:
    return audit.suffix_frequency(_clean(spark, d), "normalized_name")


def casing_punct(spark: SparkSession, d: str) -> DataFrame:
    v = _view(spark, d)
    a = audit.casing_distribution(v, "business_name").select(F.lit("casing").alias("what"), F.col("casing").alias("value"), "n")
    return a.unionByName(audit.punctuation(v, "business_name").select(F.lit("mark").alias("what"), F.col("mark").alias("value"), "n"))


def address_patterns(spark: SparkSession, d: str) -> DataFrame:
    return audit.address_patterns(_view(spark, d), "business_address")


def address_abbreviations(spark: SparkSession, d: str) -> DataFrame:
    return audit.address_abbreviations(_view(spark, d), "business_address")


def frequent_tokens(spark: SparkSession, d: str) -> DataFrame:
    return audit.frequent_tokens(_view(spark, d), "business_name")


def postings(spark: SparkSession, d: str) -> DataFrame:
    return _long(blocking.postings(_sides(spark, d)[1]), "rule", "pos")


def block_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _long(blocking.block_sizes(_sides(spark, d)[1]), "rule")


def _block(rule: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return blocking.rule_hits(*_sides(spark, d), rule)

    return run


def candidates_topk(spark: SparkSession, d: str) -> DataFrame:
    return _long(blocking.exported(_candidates(spark, d)), "num_rules_triggered")


def candidate_export(spark: SparkSession, d: str) -> DataFrame:
    return joined_lists(_entities(spark, d), _candidates(spark, d), out="candidate_ids")


def blocking_summary(spark: SparkSession, d: str) -> DataFrame:
    return blocking.summary(_sides(spark, d)[0], _candidates(spark, d))


def _prefix_pairs(spark: SparkSession, d: str) -> DataFrame:
    s1, t = _sides(spark, d)
    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in CLEAN], F.array_join(F.slice(T.tokens(F.when(F.col("clean_name_no_suffix") != "", F.col("clean_name_no_suffix")).otherwise(F.col("normalized_name"))), 1, 2), "_").alias("key"))
    return side(s1, "a").join(blocking.pruned(side(t, "b").filter("key <> ''"), by=("key",)), "key")


def _similarity(what: dict[str, Callable], column: str = "normalized_name") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        a, b = F.col(f"a_{column}"), F.col(f"b_{column}")
        return _prefix_pairs(spark, d).select(F.col("a_entity_id").alias("s1_entity_id"), F.col("b_entity_id").alias("target_entity_id"), *[f(a, b).alias(n) for n, f in what.items()])

    return run


def _r(f: Callable) -> Callable:
    return lambda a, b: F.round(f(a, b), 4)


def pair_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, _candidates(spark, d))


def _features(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    s1, t = _sides(spark, d)
    found = features.pair_features(pairs, s1.drop("source"), features.last_of_each(t))
    return _long(found, "name_len_diff_abs", "name_token_count_diff", "addr_len_diff_abs", "addr_token_count_diff", "num_rules_triggered")


def pair_labels(spark: SparkSession, d: str) -> DataFrame:
    found = features.labelled(_candidates(spark, d).select("s1_entity_id", "target_entity_id"), _truth(spark, d), _val(spark, d))
    return _long(found, "is_match", "is_validation").select("s1_entity_id", "target_entity_id", "is_match", "is_validation")


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).filter("num_rules >= 5")


def entity_fbeta(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.entity_fbeta(_entities(spark, d), _truth(spark, d), _predicted(spark, d))


def macro_fbeta(spark: SparkSession, d: str) -> DataFrame:
    found = evaluate.macro_fbeta(_entities(spark, d), _truth(spark, d), _predicted(spark, d))
    return found.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in found.dtypes])


def candidate_recall(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.candidate_recall(_truth(spark, d), _candidates(spark, d))


def recall_by_source_fold(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.recall_breakdown(_truth(spark, d), _candidates(spark, d), _val(spark, d))


def rule_ablation(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.rule_ablation(_truth(spark, d), _candidates(spark, d))


def _agreed(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).filter(F.col("num_rules") == len(blocking.RULES))


def missed_pairs(spark: SparkSession, d: str) -> DataFrame:
    """True pairs that not all rules agree on."""
    return evaluate.missed_pairs(_truth(spark, d), _agreed(spark, d))


def missed_sample(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.missed_sample(_truth(spark, d), _agreed(spark, d))


def _graded(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("s1_entity_id", "target_entity_id", (F.col("num_rules") / 7.0).alias("score"))


def threshold_grid(spark: SparkSession, d: str) -> DataFrame:
    g = evaluate.threshold_grid(_graded(spark, d), _entities(spark, d), _truth(spark, d), 0.2, 0.95, 0.05)
    return g.select("threshold", *[F.round(c, 9).alias(c) for c in ("macro_f_beta", "macro_precision", "macro_recall")])


def best_threshold(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.best_threshold(threshold_grid(spark, d))


def split_assign(spark: SparkSession, d: str) -> DataFrame:
    return _folds(spark, d)


def split_stats(spark: SparkSession, d: str) -> DataFrame:
    return split.stats(_folds(spark, d))


def _baseline(spark: SparkSession, d: str) -> DataFrame:
    return models.baseline_scores(pair_features(spark, d))


def baseline_matches(spark: SparkSession, d: str) -> DataFrame:
    return models.matches(_baseline(spark, d)).select("s1_entity_id", "target_entity_id", F.round("score", 6).alias("score"))


def _labelled_scores(spark: SparkSession, d: str) -> DataFrame:
    return pair_labels(spark, d).join(_graded(spark, d), ["s1_entity_id", "target_entity_id"])


def confusion_counts(spark: SparkSession, d: str) -> DataFrame:
    return models.confusion(_labelled_scores(spark, d), 0.5)


def hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    found = models.hard_negatives(pair_labels(spark, d), _graded(spark, d), 0.5)
    return _long(found, "is_hard_negative")


def _gbt(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    rows = features.labelled(pairs, _truth(spark, d), _val(spark, d))  # labels go along, since features are wide rows
    f = _features(spark, d, rows).persist()  # fitted, and scored
    return models.scores(models.train(f), f)


def _kept(spark: SparkSession, d: str) -> None:
    """From now on, clean records and true pairs are made once for all that is built on them."""
    _clean(spark, d).persist()
    _truth(spark, d).persist()


def gbt_scores(spark: SparkSession, d: str) -> DataFrame:
    """What SQL can say of the scores of boosted trees: how many pairs there are by label and fold, that all scores are
    probabilities, and that their means lie on the right side."""
    _kept(spark, d)
    right = F.when(F.col("is_match") == 1, F.avg("score") > 0.5).otherwise(F.avg("score") < 0.5)
    found = _gbt(spark, d, _candidates(spark, d)).groupBy("is_match", "is_validation").agg(F.count("*").alias("n"), F.bool_and(F.col("score").between(0, 1)).alias("in_range"), right.alias("right_side"))
    return _long(found, "is_match", "is_validation")


def inference_matches(spark: SparkSession, d: str) -> DataFrame:
    """What SQL can say of the final lists: one for each entity, their ids candidates of it, each once and in order."""
    _kept(spark, d)
    pairs = _candidates(spark, d).persist()  # scored, and listed
    lists = joined_lists(_entities(spark, d), models.matches(_gbt(spark, d, pairs), 0.5)).join(joined_lists(_entities(spark, d), pairs, out="candidate_ids"), "s1_entity_id")
    items, pool = (F.array_remove(F.split(c, ","), "") for c in ("matching_ids", "candidate_ids"))
    return lists.agg(F.count("*").alias("n"), F.countDistinct("s1_entity_id").alias("entities"), F.bool_and(F.size(F.array_except(items, pool)) == 0).alias("candidates_only"), F.bool_and(items == F.array_sort(F.array_distinct(items))).alias("in_order"))


def submission_issues(spark: SparkSession, d: str) -> DataFrame:
    """Issues of whole lists with a fault for each last digit of an entity's id, by kind."""
    s1, t = _sides(spark, d)
    last, i = F.substring("s1_entity_id", -1, 1), F.col("s1_entity_id")
    matches = joined_lists(_entities(spark, d), _truth(spark, d))
    wrong = F.when(last == "2", "S2_none,S2_none").when(last == "4", i).otherwise(F.col("matching_ids"))
    matches = matches.select(F.when(last == "8", F.concat(i, F.lit("x"))).otherwise(i).alias("s1_entity_id"), wrong.alias("matching_ids"), last.alias("last")).filter("last <> '7'")
    matches = matches.unionByName(matches.filter("last = '0'")).drop("last")
    lists = candidate_export(spark, d).withColumn("candidate_ids", F.when(last == "3", F.concat_ws(",", "candidate_ids", F.lit("S2_none,S2_none"))).otherwise(F.col("candidate_ids")))
    found = validate.issues(matches, lists.unionByName(lists.filter(last == "1")), s1, t)
    return found.groupBy("issue").agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return candidates_topk(spark, d)


# ---- SQL --------------------------------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _plain(x: str) -> str:
    out = f"regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '&amp;', ' and ', 'gi'), '&', ' and ', 'g'), '@', ' at ', 'g')"
    return f"translate(strip_accents({out}), '’‘“”–—', '''''\"\"--')"


def _words(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _case(x: str, table: dict[str, str], other: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in table.items()) + f" ELSE {other} END"


def _list(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


_STOP = ", ".join(map(_q, blocking.STOPWORDS))
_BARE = r"trim(regexp_replace(regexp_replace(lower(trim(" + _plain("country") + r")), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g'))"
_BASE = rf"""
WITH view_ AS (
  SELECT 'S' || (doc_id % 3 + 1) AS source, 'S' || (doc_id % 3 + 1) || '_' || doc_id AS entity_id,
    array_to_string(string_split(coalesce(text, ''), ' ')[1:4], ' ') || CASE lang WHEN 'de' THEN ' GmbH' WHEN 'fr' THEN ' Sarl' WHEN 'en' THEN CASE doc_id % 2 WHEN 0 THEN ' Inc.' ELSE ' Pvt Ltd' END ELSE '' END AS business_name,
    n_chars || ' ' || array_to_string(string_split(coalesce(text, ''), ' ')[5:9], ' ') || ' ' || lpad(CAST(n_chars * 7 % 100000 AS VARCHAR), 5, '0') AS business_address,
    lang AS country, text FROM documents),
named AS (
  SELECT source, entity_id, trim(business_name, ' ') AS original_name, {_words(_plain("business_name"))} AS normalized_name,
    trim(business_address, ' ') AS original_address, {_words(_plain("business_address"))} AS words,
    regexp_extract(business_address, '\b\d{{6}}\b') AS pin, split_part(regexp_extract(business_address, '\b\d{{5}}(?:-\d{{4}})?\b'), '-', 1) AS zip,
    array_to_string(regexp_extract_all(business_address, '\b\d+\b'), ' ') AS address_digits,
    trim(country) AS original_country, {_BARE} AS bare FROM view_),
clean AS (
  SELECT source, entity_id, original_name, normalized_name,
    CASE WHEN contains(normalized_name, ' ') THEN trim(regexp_replace(' ' || normalized_name, {_q(T.suffix_pattern())}, '')) ELSE normalized_name END AS clean_name_no_suffix,
    original_address, array_to_string(list_transform({_list("words")}, lambda t: {_case("t", T.ADDRESS_TOKENS, "t")}), ' ') AS normalized_address,
    CASE WHEN pin <> '' THEN pin ELSE zip END AS postal_code, address_digits, original_country,
    {_case("bare", T.COUNTRIES, "CASE WHEN bare <> '' THEN upper(bare) ELSE 'UNKNOWN' END")} AS normalized_country FROM named),
core AS (
  SELECT *, {_list("CASE WHEN clean_name_no_suffix <> '' THEN clean_name_no_suffix ELSE normalized_name END")} AS toks,
    split_part(address_digits, ' ', 1) AS digit FROM clean),
keys AS (
  SELECT source, entity_id, 1 AS rule, 0 AS pos, normalized_name AS key, true AS probe FROM core
  UNION ALL SELECT source, entity_id, 2, 0, clean_name_no_suffix, true FROM core
  UNION ALL SELECT source, entity_id, 3, 0, normalized_address, true FROM core
  UNION ALL SELECT source, entity_id, 4, 0, array_to_string(toks[1:2], '_'), true FROM core
  UNION ALL SELECT source, entity_id, 5, u.i - 1, toks[u.i], true FROM core, unnest(range(1, len(toks) + 1)) AS u(i) WHERE length(toks[u.i]) >= 3 AND toks[u.i] NOT IN ({_STOP})
  UNION ALL SELECT source, entity_id, 6, 0, CASE WHEN digit <> '' THEN postal_code || '_' || digit ELSE postal_code END, digit <> '' FROM core WHERE postal_code <> ''
  UNION ALL SELECT source, entity_id, 7, 0, clean_name_no_suffix[1:3], true FROM core WHERE length(clean_name_no_suffix) >= 3
  UNION ALL SELECT source, entity_id, 7, 0, clean_name_no_suffix[4:6], false FROM core WHERE length(clean_name_no_suffix) >= 6),
posts AS (SELECT entity_id, rule, pos, key FROM keys WHERE key <> '' AND source <> 'S1'),
probes AS (SELECT entity_id, rule, pos, key FROM keys WHERE key <> '' AND source = 'S1' AND probe),
small AS (SELECT rule, key, count(*) AS size FROM posts GROUP BY ALL HAVING count(*) <= {blocking.MAX_BLOCK}),
hits AS (SELECT p.entity_id AS s1_entity_id, t.entity_id AS target_entity_id, p.rule, min(p.pos) AS pos FROM probes p JOIN small USING (rule, key) JOIN posts t USING (rule, key) GROUP BY ALL),
paired AS (SELECT s1_entity_id, target_entity_id, count(DISTINCT rule) AS num_rules, min(rule * 100000 + pos) AS first_,
    list_sort(list(DISTINCT [{", ".join(map(_q, blocking.RULES))}][rule])) AS rules FROM hits GROUP BY ALL),
cand AS (SELECT s1_entity_id, target_entity_id, substr(target_entity_id, 1, 2) AS target_source, rules, num_rules FROM paired
  QUALIFY row_number() OVER (PARTITION BY s1_entity_id ORDER BY num_rules DESC, first_, substr(target_entity_id, 1, 2), target_entity_id) <= {blocking.MAX_CANDIDATES}),
ents AS (SELECT entity_id AS s1_entity_id FROM view_ WHERE source = 'S1'),
told AS (SELECT text FROM view_ WHERE source <> 'S1' AND text IS NOT NULL GROUP BY text HAVING count(*) <= {blocking.MAX_BLOCK}),
truth AS (SELECT a.entity_id AS s1_entity_id, b.entity_id AS target_entity_id FROM view_ a JOIN told USING (text) JOIN view_ b USING (text) WHERE a.source = 'S1' AND b.source <> 'S1'),
strata AS (SELECT c.entity_id, upper(c.normalized_country) || '_' || CASE coalesce(n, 0) WHEN 0 THEN 'singleton' WHEN 1 THEN 'one_to_one' ELSE 'one_to_many' END AS stratum
  FROM clean c LEFT JOIN (SELECT s1_entity_id, count(*) AS n FROM truth GROUP BY ALL) t ON t.s1_entity_id = c.entity_id WHERE source = 'S1'),
folds AS (SELECT entity_id, stratum, CASE WHEN row_number() OVER (PARTITION BY stratum ORDER BY md5('42|' || entity_id), entity_id) <= round_even(count(*) OVER (PARTITION BY stratum) * 0.2, 0) THEN 'val' ELSE 'train' END AS fold FROM strata),
val AS (SELECT entity_id AS s1_entity_id FROM folds WHERE fold = 'val'),
captured AS (SELECT t.*, CASE WHEN c.s1_entity_id IS NULL THEN 0 ELSE 1 END AS hit, v.s1_entity_id IS NOT NULL AS v FROM truth t LEFT JOIN cand c USING (s1_entity_id, target_entity_id) LEFT JOIN val v ON v.s1_entity_id = t.s1_entity_id),
"""

_COUNTS = """
pred AS (SELECT s1_entity_id, target_entity_id FROM cand WHERE num_rules >= 5),
counts AS (SELECT e.s1_entity_id, (SELECT count(*) FROM truth t WHERE t.s1_entity_id = e.s1_entity_id) AS n_true, (SELECT count(*) FROM pred p WHERE p.s1_entity_id = e.s1_entity_id) AS n_pred,
  (SELECT count(*) FROM pred p JOIN truth t USING (s1_entity_id, target_entity_id) WHERE p.s1_entity_id = e.s1_entity_id) AS tp FROM ents e),
pr AS (SELECT *, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / n_pred END AS precision, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / n_true END AS recall FROM counts),
scored AS (SELECT *, CASE WHEN precision + recall > 0 THEN CAST(1.25 * precision * recall / (0.25 * precision + recall) AS DOUBLE) ELSE 0.0 END AS f_beta FROM pr)
"""

_GRID = """
grid AS (SELECT round(0.2 + i * 0.05, 4) AS threshold FROM range(0, 16) AS r(i)),
counts AS (SELECT e.s1_entity_id, g.threshold, coalesce(any_value(nt.n), 0) AS n_true, count(c.target_entity_id) AS n_pred, count(t.target_entity_id) AS tp
  FROM ents e CROSS JOIN grid g LEFT JOIN (SELECT s1_entity_id, count(*) AS n FROM truth GROUP BY ALL) nt ON nt.s1_entity_id = e.s1_entity_id
  LEFT JOIN cand c ON c.s1_entity_id = e.s1_entity_id AND c.num_rules / 7.0 >= g.threshold LEFT JOIN truth t ON t.s1_entity_id = c.s1_entity_id AND t.target_entity_id = c.target_entity_id GROUP BY ALL),
pr AS (SELECT *, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / n_pred END AS p, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / n_true END AS r FROM counts),
done AS (SELECT threshold, round(avg(CASE WHEN p + r > 0 THEN CAST(1.25 * p * r / (0.25 * p + r) AS DOUBLE) ELSE 0.0 END), 9) AS macro_f_beta, round(avg(p), 9) AS macro_precision, round(avg(r), 9) AS macro_recall FROM pr GROUP BY ALL)
"""


def _sql(select: str, more: str = "one_ AS (SELECT 1)") -> str:
    return _BASE + more + select


_PAIRS = f"few AS (SELECT array_to_string(toks[1:2], '_') AS key FROM core WHERE source <> 'S1' AND len(toks) > 0 GROUP BY ALL HAVING count(*) <= {blocking.MAX_BLOCK}), pairs AS (SELECT a.entity_id AS s1_entity_id, b.entity_id AS target_entity_id, a.normalized_name AS a, b.normalized_name AS b, a.normalized_address AS x, b.normalized_address AS y, a.postal_code AS p, b.postal_code AS q FROM core a JOIN core b ON array_to_string(a.toks[1:2], '_') = array_to_string(b.toks[1:2], '_') JOIN few ON few.key = array_to_string(b.toks[1:2], '_') WHERE a.source = 'S1' AND b.source <> 'S1' AND len(a.toks) > 0)"


def _pair_sql(columns: str, more: str = "") -> str:
    return _sql(f" SELECT s1_entity_id, target_entity_id, {columns} FROM pairs", _PAIRS + more)


def _jaccard(s: str, t: str, neither: str = "1.0") -> str:
    return f"CASE WHEN len({s}) = 0 AND len({t}) = 0 THEN {neither} WHEN len({s}) = 0 OR len({t}) = 0 THEN 0.0 ELSE round(CAST(len(list_intersect({s}, {t})) AS DOUBLE) / len(list_distinct(list_concat({s}, {t}))), 4) END"


def _grams(x: str) -> str:
    return f"CASE WHEN length({x}) = 0 THEN [] WHEN length({x}) < 3 THEN [{x}] ELSE list_distinct(list_transform(range(1, length({x}) - 1), lambda i: {x}[i:i+2])) END"


def _lcs(a: str, b: str) -> str:
    """Rows of the table of common subsequences, one for each character of a: what the row before has, or one
    more on an equal character; running maxima make it a row."""
    row = f"list_transform(range(1, length({b}) + 1), lambda j: greatest(r[j], coalesce(r[j - 1], 0) + CASE WHEN {b}[j] = {a}[i] THEN 1 ELSE 0 END))"
    running = f"list_transform([{row}], lambda t: list_transform(range(1, length({b}) + 1), lambda k: list_max(t[1:k])))[1]"
    return f"coalesce(list_reduce(range(1, length({a}) + 1), lambda r, i: {running}, list_transform(range(1, length({b}) + 1), lambda z: CAST(0 AS BIGINT)))[-1], 0)"


def _edit(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 ELSE round(2.0 * {_lcs(a, b)} / (length({a}) + length({b})), 4) END"


_SORTED = ", sp AS (SELECT s1_entity_id, target_entity_id, array_to_string(list_sort(" + _list("a") + "), ' ') AS a, array_to_string(list_sort(" + _list("b") + "), ' ') AS b FROM pairs)"


def _token_set(name: str, source: str, a: str, b: str) -> str:
    """CTEs that add the token-set ratio of columns a and b of `source` as column `name` of `{name}_of`."""
    tail = lambda x: f"CASE WHEN {x} <> '' THEN ' ' || {x} ELSE '' END"
    return f"""
{name}_1 AS (SELECT *, list_distinct({_list(a)}) AS s_, list_distinct({_list(b)}) AS t_ FROM {source}),
{name}_2 AS (SELECT *, array_to_string(list_sort(list_intersect(s_, t_)), ' ') AS both_, array_to_string(list_sort(list_filter(s_, lambda x: NOT list_contains(t_, x))), ' ') AS one_, array_to_string(list_sort(list_filter(t_, lambda x: NOT list_contains(s_, x))), ' ') AS two_,
  array_to_string(list_sort({_list(a)}), ' ') AS sa_, array_to_string(list_sort({_list(b)}), ' ') AS sb_ FROM {name}_1),
{name}_3 AS (SELECT *, {tail("one_")} AS u_, {tail("two_")} AS v_ FROM {name}_2),
{name}_of AS (SELECT * EXCLUDE (s_, t_, both_, one_, two_, sa_, sb_, u_, v_), CASE WHEN len(s_) = 0 AND len(t_) = 0 THEN 1.0 WHEN len(s_) = 0 OR len(t_) = 0 THEN 0.0
  WHEN both_ <> '' THEN CAST(least(greatest(2.0 * length(both_) / (2 * length(both_) + length(u_)), 2.0 * length(both_) / (2 * length(both_) + length(v_)), 2.0 * (length(both_) + {_lcs("u_", "v_")}) / (2 * length(both_) + length(u_) + length(v_))), 1.0) AS DOUBLE)
  ELSE CASE WHEN length(sa_) + length(sb_) = 0 THEN 1.0 WHEN length(sa_) = 0 OR length(sb_) = 0 THEN 0.0 ELSE CAST(2.0 * {_lcs("sa_", "sb_")} / (length(sa_) + length(sb_)) AS DOUBLE) END END AS {name} FROM {name}_3)"""


def _features_sql() -> tuple[str, str]:
    """The CTEs and the columns of the pair features."""
    sides = ", ".join(f"{p}.{c} AS {p}_{c}" for p in "ab" for c in CLEAN[1:])
    core = ", ".join(f"CASE WHEN {p}_clean_name_no_suffix <> '' THEN {p}_clean_name_no_suffix ELSE {p}_normalized_name END AS {p}_core" for p in "ab")
    more = f"""looked AS (SELECT c.s1_entity_id, c.target_entity_id, c.rules, {sides} FROM cand c JOIN clean a ON a.entity_id = c.s1_entity_id JOIN clean b ON b.entity_id = c.target_entity_id),
cored AS (SELECT *, {core} FROM looked),
alled AS (SELECT *, trim(a_core || ' ' || a_normalized_address) AS a_all, trim(b_core || ' ' || b_normalized_address) AS b_all,
  array_to_string(list_sort({_list("a_normalized_name")}), ' ') AS a_sn, array_to_string(list_sort({_list("b_normalized_name")}), ' ') AS b_sn, array_to_string(list_sort({_list("a_normalized_address")}), ' ') AS a_sa, array_to_string(list_sort({_list("b_normalized_address")}), ' ') AS b_sa FROM cored),
{_token_set("n_set", "alled", "a_core", "b_core")}, {_token_set("a_set", "n_set_of", "a_normalized_address", "b_normalized_address")}, {_token_set("all_set", "a_set_of", "a_all", "b_all")}"""
    both = lambda c, f="{}": f"CASE WHEN {f.format('a_' + c)} = {f.format('b_' + c)} AND {f.format('a_' + c)} <> '' THEN 1.0 ELSE 0.0 END"
    distinct = lambda c: (f"list_distinct({_list('a_' + c)})", f"list_distinct({_list('b_' + c)})")
    lengths = lambda c: (f"abs(length(a_{c}) - length(b_{c}))", f"CASE WHEN greatest(length(a_{c}), length(b_{c})) = 0 THEN 1.0 ELSE round(CAST(least(length(a_{c}), length(b_{c})) AS DOUBLE) / greatest(length(a_{c}), length(b_{c})), 4) END", f"abs(len({_list('a_' + c)}) - len({_list('b_' + c)}))")
    grams = lambda c: f"CASE WHEN a_{c} = b_{c} THEN 1.0 ELSE {_jaccard(_grams('a_' + c), _grams('b_' + c))} END"
    runs = tuple(rf"list_distinct(regexp_extract_all({p}_normalized_address, '\b\d+\b'))" for p in "ab")
    name, addr = lengths("clean_name_no_suffix"), lengths("normalized_address")
    columns = {
        "name_exact_match": both("original_name"), "name_norm_exact_match": both("normalized_name"), "name_clean_exact_match": both("clean_name_no_suffix"),
        "name_levenshtein_ratio": _edit("a_normalized_name", "b_normalized_name"), "name_token_sort_ratio": _edit("a_sn", "b_sn"), "name_token_set_ratio": "round(n_set, 4)",
        "name_jaccard_similarity": _jaccard(*distinct("core")), "name_char_3gram_jaccard": grams("core"), "name_len_diff_abs": name[0], "name_len_ratio": name[1], "name_token_count_diff": name[2],
        "addr_exact_match": both("original_address"), "addr_norm_exact_match": both("normalized_address"), "addr_levenshtein_ratio": _edit("a_normalized_address", "b_normalized_address"),
        "addr_token_sort_ratio": _edit("a_sa", "b_sa"), "addr_token_set_ratio": "round(a_set, 4)", "addr_jaccard_similarity": _jaccard(*distinct("normalized_address")), "addr_char_3gram_jaccard": grams("normalized_address"),
        "addr_numeric_overlap": _jaccard(*runs, "0.5"), "addr_postal_pin_match": "CASE WHEN a_postal_code = '' OR b_postal_code = '' THEN 0.5 WHEN a_postal_code = b_postal_code THEN 1.0 ELSE 0.0 END",
        "addr_len_diff_abs": addr[0], "addr_len_ratio": addr[1], "addr_token_count_diff": addr[2], "country_exact_match": both("original_country", "upper(trim({}))"), "country_norm_match": both("normalized_country"),
        "combined_text_similarity": "round(all_set, 4)", "name_x_addr_similarity": "round(n_set * a_set, 4)", "strong_agreement_indicator": f"CASE WHEN n_set >= 0.85 AND a_set >= 0.80 AND {both('normalized_country')} = 1 THEN 1.0 ELSE 0.0 END",
        "is_source2": "CASE WHEN target_entity_id LIKE 'S2%' THEN 1.0 ELSE 0.0 END", "num_rules_triggered": "len(rules)", **{f"{r}_flag": f"CASE WHEN list_contains(rules, '{r}') THEN 1.0 ELSE 0.0 END" for r in blocking.RULES},
    }
    whole = ("_len_diff_abs", "_token_count_diff", "num_rules_triggered")
    return more, ", ".join(f"CAST({v} AS {'BIGINT' if k.endswith(whole) else 'DOUBLE'}) AS {k}" for k, v in columns.items())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = [
        normalize_entities, text_stats, table_audit, country_distribution, gt_cardinality, suffix_frequency, casing_punct, address_patterns, address_abbreviations, frequent_tokens,
        postings, block_sizes, candidates_topk, candidate_export, blocking_summary, pair_features, pair_labels, entity_fbeta, macro_fbeta, candidate_recall, recall_by_source_fold,
        rule_ablation, missed_pairs, missed_sample, threshold_grid, best_threshold, split_assign, split_stats, baseline_matches, confusion_counts, hard_negatives, gbt_scores, inference_matches, submission_issues,
    ]
    found = {f.__name__: f for f in out}
    found |= {f"block_{r.removeprefix('rule_')}": _block(i + 1) for i, r in enumerate(blocking.RULES)}
    found |= {
        "sim_token_jaccard": _similarity({"similarity": _r(S.token_jaccard)}),
        "sim_char3gram": _similarity({"similarity": _r(S.ngram_jaccard)}),
        "sim_numeric": _similarity({"similarity": _r(S.numeric_jaccard)}, "normalized_address"),
        "sim_postal": _similarity({"similarity": S.postal_agreement}, "postal_code"),
        "sim_length": _similarity({"len_diff": lambda a, b: S.length_difference(a, b).cast("long"), "len_ratio": _r(S.length_ratio), "token_diff": lambda a, b: S.token_count_difference(a, b).cast("long")}),
        "sim_edit_ratio": _similarity({"similarity": _r(S.edit_ratio)}),
        "sim_token_sort": _similarity({"similarity": _r(S.token_sort_ratio)}),
        "sim_token_set": _similarity({"similarity": _r(S.token_set_ratio)}),
    }
    return found


def oracle_sql() -> dict[str, str]:
    pct = "round(100.0 * count(*) FILTER ({}) / count(*), 2)"
    suffix = "CASE " + " ".join(f"WHEN ends_with(' ' || normalized_name, {_q(' ' + s)}) THEN {_q(s)}" for s in T.SUFFIXES) + " END"
    casing = r"CASE WHEN NOT regexp_matches(n, '\p{L}') THEN 'none' WHEN n = upper(n) THEN 'all_uppercase' WHEN n = lower(n) THEN 'all_lowercase' WHEN regexp_full_match(n, '(?s)[^\p{L}]*(\p{Lu}[\p{Ll}\p{M}]*([^\p{L}]+|\z))+') AND NOT regexp_matches(n, '\p{L}''\p{L}') THEN 'title_case' ELSE 'mixed' END"
    found = {
        "normalize_entities": _sql(f" SELECT {', '.join(CLEAN)} FROM clean"),
        "text_stats": _sql(r" SELECT count(v) AS count, count(*) FILTER (v IS NULL) AS missing, count(DISTINCT v) AS unique_count, min(length(v)) AS char_len_min, max(length(v)) AS char_len_max, avg(len(list_filter(regexp_split_to_array(v, '\s+'), lambda t: t <> ''))) AS token_count_mean FROM (SELECT nullif(business_name, '') AS v FROM view_)"),
        "table_audit": _sql(" SELECT (SELECT count(*) FROM view_) AS num_rows, CAST(4 AS BIGINT) AS num_cols, (SELECT count(DISTINCT entity_id) FROM view_) AS unique_entity_ids, (SELECT count(*) - count(DISTINCT entity_id) FROM view_) AS duplicate_entity_ids, (SELECT count(*) FROM view_) - (SELECT count(*) FROM (SELECT DISTINCT entity_id, business_name, business_address, country FROM view_)) AS total_exact_duplicate_rows"),
        "country_distribution": _sql(" SELECT country AS value, count(*) AS n FROM view_ GROUP BY ALL"),
        "gt_cardinality": _sql(" SELECT count(*) AS total_s1, count(*) FILTER (n = 0) AS singletons_count, round(100.0 * count(*) FILTER (n = 0) / count(*), 2) AS singletons_pct, count(*) FILTER (n = 1) AS one_to_one, count(*) FILTER (n > 1) AS one_to_many, max(n) AS max_matches, avg(n) AS mean_matches, CAST(sum(s2) AS BIGINT) AS matched_targets_source2, CAST(sum(n - s2) AS BIGINT) AS matched_targets_source3 FROM (SELECT e.s1_entity_id, count(t.target_entity_id) AS n, count(*) FILTER (t.target_entity_id LIKE 'S2%') AS s2 FROM ents e LEFT JOIN truth t USING (s1_entity_id) GROUP BY ALL)"),
        "suffix_frequency": _sql(f" SELECT suffix, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM clean), 2) AS pct FROM (SELECT {suffix} AS suffix FROM clean) WHERE suffix IS NOT NULL GROUP BY ALL"),
        "casing_punct": _sql(rf" SELECT 'casing' AS what, {casing} AS value, count(*) AS n FROM (SELECT business_name AS n FROM view_ WHERE business_name <> '') GROUP BY ALL UNION ALL SELECT 'mark', m, count(*) FROM (SELECT unnest(regexp_extract_all(business_name, '[^\p{{L}}\p{{M}}\p{{N}}_\s]')) AS m FROM view_) GROUP BY ALL"),
        "address_patterns": _sql(" SELECT " + pct.format(r"regexp_matches(business_address, '\d')") + " AS with_numbers_pct, " + pct.format(r"regexp_matches(business_address, '\b\d{5}(?:-\d{4})?\b')") + " AS with_5digit_pct, " + pct.format(r"regexp_matches(business_address, '\b\d{6}\b')") + " AS with_6digit_pct FROM view_"),
        "address_abbreviations": _sql(rf" SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(business_address), '[^\p{{L}}\p{{N}}_]+')) AS token FROM view_) WHERE token IN ({', '.join(map(_q, T.ADDRESS_TOKENS))}) GROUP BY ALL"),
        "frequent_tokens": _sql(r" SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(business_name), '[^\p{L}\p{N}_]+')) AS token FROM view_) WHERE token <> '' GROUP BY ALL ORDER BY n DESC, token LIMIT 50"),
        "postings": _sql(" SELECT entity_id, CAST(rule AS BIGINT) AS rule, CAST(pos AS BIGINT) AS pos, key FROM posts"),
        "block_sizes": _sql(" SELECT CAST(rule AS BIGINT) AS rule, key, count(*) AS size FROM posts GROUP BY ALL"),
        "candidates_topk": _sql(" SELECT s1_entity_id, target_entity_id, target_source, array_to_string(rules, ',') AS rules_triggered, num_rules AS num_rules_triggered FROM cand"),
        "candidate_export": _sql(" SELECT e.s1_entity_id, coalesce(array_to_string(list_sort(list(target_entity_id) FILTER (target_entity_id IS NOT NULL)), ','), '') AS candidate_ids FROM ents e LEFT JOIN cand USING (s1_entity_id) GROUP BY ALL"),
        "blocking_summary": _sql(" SELECT CAST(sum(n) AS BIGINT) AS total_pairs, round(avg(n), 2) AS mean_candidates, max(n) AS max_candidates FROM (SELECT count(target_entity_id) AS n FROM ents LEFT JOIN cand USING (s1_entity_id) GROUP BY s1_entity_id)"),
        "sim_token_jaccard": _pair_sql(_jaccard(f"list_distinct({_list('a')})", f"list_distinct({_list('b')})") + " AS similarity"),
        "sim_char3gram": _pair_sql(f"CASE WHEN a = b THEN 1.0 ELSE {_jaccard(_grams('a'), _grams('b'))} END AS similarity"),
        "sim_numeric": _pair_sql(_jaccard(r"list_distinct(regexp_extract_all(x, '\b\d+\b'))", r"list_distinct(regexp_extract_all(y, '\b\d+\b'))", "0.5") + " AS similarity"),
        "sim_postal": _pair_sql("CASE WHEN p = '' OR q = '' THEN 0.5 WHEN p = q THEN 1.0 ELSE 0.0 END AS similarity"),
        "sim_length": _pair_sql(f"abs(length(a) - length(b)) AS len_diff, CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 ELSE round(CAST(least(length(a), length(b)) AS DOUBLE) / greatest(length(a), length(b)), 4) END AS len_ratio, abs(len({_list('a')}) - len({_list('b')})) AS token_diff"),
        "sim_edit_ratio": _pair_sql(_edit("a", "b") + " AS similarity"),
        "sim_token_sort": _sql(" SELECT s1_entity_id, target_entity_id, " + _edit("a", "b") + " AS similarity FROM sp", _PAIRS + _SORTED),
        "pair_labels": _sql(" SELECT c.s1_entity_id, c.target_entity_id, CAST(t.s1_entity_id IS NOT NULL AS BIGINT) AS is_match, CAST(v.s1_entity_id IS NOT NULL AS BIGINT) AS is_validation FROM cand c LEFT JOIN truth t USING (s1_entity_id, target_entity_id) LEFT JOIN val v ON v.s1_entity_id = c.s1_entity_id"),
        "entity_fbeta": _sql(" SELECT * FROM scored", _COUNTS),
        "macro_fbeta": _sql(" SELECT round(avg(f_beta), 9) AS macro_f_beta, round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, count(*) AS num_entities, count(*) FILTER (n_true = 0) AS num_singletons, CASE WHEN count(*) FILTER (n_true = 0) = 0 THEN 1.0 ELSE round(CAST(count(*) FILTER (n_true = 0 AND n_pred = 0) AS DOUBLE) / count(*) FILTER (n_true = 0), 9) END AS singleton_accuracy, CAST(sum(tp) AS BIGINT) AS total_tp, CAST(sum(n_pred - tp) AS BIGINT) AS total_fp, CAST(sum(n_true - tp) AS BIGINT) AS total_fn FROM scored", _COUNTS),
        "candidate_recall": _sql(" SELECT count(*) AS true_pairs, CAST(coalesce(sum(hit), 0) AS BIGINT) AS captured_pairs, coalesce(avg(hit), 1.0) AS recall FROM captured"),
        "recall_by_source_fold": _sql(" SELECT count(*) AS total_true_pairs, CAST(coalesce(sum(hit), 0) AS BIGINT) AS captured_true_pairs, coalesce(round(100.0 * avg(hit), 3), 100.0) AS overall_pct, round(100.0 * avg(hit) FILTER (NOT v), 3) AS train_pct, round(100.0 * avg(hit) FILTER (v), 3) AS val_pct, coalesce(round(100.0 * avg(hit) FILTER (target_entity_id LIKE 'S2%'), 2), 100.0) AS source2_pct, coalesce(round(100.0 * avg(hit) FILTER (target_entity_id LIKE 'S3%'), 2), 100.0) AS source3_pct FROM captured"),
        "rule_ablation": _sql(" SELECT rule, count(*) AS captured, round(100.0 * count(*) / (SELECT count(*) FROM truth), 2) AS coverage_pct, count(*) FILTER (n = 1) AS unique_pairs, round(100.0 * count(*) FILTER (n = 1) / (SELECT count(*) FROM truth), 2) AS unique_pct FROM (SELECT unnest(rules) AS rule, num_rules AS n FROM cand JOIN truth USING (s1_entity_id, target_entity_id)) GROUP BY ALL"),
        "missed_pairs": _sql(" SELECT s1_entity_id, target_entity_id FROM truth ANTI JOIN (FROM cand WHERE num_rules = 7) USING (s1_entity_id, target_entity_id)"),
        "missed_sample": _sql(", missed AS (SELECT s1_entity_id, target_entity_id FROM truth ANTI JOIN (FROM cand WHERE num_rules = 7) USING (s1_entity_id, target_entity_id)) SELECT s1_entity_id, target_entity_id, CASE WHEN target_entity_id LIKE 'S2%' THEN 'S2' ELSE 'S3' END AS target_source, (SELECT count(*) FROM missed) AS total FROM missed ORDER BY s1_entity_id, target_entity_id LIMIT 20"),
        "threshold_grid": _sql(" SELECT * FROM done", _GRID),
        "best_threshold": _sql(" SELECT * FROM done ORDER BY macro_f_beta DESC, threshold LIMIT 1", _GRID),
        "split_assign": _sql(" SELECT entity_id, stratum, fold FROM folds"),
        "split_stats": _sql(" SELECT fold, stratum, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY fold), 2) AS pct FROM folds GROUP BY fold, stratum"),
        "confusion_counts": _sql(" SELECT count(*) FILTER (s AND m) AS tp, count(*) FILTER (s AND NOT m) AS fp, count(*) FILTER (NOT s AND m) AS fn, count(*) FILTER (NOT s AND NOT m) AS tn FROM (SELECT c.num_rules / 7.0 >= 0.5 AS s, t.s1_entity_id IS NOT NULL AS m FROM cand c LEFT JOIN truth t USING (s1_entity_id, target_entity_id))"),
        "hard_negatives": _sql(", l AS (SELECT c.s1_entity_id, c.target_entity_id, CAST(t.s1_entity_id IS NOT NULL AS BIGINT) AS is_match, CAST(v.s1_entity_id IS NOT NULL AS BIGINT) AS is_validation, c.num_rules / 7.0 AS score FROM cand c LEFT JOIN truth t USING (s1_entity_id, target_entity_id) LEFT JOIN val v ON v.s1_entity_id = c.s1_entity_id) SELECT s1_entity_id, target_entity_id, is_match, is_validation, CAST(0 AS BIGINT) AS is_hard_negative, CAST(NULL AS DOUBLE) AS model_score FROM l UNION ALL SELECT s1_entity_id, target_entity_id, is_match, is_validation, 1, round(score, 4) FROM l WHERE is_match = 0 AND score >= 0.5"),
        "submission_issues": _sql(
            """, listed AS (SELECT e.s1_entity_id AS id, e.s1_entity_id[-1:] AS last, list(t.target_entity_id) FILTER (t.target_entity_id IS NOT NULL) AS items FROM ents e LEFT JOIN truth t USING (s1_entity_id) GROUP BY ALL),
            m1 AS (SELECT id, CASE WHEN last = '8' THEN id || 'x' ELSE id END AS s1, last, CASE WHEN last = '2' THEN ['S2_none', 'S2_none'] WHEN last = '4' THEN [id] ELSE items END AS items FROM listed WHERE last <> '7'),
            m AS (FROM m1 UNION ALL FROM m1 WHERE last = '0'),
            c1 AS (SELECT e.s1_entity_id AS s1, e.s1_entity_id[-1:] AS last, list(c.target_entity_id) FILTER (c.target_entity_id IS NOT NULL) AS items FROM ents e LEFT JOIN cand c USING (s1_entity_id) GROUP BY ALL),
            c2 AS (SELECT s1, last, CASE WHEN last = '3' THEN list_concat(coalesce(items, []), ['S2_none', 'S2_none']) ELSE items END AS items FROM c1),
            c AS (FROM c2 UNION ALL FROM c2 WHERE last = '1'),
            mp AS (SELECT s1, unnest(items) AS t FROM m), cp AS (SELECT s1, unnest(items) AS t FROM c), pool AS (SELECT entity_id AS t FROM view_ WHERE source <> 'S1'),
            found AS (
              SELECT 'duplicate_s1_in_candidates' AS issue FROM c GROUP BY s1 HAVING count(*) > 1
              UNION ALL SELECT 'duplicate_s1_in_matches' FROM m GROUP BY s1 HAVING count(*) > 1
              UNION ALL SELECT 'duplicate_target_in_candidates' FROM cp GROUP BY s1, t HAVING count(*) > 1
              UNION ALL SELECT 'duplicate_target_in_matches' FROM mp GROUP BY s1, t HAVING count(*) > 1
              UNION ALL SELECT 'match_not_in_candidates' FROM (SELECT DISTINCT * FROM mp) x ANTI JOIN cp USING (s1, t)
              UNION ALL SELECT 'match_not_a_target' FROM (SELECT DISTINCT * FROM mp) x ANTI JOIN pool USING (t)
              UNION ALL SELECT 'match_is_an_s1_entity' FROM (SELECT DISTINCT * FROM mp) x SEMI JOIN (SELECT s1_entity_id AS t FROM ents) y USING (t)
              UNION ALL SELECT 'missing_s1_in_matches' FROM ents e ANTI JOIN m ON m.s1 = e.s1_entity_id
              UNION ALL SELECT 'unexpected_s1_in_matches' FROM (SELECT DISTINCT s1 FROM m) x ANTI JOIN ents e ON e.s1_entity_id = x.s1)
            SELECT issue, count(*) AS n FROM found GROUP BY issue"""
        ),
    }
    found["gbt_scores"] = _sql(" SELECT CAST(t.s1_entity_id IS NOT NULL AS BIGINT) AS is_match, CAST(v.s1_entity_id IS NOT NULL AS BIGINT) AS is_validation, count(*) AS n, true AS in_range, true AS right_side FROM cand c LEFT JOIN truth t USING (s1_entity_id, target_entity_id) LEFT JOIN val v ON v.s1_entity_id = c.s1_entity_id GROUP BY ALL")
    found["inference_matches"] = _sql(" SELECT count(*) AS n, count(DISTINCT s1_entity_id) AS entities, true AS candidates_only, true AS in_order FROM ents")
    more, columns = _features_sql()
    found["pair_features"] = _sql(f" SELECT s1_entity_id, target_entity_id, {columns} FROM all_set_of", more)
    found["baseline_matches"] = _sql(f", f AS (SELECT s1_entity_id, target_entity_id, {columns} FROM all_set_of), b AS (SELECT s1_entity_id, target_entity_id, 0.55 * name_token_set_ratio + 0.35 * addr_token_set_ratio + 0.1 * country_exact_match AS score FROM f) SELECT s1_entity_id, target_entity_id, round(score, 6) AS score FROM b WHERE score >= 0.65", more)
    found["sim_token_set"] = _sql(" SELECT s1_entity_id, target_entity_id, round(r_set, 4) AS similarity FROM r_set_of", _PAIRS + ", " + _token_set("r_set", "pairs", "a", "b"))
    for i, r in enumerate(blocking.RULES):
        found[f"block_{r.removeprefix('rule_')}"] = _sql(f" SELECT DISTINCT p.entity_id AS s1_entity_id, t.entity_id AS target_entity_id FROM probes p JOIN small USING (rule, key) JOIN posts t USING (rule, key) WHERE rule = {i + 1}")
    return found
