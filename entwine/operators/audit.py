"""Audits and explorations of entity tables: one aggregation each, reports of a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ADDRESS_TOKENS, SUFFIXES


def text_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: present and missing values, distinct ones, shortest, longest, mean tokens."""
    x = F.col(column)
    full = F.coalesce(x, F.lit("")) != ""
    value = F.when(full, x)
    return df.agg(
        F.count(value).alias("count"),
        F.count_if(~full).alias("missing"),
        F.countDistinct(value).alias("unique_count"),
        F.min(F.length(value)).cast("long").alias("char_len_min"),
        F.max(F.length(value)).cast("long").alias("char_len_max"),
        F.avg(F.size(F.array_remove(F.split(F.trim(value), r"\s+"), ""))).alias("token_count_mean"),
    )


def table_audit(df: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """One row: rows, columns, distinct ids, repeated ids, rows beyond the first of equal rows."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    groups = df.groupBy(whole.alias("row")).agg(F.count("*").alias("n"))
    ids = groups.select(F.col(f"row.{id_col}").alias("id"), "n").groupBy("id").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    return ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
        F.lit(len(df.columns)).cast("long").alias("num_cols"),
        F.count("id").alias("unique_entity_ids"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("id")).alias("duplicate_entity_ids"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.coalesce(F.sum("k"), F.lit(0))).alias("total_exact_duplicate_rows"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def truth_cardinality(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """One row: S1 entities by the number of their matches; one without any is a singleton."""
    per = s1.select("s1_entity_id").distinct().join(pairs.groupBy("s1_entity_id").agg(F.count("*").alias("n"), F.count_if(F.upper("target_entity_id").contains("S2")).alias("s2")), "s1_entity_id", "left")
    n, s2 = F.coalesce("n", F.lit(0)), F.coalesce("s2", F.lit(0))
    return per.agg(
        F.count("*").alias("total_s1"),
        F.count_if(n == 0).alias("singletons_count"),
        F.round(100.0 * F.count_if(n == 0) / F.count("*"), 2).alias("singletons_pct"),
        F.count_if(n == 1).alias("one_to_one"),
        F.count_if(n > 1).alias("one_to_many"),
        F.max(n).alias("max_matches"),
        F.avg(n).alias("mean_matches"),
        F.sum(s2).alias("matched_targets_source2"),
        F.sum(n - s2).alias("matched_targets_source3"),
    )


def suffix_frequency(names: DataFrame, column: str) -> DataFrame:
    """(suffix, n, pct): how many names end in each legal suffix (the first of the list that fits)."""
    low = F.concat(F.lit(" "), F.lower(F.trim(F.col(column))))
    hit = F.coalesce(*[F.when(low.endswith(" " + s), F.lit(s)) for s in SUFFIXES])
    counted = names.select(hit.alias("suffix")).groupBy("suffix").agg(F.count("*").alias("n"))
    total = names.agg(F.count("*").alias("total"))
    return counted.filter("suffix is not null").crossJoin(F.broadcast(total)).select("suffix", "n", F.round(100.0 * F.col("n") / F.col("total"), 2).alias("pct"))


def casing(column: Column) -> Column:
    """all_uppercase, all_lowercase, title_case (every token a capital and small letters, with marks around), mixed or none."""
    has = column.rlike(r"\p{L}")
    title = column.rlike(r"^[^\p{L}]*(?:\p{Lu}[\p{Ll}\p{M}]*(?:[^\p{L}]+|$))+$")
    return F.when(~has, "none").when(column == F.upper(column), "all_uppercase").when(column == F.lower(column), "all_lowercase").when(title & ~column.rlike(r"\p{L}'\p{L}"), "title_case").otherwise("mixed")


def casing_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.coalesce(F.col(column), F.lit("")) != "").select(casing(F.col(column)).alias("casing")).groupBy("casing").agg(F.count("*").alias("n"))


def punctuation(df: DataFrame, column: str) -> DataFrame:
    marks = F.explode(F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(r"[^\p{L}\p{M}\p{N}_\s]"), 0))
    return df.select(marks.alias("mark")).groupBy("mark").agg(F.count("*").alias("n"))


def address_patterns(df: DataFrame, column: str) -> DataFrame:
    """One row: per cent of addresses with digits, a five-digit and a six-digit code."""
    x = F.coalesce(F.col(column), F.lit(""))
    share = lambda c: F.round(100.0 * F.count_if(c) / F.count("*"), 2)
    return df.agg(share(x.rlike(r"\d")).alias("with_numbers_pct"), share(x.rlike(r"\b\d{5}(?:-\d{4})?\b")).alias("with_5digit_pct"), share(x.rlike(r"\b\d{6}\b")).alias("with_6digit_pct"))


def address_abbreviations(df: DataFrame, column: str) -> DataFrame:
    word = F.explode(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"[^\p{L}\p{N}_]+"))
    return df.select(word.alias("token")).filter(F.col("token").isin(*ADDRESS_TOKENS)).groupBy("token").agg(F.count("*").alias("n"))


def frequent_tokens(df: DataFrame, column: str, most: int = 50) -> DataFrame:
    """The most frequent lower-case tokens; ties by token."""
    word = F.explode(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"[^\p{L}\p{N}_]+"))
    return df.select(word.alias("token")).filter("token <> ''").groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(most)
