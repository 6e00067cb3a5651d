"""Candidate pairs: one equi-join on exploded keys of seven rules, oversized blocks pruned before it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.memory import freed
from ..functions.text import tokens

# Words that make no block of their own.
STOPWORDS = [
    "and", "the", "of", "in", "for", "on", "at", "to",
    "a", "an", "services", "service", "store", "shop", "center", "centre",
    "solutions", "enterprises", "group", "holdings", "trading", "international", "global", "corporation",
    "company", "limited", "pvt", "ltd", "inc", "llc",
]

RULES = ("rule_exact_name", "rule_clean_name", "rule_exact_addr", "rule_prefix_tokens", "rule_rare_token", "rule_postal_digits", "rule_char_3gram")
MAX_CANDIDATES, MAX_BLOCK = 100, 1500
#: Hits that are sorted at once (an entity's are not torn apart).
_HITS = 1_000_000


def _keys(probe: bool) -> Column:
    """array<struct<rule, pos, key>>: a record's keys, as a target or (probe) as an S1 entity."""
    name, clean, addr = F.col("normalized_name"), F.col("clean_name_no_suffix"), F.col("normalized_address")
    post, digit = F.col("postal_code"), F.split("address_digits", " ")[0]
    words = tokens(F.when(clean != "", clean).otherwise(name))
    item = lambda rule, key, pos=F.lit(0): F.struct(F.lit(rule).alias("rule"), pos.alias("pos"), key.alias("key"))
    none = F.lit(None).cast("string")
    postal = F.when((post != "") & (digit != ""), F.concat_ws("_", post, digit))
    if not probe:
        postal = F.coalesce(postal, F.when(post != "", post))
    grams = [item(7, F.when(F.length(clean) >= 3, F.substring(clean, 1, 3)))]
    if not probe:
        grams.append(item(7, F.when(F.length(clean) >= 6, F.substring(clean, 4, 3))))
    single = F.array(
        item(1, F.when(name != "", name)),
        item(2, F.when(clean != "", clean)),
        item(3, F.when(addr != "", addr)),
        item(4, F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, 2), "_"))),
        item(6, F.coalesce(postal, none)),
        *grams,
    )
    rare = F.transform(words, lambda t, i: item(5, F.when((F.length(t) >= 3) & ~t.isin(*STOPWORDS), t), i))
    return F.filter(F.concat(single, rare), lambda k: k["key"].isNotNull())


def postings(clean: DataFrame, probe: bool = False, id_col: str = "entity_id") -> DataFrame:
    """(entity_id, rule, pos, key): the blocking keys of clean records, repeats included."""
    return clean.select(F.col(id_col).alias("entity_id"), F.explode(_keys(probe)).alias("k")).select("entity_id", "k.rule", "k.pos", "k.key")


def block_sizes(targets: DataFrame) -> DataFrame:
    """(rule, key, size) of the target blocks; a record counts as often as it has the key."""
    return postings(targets).groupBy("rule", "key").agg(F.count("*").alias("size"))


def pruned(keys: DataFrame, max_block: int = MAX_BLOCK, by: tuple[str, ...] = ("rule", "key")) -> DataFrame:
    """keys without the rows of blocks of more than max_block rows; the blocks are counted before any join."""
    small = keys.groupBy(*by).agg(F.count("*").alias("size")).filter(F.col("size") <= max_block).select(*by)
    return keys.join(small, list(by), "left_semi")


def rule_hits(s1: DataFrame, targets: DataFrame, rule: int, max_block: int = MAX_BLOCK) -> DataFrame:
    """(s1_entity_id, target_entity_id): the distinct pairs that one rule finds."""
    kept = pruned(postings(targets).filter(F.col("rule") == rule), max_block).select("key", F.col("entity_id").alias("target_entity_id")).distinct()
    probe = postings(s1, probe=True).filter(F.col("rule") == rule).select(F.col("entity_id").alias("s1_entity_id"), "key").distinct()
    return probe.join(kept, "key").select("s1_entity_id", "target_entity_id").distinct()


def _best(max_candidates: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For one bucket: the keys of its S1 entities and the blocks of these keys -> each entity's best targets."""

    def found(probes: pa.Table, blocks: pa.Table) -> pa.Table:
        name = lambda rule, key: pc.binary_join_element_wise(rule.cast(pa.string()), key, ":").combine_chunks()
        at = pc.index_in(name(probes["rule"], probes["key"]), value_set=name(blocks["number"], blocks["word"]))
        probes, at = probes.filter(at.is_valid()), at.drop_null().to_numpy(zero_copy_only=False)
        entities = probes["s1_entity_id"].combine_chunks().dictionary_encode()
        who = entities.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lists = blocks["targets"].combine_chunks()
        targets, member = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        size = np.diff(ends, prepend=0)[at]
        rule, pos = (probes[c].to_numpy().astype(np.int64) for c in ("rule", "pos"))
        places, place = np.unique(rule << 32 | pos, return_inverse=True)  # (rule, pos) by number, in order
        bit = (1 << (places >> 32) - 1).astype(np.uint8)
        order = np.argsort(who, kind="stable")
        who, place, size, start = who[order], place[order], size[order], (ends[at] - np.diff(ends, prepend=0)[at])[order]
        p, t = max(1, len(places).bit_length()), max(1, len(targets).bit_length())
        out, k = [], 0
        while k < len(who):
            # so many whole entities as their hits and the bits of a number allow
            upto = min(int(np.searchsorted(np.cumsum(size[k:]), _HITS, "right")) + k, int(np.searchsorted(who, who[k] + (1 << 63 - 10 - p - t))))
            upto = int(np.searchsorted(who, who[min(upto, len(who) - 1)])) if upto < len(who) else upto
            upto = max(upto, int(np.searchsorted(who, who[k], "right")))
            n, first = size[k:upto], who[k]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hits = np.repeat((who[k:upto] - first << p + t) | place[k:upto], n) | member[np.repeat(start[k:upto], n) + inside] << p
            hits.sort()  # by entity, target, rule and position
            pair = hits >> p
            head = np.flatnonzero(np.diff(pair, prepend=-1))
            if not len(head):
                break
            numbers = np.bitwise_or.reduceat(bit[hits & (1 << p) - 1], head)
            pair, place_ = pair[head], hits[head] & (1 << p) - 1
            rest = 7 - np.bitwise_count(numbers).astype(np.int64)
            best = (((pair >> t << 3 | rest) << p | place_) << t | pair & (1 << t) - 1) << 7 | numbers
            best.sort()
            one = best >> 10 + p + t
            rank = np.arange(len(one)) - np.searchsorted(one, one) + 1
            kept = rank <= max_candidates
            out.append((one[kept] + first, targets[best[kept] >> 7 & (1 << t) - 1], best[kept] & 127, rank[kept]))
            k = upto
        one, target, numbers, rank = (np.concatenate([x[i] for x in out] or [np.zeros(0, np.int64)]) for i in range(4))
        freed()
        return pa.table({"s1_entity_id": entities.dictionary.take(pa.array(one, pa.int64())), "target": pa.array(target, pa.int64()), "numbers": pa.array(numbers, pa.int32()), "rank": pa.array(rank, pa.int32())})

    return found


def candidates(s1: DataFrame, targets: DataFrame, max_candidates: int = MAX_CANDIDATES, max_block: int = MAX_BLOCK) -> DataFrame:
    """(s1_entity_id, target_entity_id, target_source, rules, num_rules, rank): the targets that share a key.

    Blocks over max_block are dropped before the join, so no key brings an S1 entity more rows than that. Of an
    entity's candidates the first max_candidates stay: more rules first, then the earlier first rule and token,
    then S2 before S3 and the smaller id.

    Targets are numbered in that last order. S1 entities are dealt to buckets, and a block goes once to each bucket that
    asks for it, as one array; an entity's hits are sorted there as 64-bit numbers and never become rows."""
    source = F.when(F.upper("target_entity_id").contains("S2"), "S2").otherwise("S3")
    ids = targets.select(F.col("entity_id").alias("target_entity_id")).distinct().withColumn("target_source", source)
    # persisted, so that a target has one number for all its uses
    ids = ids.orderBy("target_source", "target_entity_id").withColumn("target", F.monotonically_increasing_id()).persist()
    kept = pruned(postings(targets), max_block).select("rule", "key", F.col("entity_id").alias("target_entity_id")).distinct()
    blocks = kept.join(ids, "target_entity_id").groupBy("rule", "key").agg(F.collect_list("target").alias("targets"))
    spark = s1.sparkSession
    buckets = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)  # a block goes to most of them
    probes = postings(s1, probe=True).select(F.pmod(F.xxhash64("entity_id"), F.lit(buckets)).cast("int").alias("bucket"), F.col("entity_id").alias("s1_entity_id"), "rule", "pos", "key")
    asked = probes.select("bucket", "rule", "key").distinct().join(blocks, ["rule", "key"]).select(F.col("bucket").alias("to"), F.col("rule").alias("number"), F.col("key").alias("word"), "targets")
    best = probes.groupBy("bucket").cogroup(asked.groupBy("to")).applyInArrow(_best(max_candidates), "s1_entity_id string, target long, numbers int, rank int")
    named = F.array(*[F.when(F.col("numbers").bitwiseAND(1 << i) != 0, F.lit(r)) for r, i in sorted((r, i) for i, r in enumerate(RULES))])
    return best.join(ids.hint("shuffle_hash"), "target").select("s1_entity_id", "target_entity_id", "target_source", F.array_compact(named).alias("rules"), F.bit_count("numbers").alias("num_rules"), "rank")


def exported(pairs: DataFrame) -> DataFrame:
    """Candidate pairs with their rules as one sorted, comma-joined string."""
    return pairs.select("s1_entity_id", "target_entity_id", "target_source", F.array_join("rules", ",").alias("rules_triggered"), F.col("num_rules").cast("int").alias("num_rules_triggered"))


def summary(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: pairs, and their mean and largest number for an S1 entity (one without candidates counts)."""
    per = s1.select(F.col("entity_id").alias("s1_entity_id")).distinct().join(pairs.groupBy("s1_entity_id").agg(F.count("*").alias("n")), "s1_entity_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return per.agg(F.sum("n").alias("total_pairs"), F.round(F.avg("n"), 2).alias("mean_candidates"), F.max("n").alias("max_candidates"))


def inverted_index(records: DataFrame, keys: Column, id_col: str = "entity_id") -> DataFrame:
    """(key, entity_id) for keys (an array of strings) of two characters or more."""
    return records.select(F.explode(keys).alias("key"), id_col).filter(F.length("key") >= 2)
