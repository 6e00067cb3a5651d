"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts become lower-case words of letters and digits. Fixed masks choose some of a few neighbouring words and
ignore the rest, so a substituted word spoils only the windows that look at it. Hashes of every window of the
test items are joined with those of every window of the texts; around a hit the two word rows are compared
place by place, and a stretch of OVERLAP words (or the whole item, if shorter) that agrees in SHARE of its
places is contamination. The masks are such that every stretch that agrees so is hit by one of them, whichever of
its words are substituted, so none is missed. An item of under SHORT words counts where all of it stands word for word.

The distinct hashes of the items are broadcast in blocks of BLOCK_HASHES, a proven size; a larger benchmark is met
block after block. The texts are never shuffled: windows are exploded, hashed and probed within one generated loop,
and only windows that hit leave it, with the words around them, to meet the items that have the hash.

Null texts count as empty; null and empty items match nothing. Rows without an id are judged together, as one id.
Repeated ids share one result: a row is contaminated if any row of its id is. Repeated items each count.
Extra columns are ignored. An empty benchmark leaves every text clean; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, unused

#: The words a window looks at, by mask.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4))
OVERLAP, SHARE = 15, 0.8
#: Items of fewer words are matched whole; those too short for any mask have one of their own.
SHORT = 9
TINY = min(m[-1] for m in MASKS)
BLOCK_HASHES = 2_000_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _probes(tiny: list[int]) -> list[tuple[int, ...]]:
    """All masks: those of MASKS, and one for each length of items that they do not fit."""
    return [*MASKS, *[tuple(range(n)) for n in tiny]]


def windows(rows: DataFrame, tiny: list[int], whole: bool = False) -> DataFrame:
    """rows (.., words) by window: its place `at`, and the hash of what a mask sees there. whole: masks of tiny items
    see only rows of their own length."""
    masks, size = _probes(tiny), F.size("words")
    hashes = []
    for number, mask in enumerate(masks):
        fits = F.col("at") + mask[-1] < size
        if number >= len(MASKS) and whole:
            fits = fits & (size == len(mask))
        hashes.append(F.when(fits, F.xxhash64(F.lit(mask[-1] * 100 + number if number < len(MASKS) else -len(mask)), *[F.get("words", F.col("at") + k) for k in mask])))
    least = min(len(m) for m in masks)
    placed = rows.filter(size >= least).withColumn("at", F.explode(F.sequence(F.lit(0), size - least)))
    return placed.withColumn("hash", F.explode(F.array(*hashes))).filter("hash is not null")


def _around(reach: int) -> Column:
    """The words from reach before a window's place to OVERLAP behind it; null where there is none."""
    return F.transform(F.sequence(F.lit(-reach), F.lit(OVERLAP - 1)), lambda k: F.get(F.col("words"), F.when(F.col("at") + k >= 0, F.col("at") + k).otherwise(F.lit(1 << 30))))


#: How far before its seed a stretch may begin: it holds TINY + 1 of the seed's words at least.
_REACH = OVERLAP - TINY - 1


def item_windows(items: DataFrame, tiny: list[int], item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, n_words, near, hash): every window of every item with the words it may be verified by."""
    rows = items.select(F.col(item_col).alias("item"), words(F.col(text_col).cast("string")).alias("words"))
    return windows(rows, tiny, whole=True).select("item", F.size("words").alias("n_words"), _around(_REACH).alias("near"), "hash")


def _agrees() -> tuple[Column, Column]:
    """Which places agree, and whether some stretch of OVERLAP words around the hit agrees in enough of them (over a column `same`)."""
    same = F.zip_with("here", "near", lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int"))
    sums = F.transform(F.sequence(F.lit(0), F.lit(_REACH)), lambda s: F.aggregate(F.slice(F.col("same"), s + 1, F.lit(OVERLAP)), F.lit(0), lambda x, y: x + y))
    need = F.when(F.col("n_words") < SHORT, F.col("n_words")).otherwise(F.ceil(F.least(F.lit(OVERLAP), F.col("n_words")) * F.lit(SHARE)))
    return same, F.array_max(sums) >= need


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item): the distinct pairs of a text and an item that share a verified overlap."""
    sizes = items.select(F.size(words(F.col(item_text_col).cast("string"))).alias("n")).filter((F.col("n") > 0) & (F.col("n") <= TINY)).distinct()
    tiny = sorted(r["n"] for r in sizes.collect())  # TINY lengths at most
    table = materialize(item_windows(items, tiny, item_col, item_text_col))
    hashes = materialize(table.select("hash").distinct())
    blocks = max(1, -(-hashes.count() // BLOCK_HASHES))
    rows = docs.select(F.col(id_col).alias("id"), words(F.col(text_col).cast("string")).alias("words"))
    seen = windows(rows, tiny)
    part = F.pmod(F.xxhash64(F.lit(5), "hash"), F.lit(blocks))
    hits = [seen.join(F.broadcast(hashes.filter(part == b) if blocks > 1 else hashes), "hash", "left_semi").select("id", "hash", _around(_REACH).alias("here")) for b in range(blocks)]
    found = materialize(reduce(DataFrame.union, hits)).join(table, "hash")
    same, agrees = _agrees()
    return found.select("id", "item", "n_words", same.alias("same")).filter(agrees).select("id", "item").distinct()


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, items): for each row of docs the sorted items found in texts of its id; empty if clean."""
    pairs = matches(docs, items, id_col, text_col, item_col, item_text_col)
    by_id = pairs.groupBy("id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast(by_id.schema["items"].dataType)
    rows = docs.select(F.col(id_col).alias("id")).join(by_id.withColumnRenamed("id", "found"), F.col("id").eqNullSafe(F.col("found")), "left")
    return rows.select("id", F.coalesce("items", none).alias("items"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs without the rows that hold an item. Rows without an id are judged together, as one id."""
    spare = unused(docs, "found")
    gone = matches(docs, items, id_col, text_col, item_col, item_text_col).select(F.col("id").alias(spare)).distinct()
    return docs.join(materialize(gone), F.col(id_col).eqNullSafe(F.col(spare)), "left_anti")
