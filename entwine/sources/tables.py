"""Entity tables, ground truth, lists and reports: reading and writing."""

from __future__ import annotations

import json
import shutil
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

ENTITY_COLUMNS = ("entity_id", "business_name", "business_address", "country")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A TSV of strings with quotes doubled as in RFC 4180; bad bytes are replaced, blank rows skipped."""
    found = spark.read.options(sep="\t", header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8", mode="PERMISSIVE").csv(path)
    filled = found.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in found.columns])
    return filled.filter(F.concat(*[F.col(f"`{c}`") for c in filled.columns]) != "")


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Columns by trimmed lower-case name, else by position; missing ones are empty."""
    raw = read_tsv(spark, path)
    by_name = {c.strip().lower(): c for c in raw.columns}
    out = []
    for i, want in enumerate(ENTITY_COLUMNS):
        have = by_name.get(want) or (raw.columns[i] if i < len(raw.columns) and raw.columns[i].strip().lower() not in ENTITY_COLUMNS else None)
        out.append((F.col(f"`{have}`") if have else F.lit("")).alias(want))
    return raw.select(*out)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A clean table: Parquet, or the TSV of the same name."""
    found = Path(path)
    if found.suffix == ".tsv" or ("://" not in path and not found.exists() and found.with_suffix(".tsv").exists()):
        return read_tsv(spark, str(found.with_suffix(".tsv")))
    return spark.read.parquet(path)


def find_file(folder: str, key: str) -> str | None:
    """The first file of a local folder with the key in its name."""
    return next((str(p) for p in sorted(Path(folder).glob(f"*{key}*")) if p.is_file()), None)


def truth_pairs(raw: DataFrame, distinct: bool = True) -> DataFrame:
    """(s1_entity_id, target_entity_id) from an id column and a comma-joined one, by position."""
    a, b = raw.columns[:2]
    pairs = raw.select(F.trim(F.col(f"`{a}`")).alias("s1_entity_id"), F.explode(F.transform(F.split(F.coalesce(F.col(f"`{b}`"), F.lit("")), ","), lambda x: F.trim(x))).alias("target_entity_id")).filter("target_entity_id <> '' and s1_entity_id <> ''")
    return pairs.distinct() if distinct else pairs


def truth_entities(raw: DataFrame) -> DataFrame:
    """(s1_entity_id): every id of a ground truth, those without a match too."""
    return raw.select(F.trim(F.col(f"`{raw.columns[0]}`")).alias("s1_entity_id")).filter("s1_entity_id <> ''").distinct()


def joined_lists(ids: DataFrame, pairs: DataFrame, key: str = "s1_entity_id", value: str = "target_entity_id", out: str = "matching_ids") -> DataFrame:
    """Every id with its sorted values, comma-joined; empty if it has none."""
    lists = pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias(out))
    return ids.select(key).distinct().join(lists, key, "left").select(key, F.coalesce(out, F.lit("")).alias(out))


def write_tsv(df: DataFrame, path: str, order_by: str | None = None) -> None:
    rows = df.orderBy(order_by) if order_by else df
    rows.write.mode("overwrite").options(sep="\t", header=True, quote='"', escape='"').csv(path)


def listed_ids(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(s1_entity_id) of the list `name` in a JSON object; none if there is no such file."""
    if not files.exists(path):
        return spark.createDataFrame([], "s1_entity_id string")
    raw = spark.read.schema(f"{name} array<string>").option("multiLine", True).json(path)
    return raw.select(F.explode(name).alias("s1_entity_id")).select(F.trim("s1_entity_id").alias("s1_entity_id")).distinct()


def unpack(archives: str | list[str], folder: str, force: bool = False) -> list[str]:
    """The tables of the first of some zip archives that is there, flattened into a local folder. Tables that are there
    already stay, unless forced."""
    archive = next((a for a in ([archives] if isinstance(archives, str) else archives) if Path(a).exists()), None)
    if archive is None:
        raise FileNotFoundError(f"no archive at {archives}")
    out = []
    Path(folder).mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive) as z:
        for name in z.namelist():
            target = Path(folder) / Path(name).name
            if target.suffix.lower() in (".tsv", ".csv"):
                if force or not target.exists():
                    with z.open(name) as source, target.open("wb") as to:
                        shutil.copyfileobj(source, to)
                out.append(target.name)
    return out


def pack(sources: dict[str, str], archive: str, about: dict | None = None) -> dict[str, object]:
    """A zip archive of local files by the names they get in it, and of `about` as info.json. A folder of part files with
    headers becomes one file with one. Returns what is in it and what was missing."""
    there = {name: Path(p) for name, p in sources.items() if Path(p).exists()}
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("info.json", json.dumps(about or {}, indent=2, default=str))
        for name, path in there.items():
            if path.is_file():
                z.write(path, name)
                continue
            with z.open(name, "w") as to:
                for k, part in enumerate(sorted(path.glob("part-*"))):
                    with part.open("rb") as source:
                        if k:
                            source.readline()
                        shutil.copyfileobj(source, to)
    return {"path": archive, "bytes": Path(archive).stat().st_size, "included": list(there), "missing": [n for n in sources if n not in there]}


def entity_view(documents: DataFrame) -> DataFrame:
    """(source, entity_id, business_name, business_address, country, text): documents dealt to three sources. A name is a
    text's first four words and a legal form by its language, an address its next five with numbers from its length; the
    text as a whole tells which entities are the same."""
    form = F.when(F.col("lang") == "de", " GmbH").when(F.col("lang") == "fr", " Sarl").when(F.col("lang") == "en", F.when(F.col("doc_id") % 2 == 0, " Inc.").otherwise(" Pvt Ltd")).otherwise("")
    source = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"))
    words = F.split(F.coalesce("text", F.lit("")), " ")
    code = F.lpad((F.col("n_chars") * 7 % 100000).cast("string"), 5, "0")
    return documents.select(
        source.alias("source"),
        F.concat(source, F.lit("_"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.concat(F.array_join(F.slice(words, 1, 4), " "), form).alias("business_name"),
        F.concat_ws(" ", F.col("n_chars").cast("string"), F.array_join(F.slice(words, 5, 5), " "), code).alias("business_address"),
        F.col("lang").alias("country"),
        "text",
    )
