"""Normalisation of names, addresses and countries, as Column expressions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal suffixes, in the order in which they are tried.
SUFFIXES = [
    "private limited",
    "limited liability company",
    "pvt ltd",
    "pvt. ltd.",
    "pte ltd",
    "pty ltd",
    "corp.",
    "corp",
    "corporation",
    "incorporated",
    "inc.",
    "inc",
    "ltd.",
    "ltd",
    "limited",
    "llc.",
    "llc",
    "llp.",
    "llp",
    "pllc",
    "gmbh",
    "s.a.s.",
    "sas",
    "s.a.",
    "sa",
    "s.a.r.l.",
    "sarl",
    "co.",
    "co",
    "company",
]

# Address tokens and what they stand for. Tokens with dots are not listed: dots are gone by then.
ADDRESS_TOKENS = {
    "st": "street",
    "rd": "road",
    "ave": "avenue",
    "av": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "ct": "court",
    "pl": "place",
    "sq": "square",
    "ste": "suite",
    "apt": "apartment",
    "fl": "floor",
    "flr": "floor",
    "bldg": "building",
    "hwy": "highway",
    "pkwy": "parkway",
    "terr": "terrace",
    "cir": "circle",
    "n": "north",
    "s": "south",
    "e": "east",
    "w": "west",
    "ne": "northeast",
    "nw": "northwest",
    "se": "southeast",
    "sw": "southwest",
}

# Country spellings (without punctuation) and their canonical names.
COUNTRIES = {
    "usa": "US",
    "united states": "US",
    "united states of america": "US",
    "us": "US",
    "in": "INDIA",
    "ind": "INDIA",
    "india": "INDIA",
    "bharat": "INDIA",
    "fr": "FRANCE",
    "fra": "FRANCE",
    "france": "FRANCE",
    "french republic": "FRANCE",
    "uk": "UNITED KINGDOM",
    "united kingdom": "UNITED KINGDOM",
    "great britain": "UNITED KINGDOM",
    "gb": "UNITED KINGDOM",
    "gbr": "UNITED KINGDOM",
    "de": "GERMANY",
    "deu": "GERMANY",
    "germany": "GERMANY",
    "deutschland": "GERMANY",
}

NOT_WORD = r"[^\p{L}\p{N}_\s]"


def suffix_pattern() -> str:
    return " (?:" + "|".join(s.replace(".", r"\.") for s in SUFFIXES) + ")$"


@F.arrow_udf(StringType())
def _decomposed(text: pa.Array) -> pa.Array:
    """NFKD, which Spark has no function for; ASCII batches pass untouched."""
    if pc.all(pc.fill_null(pc.string_is_ascii(text), True)).as_py():
        return text
    return pa.array([None if t is None else unicodedata.normalize("NFKD", t) for t in text.to_pylist()], pa.string())


def present(text: Column) -> Column:
    """Missing text is empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def plain(text: Column) -> Column:
    """Ampersands and at-signs spelt out, accents dropped, quotes and dashes straightened."""
    spelt = F.regexp_replace(F.regexp_replace(F.regexp_replace(present(text), "(?i)&amp;", " and "), "&", " and "), "@", " at ")
    bare = F.regexp_replace(_decomposed(spelt), "[\\u0300-\\u036f]", "")
    return F.translate(bare, "’‘“”–—", "''\"\"--")


def _words(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), NOT_WORD, " "), r"\s+", " "))


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def name(text: Column) -> Column:
    return _words(plain(text))


def without_suffix(clean_name: Column) -> Column:
    """One trailing legal suffix less; a single token stays."""
    return F.when(F.size(tokens(clean_name)) <= 1, clean_name).otherwise(F.trim(F.regexp_replace(F.concat(F.lit(" "), clean_name), suffix_pattern(), "")))


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def address(text: Column) -> Column:
    return F.array_join(F.transform(tokens(_words(plain(text))), lambda t: F.coalesce(_lookup(ADDRESS_TOKENS, t), t)), " ")


def postal_code(raw: Column) -> Column:
    """The first number of six digits, else the first of five (of which a four-digit extension is cut)."""
    raw = present(raw)
    pin = F.regexp_extract(raw, r"\b\d{6}\b", 0)
    return F.when(pin != "", pin).otherwise(F.substring_index(F.regexp_extract(raw, r"\b\d{5}(?:-\d{4})?\b", 0), "-", 1))


def digit_runs(raw: Column) -> Column:
    return F.array_join(F.regexp_extract_all(present(raw), F.lit(r"\b\d+\b"), 0), " ")


def country(text: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(plain(text))), NOT_WORD, ""), r"\s+", " "))
    return F.coalesce(_lookup(COUNTRIES, bare), F.when(bare != "", F.upper(bare)), F.lit("UNKNOWN"))
