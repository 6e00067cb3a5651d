"""Secret scan with corpus-wide ownership frequency.

Every text is searched for base secrets (assignments, access keys, long hex) and for further credential
formats that are candidates only. Each candidate value is hashed; over the whole corpus the distinct
repositories and owners of each hash are counted. A value of many owners is a widely copied example
(documentation, test keys); one that stays with an owner looks live, in however many repositories. Base findings are always reported;
a further candidate is reported when it looks live.

Positions are code points. A null text counts as empty; a null owner or repository is one value of its own.
Matches are leftmost and do not overlap within a kind; one that fails its length test is dropped, and the
search goes on behind it. Repeated rows are scanned each for itself. An empty table gives an empty result.
Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let_go, materialize, unused

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE = {
    "assign": (ASSIGN, lambda m: len(m[1]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), lambda m: True),  # the maximal runs of 32 or more are those of + that pass
}
#: A private key from its BEGIN to its END line; one that is cut off as far as its lines of code go.
_KEY_LINE = "-----%s [A-Z ]{0,30}PRIVATE KEY-----"
BLOCK = _KEY_LINE % "BEGIN" + r"((?:[A-Za-z0-9+/=,:.\s\\]|-[A-Za-z0-9])*" + _KEY_LINE % "END" + r"|(?:\s*[A-Za-z0-9+/=]{16,})+)"
EXTRA = {
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"), lambda m: True),
    "prefixed": (re.compile(r"\b(?:gh[opsu]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}", re.A), lambda m: True),
    "block": (re.compile(BLOCK, re.A), lambda m: True),
    "base64": (re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}"), lambda m: _random_looking(m[0])),
}
#: Cheap vectorised tests (RE2) that hold for every text with a finding of the kind; the others skip its search.
HINTS = {
    "assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
    "jwt": r"eyJ[A-Za-z0-9_-]{10}",
    "prefixed": r"(?:gh[opsu]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16}",
    "block": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
    "base64": r"[A-Za-z0-9+/_-]{40}",
}
KINDS = [*BASE, *EXTRA]
#: A value that more owners than these share is a widely copied example. How many of an owner's repositories
#: hold it tells nothing: copies within one owner are still that owner's.
MOST_OWNERS = 1


def _random_looking(s: str) -> bool:
    """Letters of both cases and digits, and at least 20 different characters."""
    return len(set(s)) >= 20 and any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)


def find(text: str, kinds: list[str] = KINDS) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the matches of the kinds, kind by kind. The value of an assignment is what is
    assigned, that of a private key what lies between its lines, without white space."""
    out = []
    for kind in kinds:
        pattern, passes = (BASE | EXTRA)[kind]
        for m in pattern.finditer(text):
            if passes(m):
                out.append((kind, m.start(), m.end(), m[1] if kind == "assign" else "".join(m[1].split()) if kind == "block" else m[0]))
    return out


def _digest(value: str) -> bytes:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary())])


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str | None = None, owner_col: str = "source") -> DataFrame:
    """(row, id, repository, owner, spans): all candidate spans of each text; values only as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            text = pc.fill_null(batch.column(3), "")
            spans: list[list[dict]] = [[] for _ in range(len(text))]
            for kind in KINDS:
                for i in pc.indices_nonzero(pc.match_substring_regex(text, HINTS[kind])).to_pylist():
                    spans[i] += [{"kind": k, "start": a, "end": b, "value": _digest(v)} for k, a, b, v in find(text[i].as_py(), [kind])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, pa.list_(_SPAN))], ["id", "repository", "owner", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(repository_col or id_col).cast("string").alias("repository"), F.col(owner_col).cast("string").alias("owner"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(run, f"id {kind}, repository string, owner string, spans array<struct<kind:string,start:bigint,end:bigint,value:binary>>")
    return found.select(F.expr("uuid()").alias("row"), "*")


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_repositories, n_owners): how many distinct repositories and owners hold each candidate value.
    Pairs are made distinct before the counts, so a value of a third of all rows is summed where it is read."""
    pairs = found.select(F.explode("spans").alias("s"), "repository", "owner").select("s.value", F.coalesce("repository", F.lit("")).alias("repository"), F.coalesce("owner", F.lit("")).alias("owner"))
    owners = pairs.groupBy("value", "owner").agg(F.lit(1).alias("one")).groupBy("value").agg(F.count("*").alias("n_owners"))
    repositories = pairs.groupBy("value", "repository").agg(F.lit(1).alias("one")).groupBy("value").agg(F.count("*").alias("n_repositories"))
    return owners.join(repositories, "value")


def findings(found: DataFrame) -> DataFrame:
    """(row, id, kind, start, end, n_repositories, n_owners, verdict) of every candidate span."""
    one = found.select("row", "id", F.explode("spans").alias("s")).select("row", "id", "s.kind", "s.start", "s.end", "s.value")
    copied = F.col("n_owners") > MOST_OWNERS
    # Written out, so that both sides of the join are dealt anew and a value of very many rows can be split.
    return one.join(materialize(ownership(found)), "value").select("row", "id", "kind", "start", "end", "n_repositories", "n_owners", F.when(copied, "copied_example").otherwise("owner_specific").alias("verdict"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str | None = None, owner_col: str = "source") -> DataFrame:
    """(id, spans, reported): per row all base spans with their verdicts and the further ones that look live, by start, then kind."""
    found = materialize(candidates(docs, id_col, text_col, repository_col, owner_col))
    kept = findings(found).filter(F.col("kind").isin(*BASE) | (F.col("verdict") == "owner_specific"))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind", "n_repositories", "n_owners", "verdict"))).alias("spans"))
    plain = found.filter(F.size("spans") == 0).select("id", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    some = found.filter(F.size("spans") > 0).select("row", "id").join(spans, "row", "left").select("id", "spans")
    return plain.unionByName(some).withColumn("spans", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)))


def redacted(text: str | None, further: list[tuple[int, int, str]]) -> str | None:
    """The text with base spans and the given (start, end, kind) replaced by their kind; the first, longest span stands."""
    if text is None:
        return None
    spans = [(a, b, k) for k, a, b, _ in find(text, list(BASE))] + list(further)
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
        elif b > at:  # reaches beyond what was cut before it
            at = b
    return "".join(out) + text[at:]


def scrubbed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", repository_col: str | None = None, owner_col: str = "source") -> DataFrame:
    """docs with every reported secret replaced in the text, and its length set anew. A row without an id has
    its base secrets replaced; those of further kinds are looked up by id."""
    spare = unused(docs, "further")
    found = scan(docs, id_col, text_col, repository_col, owner_col)
    further = F.filter("spans", lambda s: ~s["kind"].isin(*BASE))
    one = found.select(F.col("id").alias(id_col), F.transform(further, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias(spare))
    extra = one.filter(F.size(spare) > 0).groupBy(id_col).agg(F.flatten(F.collect_set(spare)).alias(spare))

    @F.arrow_udf("string")
    def replace(text: pa.Array, spans: pa.Array) -> pa.Array:
        hit = np.zeros(len(text), bool)
        for kind in BASE:
            hit |= pc.fill_null(pc.match_substring_regex(text, HINTS[kind]), False).to_numpy(zero_copy_only=False)
        hit |= spans.is_valid().to_numpy(zero_copy_only=False)
        at = np.flatnonzero(hit)
        new = [redacted(text[i].as_py(), [(s["start"], s["end"], s["kind"]) for s in spans[i].as_py() or []]) for i in at.tolist()]
        return pc.replace_with_mask(text, pa.array(hit), pa.array(new, text.type)) if len(at) else text

    joined = docs.join(materialize(extra), id_col, "left").withColumn(text_col, replace(F.col(text_col).cast("string"), F.col(spare)))
    if length_col:
        joined = joined.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return joined.select(docs.columns)
