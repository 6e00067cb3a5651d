"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

High-recall generators propose overlapping spans: four base kinds, whose own tests decide, and loose kinds, which
have no test. Every candidate is described by its format (groups, letters, separators) and its context (the words
and marks around it); boosted trees, fitted on all labelled candidates, score it, and a threshold per kind,
calibrated on all held-out ones (a quarter), selects which loose candidates are added. The trees become one SQL expression
over features that were written once, so nothing is searched twice: no shuffle of texts, no Python.

The trees learn from the base tests. A base candidate is data if it passes its test, a name with an at-sign but no
domain is none; a loose candidate is data if it
overlaps a base span that passes, and none if it overlaps only base candidates that fail. What the tests look at
(check digits, numbers of digits, lengths) is no feature, so the trees judge by form and context. Loose candidates
that overlap no base candidate teach nothing; they, and those over failing ones, are what the trees decide on. A
loose candidate that overlaps a base span is never added: what it shows is reported already.

Positions are code points. A null text counts as empty. Matches are leftmost and do not overlap within a
generator; a failing one is dropped and the search goes on behind it. Repeated rows each get their own
spans. An empty table gives an empty result; without labels of both sorts nothing is added. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Patterns are Java's. Possessive forms find what the plain ones find, in time and stack that do not grow
# with a run's length; a look-behind keeps a failed run from being tried again at each of its characters.
_LOCAL = "[A-Za-z0-9._%+-]"
GENERATORS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kinds that only the trees can select, found with loose patterns.
LOOSE = {
    "email_spelt": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[a-z0-9-]{1,63}+(?:\x20?[\[(]dot[\])]\x20?[a-z0-9-]{1,63}+)++",
    "phone_local": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "phone_trunk": r"(?<![0-9+(/.-])\(?0[0-9]{2,4}\)?[\x20/-][0-9][0-9\x20-]{3,9}[0-9](?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: What looks like a base kind and is none, whatever surrounds it: learnt from, never added.
NEAR = {"handle": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?!\.?[A-Za-z0-9-])"}
#: A substring test that every text with a match of the kind passes; others skip the search.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "email_spelt": None, "phone_local": None, "phone_trunk": "0", "ssn": "-", "handle": "@"}
ALL = GENERATORS | LOOSE | NEAR
FEATURES = ("groups", "longest", "letters", "others", "distinct", "brackets", "contact_word", "money_word", "net_word", "id_word", "code_around", "word_before", "digit_near", "family_email", "family_ip", "family_card", "family_phone", "loose")
#: The base kind whose features and labels each loose kind shares.
FAMILY = {"email_spelt": "email", "phone_local": "phone", "phone_trunk": "phone", "ssn": "card", "handle": "email"}
#: Share of the selected held-out candidates that must be data, by which each kind's threshold is set; a kind with
#: fewer labelled held-out candidates than these takes the threshold of all kinds together.
PRECISION, LEAST_LABELLED = 0.95, 20
CONTEXT = 24


def _inner(text: Column, a: Column, n: Column) -> Column:
    return F.substring(text, a, n)


def spans(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, value>>: all matches of the kind's generator. What lies between the
    matches (split) and the matches themselves (extract) alternate, so their lengths give the positions."""
    pattern = F.lit(ALL[kind])
    found = F.regexp_extract_all(text, pattern, 0)
    between = F.transform(F.split(text, ALL[kind], -1), F.length)
    if kind == "card":  # only runs of 13 digits or more can pass; keep the lengths of all
        found = F.transform(found, lambda v: v)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        item = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(_possible(kind, pair["value"]), F.concat(acc["out"], F.array(item))).otherwise(acc["out"]).alias("out"))

    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    walked = F.when(F.size(found) > 0, F.aggregate(pairs, zero, step, lambda acc: acc["out"])).otherwise(none)
    return F.when(text.contains(NEEDS[kind]), walked).otherwise(none) if NEEDS[kind] else walked


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _possible(kind: str, value: Column) -> Column:
    """Candidates that are kept at all: cards by their number of digits, the rest as found."""
    return F.length(value).between(13, 37) & F.length(_digits(value)).between(13, 19) if kind == "card" else F.lit(True)


def luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn test."""
    d = F.reverse(_digits(value))
    # a doubled digit's own digits sum to: 0 2 4 6 8 1 3 5 7 9
    twice = F.translate(F.regexp_replace(d, "[0-9]([0-9]?)", "$1"), "0123456789", "0246813579")
    once = F.regexp_replace(d, "([0-9])[0-9]?", "$1")

    def total(s: Column) -> Column:
        return sum((F.length(F.regexp_replace(s, f"[^{k}]", "")) * k for k in range(1, 10)), F.lit(0))

    return (total(twice) + total(once)) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The base kinds' own test of a whole match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(False)


def _features(text: Column, c: Column) -> Column:
    """Format and context of a candidate, in the order of FEATURES."""
    value = c["value"]
    before = F.lower(F.substring(text, F.greatest(c["start"] - CONTEXT, F.lit(0)) + 1, F.least(c["start"], F.lit(CONTEXT))))
    after = F.lower(F.substring(text, c["end"] + 1, F.lit(CONTEXT)))
    around = F.concat(before, F.lit(" "), after)
    letters, digits = F.regexp_replace(value, "[^A-Za-z]", ""), _digits(value)
    family = F.create_map(*[F.lit(x) for pair in FAMILY.items() for x in pair])
    named = {
        "groups": F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), 0)),
        "longest": F.array_max(F.transform(F.split(value, "[^0-9]+"), F.length)),
        "letters": F.length(letters),
        "others": F.length(value) - F.length(digits) - F.length(letters),
        "distinct": F.size(F.array_distinct(F.split(digits, ""))),
        "brackets": value.rlike(r"[()\[\]]"),
        "contact_word": around.rlike(r"mail|tel|phone|fax|call|contact|mobile|dial|reach|ring|@"),
        "money_word": around.rlike(r"card|visa|pay|credit|konto|bank|eur|usd|\$"),
        "net_word": around.rlike(r"\bip|host|server|addr|net|http|port|version|v\."),
        "id_word": around.rlike(r"order|part|serial|\bno\b|\bnr\b|ref|invoice|\bid\b|model|item|isbn|sku|number of"),
        "code_around": around.rlike(r"[=<>{}\[\];/\\#]"),
        "word_before": before.rlike(r"\p{L}[^\p{L}0-9]{0,3}$"),
        "digit_near": before.rlike(r"[0-9][^\p{L}]?$") | after.rlike(r"^[^\p{L}]?[0-9]"),
        **{f"family_{k}": F.coalesce(F.try_element_at(family, c["kind"]), c["kind"]) == k for k in GENERATORS},
        "loose": c["kind"].isin(*LOOSE),
    }
    return F.array(*[named[k].cast("double") for k in FEATURES])


def _tree(node, f: Column) -> Column:
    """One tree as a CASE expression over the array of features."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(f[split.featureIndex()] <= F.lit(float(split.threshold())), _tree(node.leftChild(), f)).otherwise(_tree(node.rightChild(), f))


_CAND = "struct<kind:string,start:int,end:int,base:boolean,over_pass:boolean,over_fail:boolean,f:array<double>>"


def candidates(rows: DataFrame, *keep: str) -> DataFrame:
    """rows (id, text) -> (id, cands, keep ..): every candidate of every generator in one array, with what it overlaps
    and its features."""
    found = rows.withColumn("raw", F.concat(*[spans(F.col("text"), k) for k in ALL]))

    def tested(c: Column) -> Column:
        base = F.lit(False)
        for kind in GENERATORS:
            base = base | ((c["kind"] == kind) & passes(kind, c["value"]))
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"), base.alias("base"))

    found = found.withColumn("raw", F.transform("raw", tested))
    at = lambda keep: F.transform(F.filter("raw", keep), lambda c: F.struct(c["start"].alias("a"), c["end"].alias("b")))
    found = found.withColumns({"good": at(lambda c: c["base"]), "bad": at(lambda c: c["kind"].isin(*GENERATORS) & ~c["base"])})

    def placed(c: Column) -> Column:
        over = lambda where: F.exists(where, lambda s: (s["a"] < c["end"]) & (s["b"] > c["start"]))
        loose = c["kind"].isin(*LOOSE)
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"), (loose & over("good")).alias("over_pass"), (loose & over("bad")).alias("over_fail"), _features(F.col("text"), c).alias("f"))

    some = F.when(F.size("raw") > 0, F.transform("raw", placed)).otherwise(F.array().cast(f"array<{_CAND}>"))
    return found.select("id", some.alias("cands"), *keep)


def _label(c: Column) -> Column:
    """1 data, 0 none, null unknown."""
    loose = c["kind"].isin(*LOOSE)
    return F.when(c["kind"].isin(*NEAR), 0.0).when(~loose, c["base"].cast("double")).when(c["over_pass"], 1.0).when(c["over_fail"], 0.0)


def fit(found: DataFrame) -> tuple[Callable[[Column], Column], dict[str, float]]:
    """A function from the array of features to the score, and the threshold of each kind. found: as candidates gives
    it, of the whole table. Candidates of one kind, label, fold and features count as one row with their number as its
    weight, so the fit costs as much as there are different ones."""
    one = found.filter(F.size("cands") > 0).select("id", F.explode("cands").alias("c"))
    known = one.select((F.pmod(F.xxhash64("id", "c.start", "c.kind"), F.lit(4)) == 0).alias("held"), F.col("c.kind").alias("kind"), F.col("c.f").alias("f"), _label(F.col("c")).alias("label")).filter("label is not null")
    alike = materialize(known.groupBy("held", "kind", "label", "f").agg(F.count("*").cast("double").alias("weight")))
    n, positive = alike.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("label"))).first()
    if not n or not 0 < positive < n:
        return lambda f: F.lit(0.0), {}
    # in one task and in order: sums of another order could turn a tie between two splits
    ready = alike.withColumn("features", array_to_vector("f")).coalesce(1).sortWithinPartitions("f", "kind", "label")
    model = GBTClassifier(maxIter=8, maxDepth=4, stepSize=0.3, seed=7, featuresCol="features", labelCol="label", weightCol="weight").fit(ready.filter("not held"))
    trees, weights = list(model.trees), [float(w) for w in model.treeWeights]

    def margin(f: Column) -> Column:
        total = F.lit(0.0)
        for t, w in zip(trees, weights, strict=True):
            total = total + F.lit(w) * _tree(t._call_java("rootNode"), f)
        return 1 / (1 + F.exp(-2 * total))

    held = alike.filter("held").select("kind", "label", "weight", margin(F.col("f")).alias("score"))
    steps = [k / 20 for k in range(1, 20)]
    total = lambda value, t: F.sum(F.when(F.col("score") >= t, value).otherwise(0.0))
    sums = [F.sum("weight").alias("n"), *[total(F.col("weight"), t).alias(f"n{i}") for i, t in enumerate(steps)], *[total(F.col("weight") * F.col("label"), t).alias(f"p{i}") for i, t in enumerate(steps)]]
    cut = lambda row: next((t for i, t in enumerate(steps) if t >= 0.5 and row[f"n{i}"] and row[f"p{i}"] / row[f"n{i}"] >= PRECISION), 1.01)
    every = held.agg(*sums).first()
    limits = dict.fromkeys(ALL, cut(every) if every["n"] else 1.01)
    for row in held.groupBy("kind").agg(*sums).collect():  # one row for each kind
        if row["n"] >= LEAST_LABELLED:
            limits[row["kind"]] = cut(row)
    return margin, limits


def select(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, with_text: bool = False) -> DataFrame:
    """(id, spans, n_refused): the selected spans array<struct<kind, start, end, base, score>> of each text, by kind, then
    start, and how many loose candidates the trees refused; with the text if asked for."""
    keep = ["text"] if with_text else []
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = materialize(candidates(rows, *keep))
    margin, limits = fit(found)
    limit = F.create_map(*[F.lit(x) for k in ALL for x in (k, float(limits.get(k, 1.01)))])

    def judged(c: Column) -> Column:
        score = margin(c["f"])
        added = c["kind"].isin(*LOOSE) & ~c["over_pass"] & (score >= F.try_element_at(limit, c["kind"]))
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"), score.alias("score"), (c["base"] | added).alias("kept"), (c["kind"].isin(*LOOSE) & ~c["over_pass"] & ~added).alias("refused"))

    scored = found.withColumn("cands", F.transform("cands", judged))
    kept = F.transform(F.filter("cands", lambda s: s["kept"]), lambda s: F.struct(*[s[k].alias(k) for k in ("kind", "start", "end", "base", "score")]))
    return scored.select("id", *keep, kept.alias("spans"), F.size(F.filter("cands", lambda s: s["refused"])).alias("n_refused"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, spans): texts in which every selected span is replaced by its kind in angle brackets; of
    overlapping spans the one that starts first (the longer, then the earlier kind) stands."""
    found = select(docs, id_col, text_col, with_text=True)
    ordered = F.array_sort("spans", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["end"] != b["end"], b["end"] - a["end"]).otherwise(0))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        cut = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], cut, F.lit("<"), s["kind"], F.lit(">")).alias("out"))).otherwise(acc)

    text = F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return found.select("id", text.alias("text"), "spans")
