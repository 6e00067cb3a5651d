import re

from pyspark.sql import functions as F

from entwine.llm import pii


def luhn(d):
    return sum(v - 9 if v > 9 else v for i, c in enumerate(reversed(d)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def brute(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


TEXTS = [
    None, "", "é😀 a.b@c.de x@y 1.2.3.4.5 256.1.1.1 01.002.3.255", "4111 1111 1111 1111 4111-1111-1111-1112 378282246310005", "+1 (017) 555-7713 +12 34", "a@b.c%d@e.f", "1" * 5000 + " " + "a" * 20000 + "@", "x@y.z@w.q",
    "mail me at joe@example.com or +49 30 123456 78", "1 2 3 4 5 6 7 8 9 0 1 2 3", "4111111111111111@a.bc", "host 10.0.0.1, card 5500 0000 0000 0004",
]


def test_base_spans(make, docs):
    rows = make(TEXTS).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in pii.select(rows).collect():
        got = [(s["kind"], s["start"], s["end"]) for s in r.spans if s["base"]]
        assert got == brute(texts[r.id]), r.id


def test_luhn(spark):
    items = ["4111111111111111", "4111111111111112", "79927398713", "0", "18", "1-8 "]
    got = [r.ok for r in spark.createDataFrame([(x,) for x in items], "x string").select(pii.luhn(F.col("x")).alias("ok")).collect()]
    assert got == [luhn(re.sub("[^0-9]", "", x)) for x in items]


def test_edges(make):
    assert pii.select(make([])).count() == 0
    rows = make([(1, "a@b.cd", "x")] * 2).withColumn("cands", F.lit(1)).withColumn("spans", F.lit(1)).withColumn("raw", F.lit(1))
    assert [len(r.spans) for r in pii.select(rows).collect()] == [1, 1]
    got = pii.redact(make(["to a@b.cd, 10.0.0.1!", None])).orderBy("id").collect()
    assert got[0].text == "to <email>, <ip>!" and got[1].text == ""
    assert not any(w in pii.select(make(["a@b.cd"]))._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow", "Pandas"))


def contested(n):
    """Texts whose numbers are data after words of contact and none after words of stock, and then some that no test decides."""
    out = []
    for i in range(n):
        out.append(f"Please call +1 ({200 + i % 700}) 555-{1000 + i} tomorrow, mail me@site{i}.example.org then.")
        out.append(f"Dial or phone +44 20 7946 {1000 + i} before noon.")
        out.append(f"Spare part no. {200 + i % 700}-555-{1000 + i} 0000 {i % 10}1 item list.")  # 13 digits or more, mostly failing the check digit
        out.append(f"Decorator @cached{i} of model x@y{i} in code.")
    asked = ["call (212) 555-0142 today", "phone 305-555-0199 please", "spare part no. 305-555-0199 item", "order item no. 917 555 0123 part", "dial 030/1234567 or call"]
    return out + asked, asked


def test_trees_accept_and_refuse(make):
    texts, asked = contested(150)
    got = {texts[r.id]: r for r in pii.select(make(texts)).collect()}
    added = {t: [(t[s["start"] : s["end"]], s["kind"]) for s in got[t].spans if not s["base"]] for t in asked}
    assert added[asked[0]] == [("(212) 555-0142", "phone_local")] and added[asked[1]] == [("305-555-0199", "phone_local")]
    assert not added[asked[2]] and not added[asked[3]] and got[asked[2]].n_refused == got[asked[3]].n_refused == 1
    inside = lambda a, b: a is not b and a["start"] < b["end"] and b["start"] < a["end"]
    for r in got.values():  # nothing is added over what is reported already
        assert not any(inside(a, b) for a in r.spans for b in r.spans if not a["base"])


def test_thresholds_against_a_plain_count(make):
    texts, _ = contested(150)
    found = pii.candidates(make(texts).select(F.col("doc_id").alias("id"), "text"))
    margin, limits = pii.fit(found)
    known = found.select("id", F.explode("cands").alias("c")).select("c.kind", F.xxhash64("id", "c.start", "c.kind").alias("h"), pii._label(F.col("c")).alias("y"), margin(F.col("c.f")).alias("p")).filter("y is not null").collect()
    held = [r for r in known if r.h % 4 == 0]
    for kind in pii.ALL:
        own = [r for r in held if r.kind == kind]
        of = own if len(own) >= pii.LEAST_LABELLED else held
        cuts = [k / 20 for k in range(10, 20) if (s := [r.y for r in of if r.p >= k / 20]) and sum(s) / len(s) >= pii.PRECISION]
        assert limits[kind] == (cuts[0] if cuts else 1.01), kind
    assert {r.y for r in held if r.kind == "card"} == {0.0, 1.0} and {r.y for r in known if r.kind == "phone_local"} >= {1.0}


def test_the_fit_takes_every_candidate(spark):
    """Of 25,000 labelled candidates only the 100 that a hash of their place puts last are none."""
    rows = spark.range(25_000).withColumn("h", F.xxhash64("id", F.lit(10), F.lit("email")))
    last = rows.orderBy(F.desc("h")).limit(100).agg(F.min("h")).first()[0]
    bad = F.col("h") >= last
    f = F.array(*[F.when(bad, 1.0).otherwise(0.0)] * len(pii.FEATURES))
    found = rows.select("id", F.array(F.struct(F.lit("email").alias("kind"), F.lit(10).alias("start"), F.lit(20).alias("end"), (~bad).alias("base"), F.lit(False).alias("over_pass"), F.lit(False).alias("over_fail"), f.alias("f"))).alias("cands"))
    margin, limits = pii.fit(found)
    assert limits["email"] == 0.5
    got = spark.range(2).select(margin(F.array(*[F.col("id").cast("double")] * len(pii.FEATURES))).alias("p")).collect()
    assert got[0].p > 0.5 > got[1].p
