import random

from plain import base_secrets
from pyspark.sql import functions as F

from entwine.llm import entry, secrets


TEXTS = [None, "", "é token = 'abcdefgh1' x", "TOKEN:short password=longenough1", "AKIA" + "B" * 12, "AKIA" + "B" * 11, "f" * 31, "ſecret=abcdefghij secret=abcdefghij", "0" * 40 + " " + "a" * 32, "x" * 50000 + " api_key: qwertyuiop"]


def test_base_spans(make):
    got = {r.id: [(s["kind"], s["start"], s["end"]) for s in r.spans if s["kind"] in secrets.BASE] for r in secrets.scan(make(TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        assert sorted(got[i]) == sorted(base_secrets(t or "")), i


def test_ownership(make):
    key, own = "eyJ" + "a" * 12 + "." + "b1" * 8 + "." + "c" * 12, "ghp_" + "Ab1" * 10
    got = {r.id: {s["kind"]: s["verdict"] for s in r.spans} for r in secrets.scan(make([(0, key, "a"), (1, key, "b"), (2, own, "a"), (3, own, "a"), (4, "token=abcdefgh12", "a"), (5, "token=abcdefgh12", None)])).collect()}
    assert got[0] == {} and got[1] == {}  # an example that two owners have
    assert got[2] == {"prefixed": "owner_specific"} and got[3] == got[2]
    assert got[4] == {"assign": "copied_example"}  # base findings stay


def pem(body, kind="RSA "):
    return f"-----BEGIN {kind}PRIVATE KEY-----\n{body}\n-----END {kind}PRIVATE KEY-----"


def test_private_keys_are_told_by_their_bodies(make):
    keys = ["\n".join(f"{c}{k}" + "Qw+/" * 4 for k in range(5)) for c in "XYZ"]
    cut = "-----BEGIN EC PRIVATE KEY----- " + "Ab9+" * 6 + " and no end"
    rows = make([(i, f"see {pem(k)} there", f"o{i}") for i, k in enumerate(keys)] + [(3, pem(keys[0], ""), "o0"), (4, cut, "o1"), (5, "a -----BEGIN PRIVATE KEY----- line", "o2")] + [(6 + i, pem("MIIexample" * 3), f"o{i}") for i in range(2)])
    got = {r.id: [(s["start"], s["end"], s["verdict"]) for s in r.spans if s["kind"] == "block"] for r in secrets.scan(rows).collect()}
    assert all(got[i] == [(4, 4 + len(pem(k)), "owner_specific")] for i, k in enumerate(keys)) and got[3] == [(0, len(pem(keys[0], "")), "owner_specific")]
    assert got[4] == [(0, len(cut) - len(" and no end"), "owner_specific")] and got[5] == got[6] == got[7] == []
    clean = {r.doc_id: r.text for r in secrets.scrubbed(rows.withColumn("further", F.lit(1)).withColumn("_further", F.lit(2))).collect()}
    assert clean[0] == "see <block> there" and clean[4] == "<block> and no end" and clean[6] == pem("MIIexample" * 3)


def test_verdicts_against_a_plain_count(make):
    values = [f"ghp_{'Ab1' * 6}{k}" for k in range(5)]
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice(values) for _ in range(2)), f"o{rng.randrange(2 + i % 7)}") for i in range(40)] + [(50, None, None), (51, values[0], None)]
    owners = {}
    for i, t, o in items:
        for v in (t or "").split():
            owners.setdefault(v, set()).add(o or "")
    for r in secrets.scan(make(items)).collect():
        text = next(t for i, t, _ in items if i == r.id) or ""
        assert sorted(text[s["start"] : s["end"]] for s in r.spans) == sorted(v for v in text.split() if len(owners[v]) == 1)
        assert all((s["n_owners"], s["n_repositories"]) == (1, len({i for i, t, _ in items if text[s["start"] : s["end"]] in (t or "")})) for s in r.spans)


def test_edges(make, spark, tmp_path):
    assert secrets.scan(make([])).count() == 0
    rows = make([(1, "token=abcdefgh12", "a"), (1, "token=abcdefgh12", "a")]).withColumn("spans", F.lit(1)).withColumn("value", F.lit("v")).withColumn("row", F.lit(0))
    assert [len(r.spans) for r in secrets.scan(rows).collect()] == [1, 1]
    make(TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in entry.op2_secrets(spark, str(tmp_path)).collect()}
    assert (got[8].n_hex, got[8].spans) == (2, "hex:0:40,hex:41:73")


def test_scrubbed(make):
    rows = make(["a token=abcdefgh12 b", None, "clean", "k ghp_" + "Ab1" * 10])
    got = {r.doc_id: r for r in secrets.scrubbed(rows).collect()}
    assert got[0].text == "a <assign> b" and got[0].n_chars == len("a <assign> b") and got[1].text is None and got[2].text == "clean" and got[3].text == "k <prefixed>"
    assert secrets.redacted("abcdef", [(1, 3, "x"), (2, 5, "y")]) == "a<x>f"


def test_a_value_in_many_documents_of_one_owner_is_live(make):
    key = "ghp_" + "Ab1" * 10
    rows = make([(i, f"{i} {key}", "a") for i in range(6)])
    assert all([s["verdict"] for s in r.spans] == ["owner_specific"] for r in secrets.scan(rows).collect())
    assert all(r.text == f"{r.doc_id} <prefixed>" for r in secrets.scrubbed(rows).collect())
