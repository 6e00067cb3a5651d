import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from entwine.llm import bwt, entry, repeats


def places(strings, weights, length):
    seen = collections.Counter()
    for s, w in zip(strings, weights, strict=True):
        for i in range(len(s) - length + 1):
            seen[s[i : i + length]] += w
    return [[i for i in range(len(s) - length + 1) if seen[s[i : i + length]] >= 2] for s in strings]


@pytest.mark.parametrize("shard", [700, 2000, 1 << 16])
def test_merged_transforms(monkeypatch, shard):
    monkeypatch.setattr(bwt, "SHARD_BYTES", shard)
    rng = random.Random(shard)
    base = [bytes(rng.choice(b"ab") for _ in range(300)) for _ in range(3)]
    strings = []
    for _ in range(40):
        k = rng.randrange(100)
        s = rng.choice(base)[k : k + rng.randrange(40, 190)]
        strings.append(s if rng.random() < 0.5 else s[:30] + b"z" + s[31:])
    strings.append(b"a" * 90)
    weights = np.array([1 + (i % 9 == 0) for i in range(len(strings))])
    assert [x.tolist() for x in bwt.repeated(strings, weights, 40)] == places(strings, weights, 40)


def test_common_prefixes(monkeypatch):
    monkeypatch.setattr(bwt, "STEP", 1)
    rng = random.Random(11)
    for _ in range(30):
        strings = [[rng.randrange(1, 3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(2, 7))]
        symbols = np.array([x for s in strings for x in [*s, 0]])
        edges = np.cumsum([0, *[len(s) + 1 for s in strings]])
        begins = np.repeat(edges[:-1], np.diff(edges))
        shards = [bwt.Shard(symbols, begins, a, b, 9) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        order, prefix = bwt.merge(shards, 4)
        end = np.repeat(edges[1:], np.diff(edges))
        tails = [tuple(symbols[i : end[i]].tolist()) for i in order]
        assert [t[:4] for t in tails] == sorted(t[:4] for t in tails) and sorted(order.tolist()) == list(range(len(symbols)))
        for (a, b), p in zip(zip(tails, tails[1:], strict=False), prefix[1:].tolist(), strict=True):
            shared = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert min(shared, 4) == min(p, shared, 4) and (p == min(shared, 4) or 0 in b[: shared + 1])


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + 200] for b in raw for k in range(len(b) - 199))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("large", [repeats.BLOCK_BYTES, 0, 2000])
def test_whole_query(make, spark, tmp_path, monkeypatch, large):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", large)  # what is larger falls apart
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abc dé") for _ in range(n))
    shared = text(400)
    texts = [text(300) + shared + text(50), shared[:250] + text(100), text(500), None, "", shared[:199], "x" * 450, text(90) * 4, shared, shared, "y" * 200, "y" * 199, text(100) + shared[100:300] + text(150)]
    for _ in range(25):  # variants of one passage
        k = rng.randrange(400)
        texts.append(text(rng.randrange(30)) + shared[:k] + "#" + shared[k + 1 :] + text(rng.randrange(30)))
    make(texts).withColumn("th", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in entry.op3_repeats(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_edges(make):
    assert repeats.removed(make([])).count() == 0
    same = "z" * 100 + "q" * 150
    got = repeats.removed(make([(1, same, "a"), (1, same, "b"), (None, same[:230], "a")])).collect()
    assert sorted((r.n_bytes, sum(s["b"] - s["a"] for s in r.spans)) for r in got) == [(230, 230), (250, 250), (250, 250)]
