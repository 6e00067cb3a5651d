import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entwine.llm import pieces as P

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = [None, "", " ", "  a", " a  b ", "▁", "a▁b ▁", "日本語 テキスト 😀😀", "x" * 5000 + " y", "\n\n \t", "é" * 40, "a\x00b", "The quick brown fox, 12345.678!", "aaaaaaaaaaaaaaaa bbbb"]


@pytest.fixture(scope="module")
def model():
    return P.Pieces(P.DEFAULT_MODEL)


def test_round_trip(model, docs):
    texts = TEXTS + [r.text for r in docs.limit(60).collect()]
    ids = model.encode(pa.array(texts, pa.string()))
    assert model.decode(ids).to_pylist() == [t or "" for t in texts]


def test_ids_are_those_of_merging_by_rank(model, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=P.DEFAULT_MODEL)
    texts = [t for t in TEXTS if t and P.MARK not in t] + [r.text for r in docs.limit(60).collect()]
    assert model.encode(pa.array(texts)).to_pylist() == library.encode(texts)


def test_best_path_of_summed_scores():
    model = P.Pieces(P.DEFAULT_MODEL)
    model.bpe = False  # scores count as those of a unigram model do
    library = sentencepiece.SentencePieceProcessor(model_file=P.DEFAULT_MODEL)
    table = {library.id_to_piece(i): library.get_score(i) for i in range(library.get_piece_size()) if not library.is_byte(i) and not library.is_control(i) and not library.is_unknown(i)}
    for text in ("hello world", "ownership of it", "日本x"):
        spelt = (" " + text).replace(" ", P.MARK)
        best = [0.0] + [-1e99] * len(spelt)
        for e in range(1, len(spelt) + 1):
            for a in range(max(0, e - 17), e):
                score = table.get(spelt[a:e], model.unknown if e - a == 1 else None)
                if score is not None:
                    best[e] = max(best[e], best[a] + score)
        ids = model.encode(pa.array([text])).to_pylist()[0]
        bytes_ = sum(library.is_byte(i) for i in ids)
        got = sum(library.get_score(i) for i in ids if not library.is_byte(i))
        assert bytes_ or abs(got - best[-1]) < 1e-6


def test_columns(make):
    rows = make(["a b", None, "a b"]).withColumn("run", F.lit(1)).withColumn("exact", F.lit(2))
    got = rows.withColumn("ids", P.encode(F.col("text"))).withColumn("again", P.decode(F.col("ids"))).orderBy("doc_id").collect()
    assert [r.again for r in got] == ["a b", "", "a b"] and got[0].ids == got[2].ids and got[1].ids == []
    assert make([]).withColumn("ids", P.encode(F.col("text"))).count() == 0
    whole = P.encoded(rows.withColumn("ids", F.lit("old"))).orderBy("doc_id").collect()
    assert [r.ids for r in whole] == [r.ids for r in got] and whole[0].run == 1 and whole[0].exact == 2
    back = P.round_trips(rows).orderBy("id").collect()
    assert [(r.ids, r.exact) for r in back] == [(r.ids, True) for r in got] and P.encoded(make([])).count() == P.round_trips(make([])).count() == 0


def test_slices_change_nothing(model, docs, monkeypatch):
    texts = [t for t in TEXTS if t] + [r.text for r in docs.limit(30).collect()]
    want = model.encode(pa.array(texts)).to_pylist()
    monkeypatch.setattr(P, "SLICE_BYTES", 64)  # every text is very long
    assert P.Pieces(P.DEFAULT_MODEL).encode(pa.array(texts)).to_pylist() == want
