import duckdb
import pytest

from entwine.plans import registry

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["normalize_entities", "candidates_topk", "sim_char3gram", "sim_edit_ratio", "recall_by_source_fold", "threshold_grid", "split_assign", "submission_issues", "suffix_frequency", "missed_sample", "block_rare_token", "pair_features", "gbt_scores", "inference_matches"])
def test_query_gives_what_its_sql_gives(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{D}/documents.parquet'")
    want = con.sql(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, D).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)

    def text(v):
        return "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)

    rows = lambda df: sorted(tuple(map(text, r)) for r in df[cols].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)


def test_queries_block_with_the_parameters_of_the_reference(spark, tmp_path):
    same = [(i, "one two three four five six seven eight nine ten", "en", "s", 48) for i in range(66)]
    spark.createDataFrame(same, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.queries()["candidates_topk"](spark, str(tmp_path))
    assert got.count() == 22 * 44  # a block of 44 targets, all of them candidates of each entity
    assert {r["size"] for r in registry.queries()["block_sizes"](spark, str(tmp_path)).collect()} == {22, 44}  # half of them of each legal form
    sql = registry.oracle_sql()["candidates_topk"]
    assert "<= 1500" in sql and "<= 100)" in sql


def test_blocks_of_very_common_keys_are_left_out(spark, tmp_path, monkeypatch):
    same = [(i, f"one two three four five {i}", "en", "s", 20) for i in range(30)] + [(100 + i, f"moss fern {i // 3} x", "es", "s", 9) for i in range(6)]
    spark.createDataFrame(same, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(registry.blocking.pruned, "__defaults__", (8, ("rule", "key")))
    got = registry.queries()["sim_token_jaccard"](spark, str(tmp_path)).collect()
    assert got and all(int(r.target_entity_id.split("_")[1]) >= 100 for r in got)


def test_final_lists_search_for_candidates_once(spark, monkeypatch):
    calls, found = [], registry.blocking.candidates
    monkeypatch.setattr(registry.blocking, "candidates", lambda *a: calls.append(a) or found(*a))
    assert registry.queries()["inference_matches"](spark, D).first()["candidates_only"] and len(calls) == 1
