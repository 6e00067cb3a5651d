import json
import zipfile
from pathlib import Path

import pytest

from entwine.plans import stages
from entwine.streaming.candidates import candidate_hits, kept_postings

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


@pytest.fixture
def config(tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    names = ["Otter Boats", "Blue Kite School", "Fern and Moss", "Quill Works", "Harbour Bakery", "Newt Press"]
    for part in ("train", "test"):
        for k in (1, 2, 3):
            rows = "".join(f"S{k}_{i}\t{n}{' LLC' if k == 2 else ''}\t{i + 1} Pier Rd 1000{i}\t{'Ireland' if i % 2 else 'Peru'}\n" for i, n in enumerate(names))
            (data / f"{part}_source{k}.tsv").write_text(HEAD + rows, encoding="utf-8")
    (data / "train_ground_truth.tsv").write_text("entity_id\tmatch_id\n" + "".join(f"S1_{i}\tS2_{i},S3_{i}\n" for i in range(5)) + "S1_5\t\n", encoding="utf-8")
    return stages.Config(data_root=str(data), storage_root=str(tmp_path / "out"), val_ratio=0.5, kinds=("logistic",), grid=(0.2, 0.9, 0.1))


def report(config, name):
    return json.loads(Path(config.out(f"{name}.json")).read_text())


def test_all_stages(spark, config):
    with pytest.raises(FileNotFoundError):
        stages.run_stage(spark, "blocking", config)
    for name in stages.STAGES:
        assert stages.run_stage(spark, name, config), name
    assert not stages.run_stage(spark, "clean", config) and stages.run_stage(spark, "clean", config, force=True)
    audited = report(config, "audit_report")
    assert audited["ground_truth"]["one_to_many"] == 5 and len(audited["tables"]) == 6 and all(t["num_rows"] == 6 and t["country_distribution"] == {"Peru": 3, "Ireland": 3} for t in audited["tables"].values())
    explored = report(config, "eda_summary")
    assert explored["source2"]["legal_suffixes"] == {"names": 6, "top": {"llc": 6}} and explored["source1"]["addresses"]["abbreviations"] == {"rd": 6} and explored["source3"]["frequent_tokens"]["kite"] == 1
    assert {t["status"] for t in report(config, "clean_manifest").values()} == {"cached"}
    recall = report(config, "candidate_recall")
    assert (recall["total_true_pairs"], recall["captured_true_pairs"], recall["missed_true_pairs"], recall["missed_sample"]) == (10, 10, 0, [])
    assert "| rule_exact_addr | 10 |" in Path(config.out("candidate_recall.md")).read_text() and "held-out" in Path(config.out("split_summary.md")).read_text()
    assert len(report(config, "features_train_manifest")["features"]) == 37
    assert [n for n, _ in report(config, "advanced_report")["results"]] == ["logistic", "logistic_mined"] and len(report(config, "train_report")["importances"]) == 15
    assert report(config, "final_model_selection")["selected_experiment"] == "logistic"
    assert spark.read.parquet(config.out("issues")).count() == 0 and report(config, "submission_validation") == {"is_valid": True, "issues": {}}
    lists = spark.read.csv(config.out("matching_results"), sep="\t", header=True)
    assert lists.count() == 6 and lists.columns == ["s1_entity_id", "matching_ids"]
    assert report(config, "inference_report")["num_test_entities"] == 6 and report(config, "package_report")["missing"] == []
    with zipfile.ZipFile(config.out("package.zip")) as z:
        assert z.read("output/matching_results.tsv").decode().count("s1_entity_id") == 1 and "commit" in json.loads(z.read("info.json"))["environment"]


def test_missing_tables_and_no_candidates(spark, config):
    for name in ("test_source2", "test_source3"):
        Path(config.raw(name)).unlink()
    for name in ("clean", "split", "blocking", "features", "train", "blocking_test", "features_test", "inference", "packaging"):
        stages.run_stage(spark, name, config)
    assert report(config, "clean_manifest")["test_source2"] == {"status": "not_present"}
    lists = spark.read.csv(config.out("matching_results"), sep="\t", header=True)
    assert lists.count() == 6 and lists.filter("matching_ids is not null").count() == 0
    Path(config.raw("test_source1")).unlink()
    stages.run_stage(spark, "inference", config, force=True)
    assert report(config, "inference_report")["num_test_entities"] == 0  # only candidates could tell the entities


def test_lists_without_a_column_are_refused(spark, config):
    stages.run_stage(spark, "clean", config)
    for name in ("matching_results", "candidate_pairs"):
        Path(config.out(name)).mkdir()
        (Path(config.out(name)) / "part-0.csv").write_text("s1_entity_id\nS1_0\n")
    with pytest.raises(ValueError, match="columns are missing in matching_results, candidate_pairs"):
        stages.run_packaging(spark, config)


def test_settings(tmp_path, monkeypatch):
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("val_ratio: 0.3\ngrid: [0.1, 0.9, 0.2]\nmore: {x: 1}\n")
    (tmp_path / "a.json").write_text('{"val_ratio": 0.3, "grid": [0.1, 0.9, 0.2], "more": {"x": 1}}')
    assert stages.Config.load(str(tmp_path / "a.yaml")) == stages.Config.load(str(tmp_path / "a.json"))
    monkeypatch.setenv("DATA_ROOT", "/elsewhere")
    got = stages.Config.load(str(tmp_path / "a.json"))
    assert (got.data_root, got.val_ratio, got.grid, got.extra) == ("/elsewhere", 0.3, (0.1, 0.9, 0.2), {"more": {"x": 1}})


def test_arriving_entities(spark, config, tmp_path):
    stages.run_stage(spark, "clean", config)
    targets = spark.read.parquet(config.out("clean_train")).filter("source <> 'S1'")
    kept_postings(targets).write.parquet(str(tmp_path / "postings"))
    arriving = spark.readStream.schema("entity_id string, business_name string, business_address string, country string").option("sep", "\t").option("header", True).option("pathGlobFilter", "test_source1.tsv").csv(config.data_root)
    query = candidate_hits(arriving, spark.read.parquet(str(tmp_path / "postings"))).writeStream.format("memory").queryName("hits").start()
    query.processAllAvailable()
    query.stop()
    found = {(r.s1_entity_id, r.target_entity_id) for r in spark.table("hits").collect()}
    assert {(f"S1_{i}", f"S2_{i}") for i in range(6)} <= found
