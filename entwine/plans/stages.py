"""The stages from raw tables to checked lists, each from files to files, and their order."""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, blocking, checkpoints, evaluate, features, models, split, validate
from ..operators.normalize import clean_records
from ..sources import files, tables


@dataclass
class Config:
    """Where tables are read and stages are written; DATA_ROOT and STORAGE_ROOT override the paths."""

    data_root: str = "data"
    storage_root: str = "storage"
    max_candidates: int = blocking.MAX_CANDIDATES
    max_block: int = blocking.MAX_BLOCK
    val_ratio: float = 0.2
    seed: int = 42
    beta: float = 0.5
    grid: tuple[float, float, float] = (0.20, 0.95, 0.02)
    kinds: tuple[str, ...] = ("gbt", "logistic")
    extra: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None = None) -> Config:
        """From a JSON or YAML file; keys that are no setting are kept in extra."""
        raw = _settings(path) if path else {}
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items() if k in cls.__dataclass_fields__ and k != "extra"}
        out = cls(**known, extra={k: v for k, v in raw.items() if k not in cls.__dataclass_fields__})
        out.data_root, out.storage_root = os.environ.get("DATA_ROOT", out.data_root), os.environ.get("STORAGE_ROOT", out.storage_root)
        return out

    def raw(self, name: str) -> str:
        exact = f"{self.data_root}/{name}.tsv"
        return exact if "://" in exact or Path(exact).exists() else tables.find_file(self.data_root, name) or exact

    def out(self, name: str) -> str:
        return f"{self.storage_root}/{name}"

    @property
    def checkpoints(self) -> str:
        return self.out("checkpoints")


def _settings(path: str) -> dict:
    text = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix not in (".yaml", ".yml"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise ValueError("YAML settings need the package yaml; JSON does not") from missing
    return yaml.safe_load(text) or {}


def _read(spark: SparkSession, c: Config, name: str) -> DataFrame:
    return spark.read.parquet(c.out(name))


def _write(df: DataFrame, c: Config, name: str) -> None:
    df.write.mode("overwrite").parquet(c.out(name))


def _report(c: Config, name: str, content: dict, markdown: str | None = None) -> None:
    """A report as <name>.json, and as <name>.md where it has words."""
    files.write_text(c.out(f"{name}.json"), json.dumps(content, indent=2, default=str))
    if markdown is not None:
        files.write_text(c.out(f"{name}.md"), markdown)


def _row(df: DataFrame) -> dict:
    return df.first().asDict()


def _counts(df: DataFrame, key: str, most: int = 50) -> dict:
    return {r[key]: r["n"] for r in df.orderBy(F.desc("n"), key).limit(most).collect()}


def _lines(head: list[str], rows: list[list]) -> list[str]:
    cells = lambda x: "| " + " | ".join(map(str, x)) + " |"
    return [cells(head), cells(["---"] * len(head)), *map(cells, rows)]


def _clean(spark: SparkSession, c: Config, part: str) -> tuple[DataFrame, DataFrame]:
    all_ = _read(spark, c, f"clean_{part}")
    return all_.filter("source = 'S1'"), all_.filter("source <> 'S1'")


def _truth(spark: SparkSession, c: Config) -> tuple[DataFrame, DataFrame]:
    raw = tables.read_tsv(spark, c.raw("train_ground_truth"))
    return tables.truth_entities(raw), tables.truth_pairs(raw)


TABLES = tuple((part, k) for part in ("train", "test") for k in (1, 2, 3))


def _present(c: Config) -> list[tuple[str, int]]:
    return [(part, k) for part, k in TABLES if files.exists(c.raw(f"{part}_source{k}"))]


def run_audit(spark: SparkSession, c: Config) -> None:
    """All six tables and the ground truth; a table that is not there is said to be so."""
    found: dict[str, dict] = {f"{part}_source{k}": {"status": "not_present"} for part, k in TABLES}
    for part, k in _present(c):
        one = tables.read_entities(spark, c.raw(f"{part}_source{k}"))
        texts = {column: _row(audit.text_stats(one, column)) for column in ("business_name", "business_address")}
        found[f"{part}_source{k}"] = {"status": "audited", **_row(audit.table_audit(one)), "texts": texts, "country_distribution": _counts(audit.distribution(one, "country"), "value")}
    s1 = tables.read_entities(spark, c.raw("train_source1")).select(F.col("entity_id").alias("s1_entity_id"))
    _report(c, "audit_report", {"tables": found, "ground_truth": _row(audit.truth_cardinality(_truth(spark, c)[1], s1))})


def run_eda(spark: SparkSession, c: Config) -> None:
    """Suffixes, casing and marks, addresses and frequent tokens of each training table."""
    out = {}
    for part, k in _present(c):
        if part == "train":
            one = tables.read_entities(spark, c.raw(f"{part}_source{k}"))
            suffixes = audit.suffix_frequency(one, "business_name")
            out[f"source{k}"] = {
                "legal_suffixes": {"names": suffixes.agg(F.sum("n")).first()[0] or 0, "top": _counts(suffixes, "suffix")},
                "casing": _counts(audit.casing_distribution(one, "business_name"), "casing"),
                "marks": _counts(audit.punctuation(one, "business_name"), "mark"),
                "addresses": {**_row(audit.address_patterns(one, "business_address")), "abbreviations": _counts(audit.address_abbreviations(one, "business_address"), "token")},
                "frequent_tokens": _counts(audit.frequent_tokens(one, "business_name"), "token"),
            }
    _report(c, "eda_summary", out)


def run_clean(spark: SparkSession, c: Config) -> None:
    """Each raw table to clean records, beside those that were there before; what became of each is in the manifest."""
    manifest = {f"{part}_source{k}": {"status": "not_present"} for part, k in TABLES}
    for part, k in _present(c):
        raw, path = c.raw(f"{part}_source{k}"), c.out(f"clean_{part}/source=S{k}")
        status = "cached" if files.exists(f"{path}/_SUCCESS") else "processed"
        if status == "processed":
            clean_records(tables.read_entities(spark, raw)).write.mode("overwrite").parquet(path)
        manifest[f"{part}_source{k}"] = {"status": status, "input": raw, "path": path, "rows": spark.read.parquet(path).count()}
    _report(c, "clean_manifest", manifest)


def run_split(spark: SparkSession, c: Config) -> None:
    s1, _ = _clean(spark, c, "train")
    listed = tables.truth_pairs(tables.read_tsv(spark, c.raw("train_ground_truth")), distinct=False)
    _write(split.assigned(split.strata(s1, listed), c.val_ratio, c.seed), c, "folds")
    found = [r.asDict() for r in split.stats(_read(spark, c, "folds")).orderBy("fold", "stratum").collect()]
    sizes = {f: sum(r["n"] for r in found if r["fold"] == f) for f in ("train", "val")}
    text = ["# Split of the S1 entities", "", f"Seed {c.seed}, validation share {c.val_ratio}; {sizes['train']} train and {sizes['val']} held-out entities. No entity is in both.", "", *_lines(["fold", "stratum", "entities", "per cent"], [[r["fold"], r["stratum"], r["n"], r["pct"]] for r in found])]
    _report(c, "split_summary", {"seed": c.seed, "val_ratio": c.val_ratio, "sizes": sizes, "strata": found}, "\n".join(text) + "\n")


def _held_out(spark: SparkSession, c: Config) -> DataFrame:
    """(s1_entity_id) of the held-out entities: of the folds, else of a list of ids beside the raw tables, else none."""
    if files.exists(c.out("folds")):
        return _read(spark, c, "folds").filter("fold = 'val'").select(F.col("entity_id").alias("s1_entity_id"))
    return tables.listed_ids(spark, f"{c.data_root}/validation_split.json", "val_entity_ids")


def run_blocking(spark: SparkSession, c: Config, part: str = "train") -> None:
    s1, targets = _clean(spark, c, part)
    _write(blocking.candidates(s1, targets, c.max_candidates, c.max_block), c, f"candidates_{part}")
    _report(c, f"blocking_{part}", _row(blocking.summary(s1, _read(spark, c, f"candidates_{part}"))))


def run_recall(spark: SparkSession, c: Config) -> None:
    _, truth = _truth(spark, c)
    pairs = _read(spark, c, "candidates_train")
    found = _row(evaluate.recall_breakdown(truth, pairs, _held_out(spark, c)))
    rules = [r.asDict() for r in evaluate.rule_ablation(truth, pairs).orderBy(F.desc("captured"), "rule").collect()]
    missed = [r.asDict() for r in evaluate.missed_sample(truth, pairs).collect()]
    total = found["total_true_pairs"] - found["captured_true_pairs"]
    text = ["# Recall of the candidates", "", *_lines(["what", "value"], list(map(list, found.items()))), "", "## Rules", "", *_lines(["rule", "captured", "per cent", "alone", "per cent"], [list(r.values()) for r in rules]), "", f"## Missed pairs: {total}", ""]
    text += _lines(["s1", "target", "source"], [[r["s1_entity_id"], r["target_entity_id"], r["target_source"]] for r in missed]) if missed else ["None."]
    _report(c, "candidate_recall", found | {"missed_true_pairs": total, "rules": rules, "missed_sample": missed}, "\n".join(text) + "\n")


def run_features(spark: SparkSession, c: Config, part: str = "train") -> None:
    s1, targets = _clean(spark, c, part)
    found = features.pair_features(_read(spark, c, f"candidates_{part}"), s1.drop("source"), features.last_of_each(targets))
    if part == "train":
        found = features.labelled(found, _truth(spark, c)[1], _held_out(spark, c))
        found.write.mode("overwrite").partitionBy("is_validation").parquet(c.out("features_train"))
    else:
        _write(found, c, f"features_{part}")
    written = _read(spark, c, f"features_{part}")
    manifest = {"features": features.feature_names(written), "rows": written.count()}
    if part == "train":
        manifest["by_label"] = {f"match {r['is_match']}, held out {r['is_validation']}": r["count"] for r in written.groupBy("is_match", "is_validation").count().collect()}
    _report(c, f"features_{part}_manifest", manifest)


def _held(spark: SparkSession, c: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    entities, truth = _truth(spark, c)
    val = _held_out(spark, c)
    return _read(spark, c, "features_train"), entities.join(val, "s1_entity_id", "left_semi"), truth.join(val, "s1_entity_id", "left_semi")


def run_baseline(spark: SparkSession, c: Config) -> None:
    f, entities, truth = _held(spark, c)
    found = models.matches(models.baseline_scores(f.filter("is_validation = 1")))
    _report(c, "baseline_report", _row(evaluate.macro_fbeta(entities, truth, found, c.beta)))


def _experiment(c: Config, f: DataFrame, found: tuple, name: str) -> None:
    """Checkpoint and report of the best of some experiments."""
    best, model, results = found
    value = dict(results)[best]
    about = checkpoints.save(model, c.checkpoints, value, f"macro_f{c.beta}", best, {"kinds": list(c.kinds), "seed": c.seed}, rounds=models.rounds(model))
    weights = models.importances(model, features.feature_names(f))
    _report(c, name, {"experiment": best, "macro_f_beta": value, "rounds": models.rounds(model), "is_best": about["is_best"], "results": models.leaderboard(results), "importances": [{"feature": n, "weight": w} for n, w in weights]})


def run_train(spark: SparkSession, c: Config) -> None:
    f, entities, truth = _held(spark, c)
    _experiment(c, f, models.compare(f, entities, truth, kinds=c.kinds, beta=c.beta), "train_report")


def _threshold(spark: SparkSession, c: Config) -> float:
    """The tuned threshold, 0.5 without one."""
    return _read(spark, c, "threshold").first()["threshold"] if files.exists(c.out("threshold")) else 0.5


def run_threshold(spark: SparkSession, c: Config) -> None:
    f, entities, truth = _held(spark, c)
    scored = models.scores(checkpoints.chosen(c.checkpoints)[0], f.filter("is_validation = 1"))
    _write(evaluate.best_threshold(evaluate.threshold_grid(scored, entities, truth, *c.grid, c.beta)), c, "threshold")


def run_hard_negatives(spark: SparkSession, c: Config) -> None:
    f = _read(spark, c, "features_train")
    scored = models.scores(checkpoints.chosen(c.checkpoints)[0], f)
    _write(models.hard_negatives(f, scored, _threshold(spark, c)), c, "features_mined")


def run_advanced(spark: SparkSession, c: Config) -> None:
    """Every kind once more, on the mined rows where there are any, at the tuned threshold."""
    f, entities, truth = _held(spark, c)
    mined = _read(spark, c, "features_mined") if files.exists(c.out("features_mined")) else None
    _experiment(c, f, models.compare(f, entities, truth, _threshold(spark, c), c.kinds, mined, c.beta), "advanced_report")


def run_selection(spark: SparkSession, c: Config) -> None:
    ranked = checkpoints.experiments(c.checkpoints)
    _, about = checkpoints.chosen(c.checkpoints)
    _report(c, "final_model_selection", {"selected_experiment": about["experiment"], "best_macro_f_beta": about["metric_value"], "optimal_threshold": _threshold(spark, c), "all_experiments_ranked": [{"experiment": n, "macro_f_beta": v} for n, v in ranked]})


def run_inference(spark: SparkSession, c: Config) -> None:
    """The lists of every test entity: those of the raw table, else those that have candidates. Without any candidates all
    lists are empty."""
    pairs = _read(spark, c, "features_test")
    raw = c.raw("test_source1")
    ids = tables.read_entities(spark, raw).select(F.trim("entity_id").alias("s1_entity_id")) if files.exists(raw) else pairs.select("s1_entity_id")
    cut = _threshold(spark, c)
    found = models.matches(models.scores(checkpoints.chosen(c.checkpoints)[0], pairs), cut)
    _write(found.select("s1_entity_id", "target_entity_id", "score"), c, "matches")
    found = _read(spark, c, "matches")
    tables.write_tsv(tables.joined_lists(ids, found), c.out("matching_results"), "s1_entity_id")
    tables.write_tsv(tables.joined_lists(ids, pairs, out="candidate_ids"), c.out("candidate_pairs"), "s1_entity_id")
    n, matched = ids.distinct().count(), found.select("s1_entity_id").distinct().count()
    _report(c, "inference_report", {"num_test_entities": n, "num_test_candidate_pairs": pairs.count(), "num_entities_with_matches": matched, "num_predicted_singletons": n - matched, "threshold_used": cut})


def run_packaging(spark: SparkSession, c: Config) -> None:
    """Raises if a list lacks a column or anything else is wrong with the lists."""
    s1, targets = _clean(spark, c, "test")
    lists = {name: tables.read_tsv(spark, c.out(name)) for name in ("matching_results", "candidate_pairs")}
    if short := [name for name, df in lists.items() if validate.columns_missing(df)]:
        raise ValueError(f"columns are missing in {', '.join(short)}")
    _write(validate.issues(*lists.values(), s1, targets), c, "issues")
    found = _read(spark, c, "issues")
    _report(c, "submission_validation", {"is_valid": (n := found.count()) == 0, "issues": _counts(found.groupBy("issue").agg(F.count("*").alias("n")), "issue")})
    if n:
        raise ValueError(f"{n} issues in the lists; see {c.out('issues')}")


def run_reproducibility(spark: SparkSession, c: Config) -> None:
    """One archive of the lists (each as one file), the reports, and what the run depended on."""
    about = {"packaged_at": datetime.now(UTC).isoformat(), "environment": checkpoints.environment(spark), "config": asdict(c)}
    folders = {f"output/{n}.tsv": c.out(n) for n in ("matching_results", "candidate_pairs")}
    reports = {f"artifacts/{n}.json": c.out(f"{n}.json") for n in ("submission_validation", "final_model_selection", "inference_report", "train_report", "advanced_report")}
    _report(c, "package_report", tables.pack(folders | reports, c.out("package.zip"), about))


def _test(stage: Callable) -> Callable:
    return lambda spark, c: stage(spark, c, "test")


#: name: (function, inputs, outputs), in the order in which they run.
STAGES: dict[str, tuple[Callable, tuple[str, ...], tuple[str, ...]]] = {
    "audit": (run_audit, (), ("audit_report.json",)),
    "eda": (run_eda, (), ("eda_summary.json",)),
    "clean": (run_clean, (), ("clean_train", "clean_test", "clean_manifest.json")),
    "split": (run_split, ("clean_train",), ("folds", "split_summary.json")),
    "blocking": (run_blocking, ("clean_train",), ("candidates_train",)),
    "recall": (run_recall, ("candidates_train",), ("candidate_recall.json",)),
    "features": (run_features, ("candidates_train",), ("features_train",)),
    "baseline": (run_baseline, ("features_train",), ("baseline_report.json",)),
    "train": (run_train, ("features_train",), ("checkpoints/latest", "train_report.json")),
    "threshold": (run_threshold, ("checkpoints/latest",), ("threshold",)),
    "hard_negatives": (run_hard_negatives, ("checkpoints/latest",), ("features_mined",)),
    "advanced": (run_advanced, ("features_train",), ("advanced_report.json",)),
    "selection": (run_selection, ("checkpoints/latest",), ("final_model_selection.json",)),
    "blocking_test": (_test(run_blocking), ("clean_test",), ("candidates_test",)),
    "features_test": (_test(run_features), ("candidates_test",), ("features_test",)),
    "inference": (run_inference, ("checkpoints/latest", "features_test"), ("matching_results", "candidate_pairs", "inference_report.json")),
    "packaging": (run_packaging, ("matching_results", "candidate_pairs"), ("issues", "submission_validation.json")),
    "reproducibility": (run_reproducibility, ("matching_results", "candidate_pairs"), ("package.zip",)),
}


def run_stage(spark: SparkSession, name: str, c: Config, force: bool = False) -> bool:
    """Run a stage unless its outputs are there (or force). False if they were. A missing input raises."""
    stage, inputs, outputs = STAGES[name]
    if missing := [i for i in inputs if not files.exists(c.out(i))]:
        raise FileNotFoundError(f"{name} needs {', '.join(missing)}")
    if not force and all(files.exists(c.out(o)) for o in outputs):
        return False
    stage(spark, c)
    return True


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m entwine.plans.stages")
    parser.add_argument("--stage", default="all", choices=["all", *STAGES])
    parser.add_argument("--config")
    parser.add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    for name in STAGES if args.stage == "all" else [args.stage]:
        print(name, "done" if run_stage(spark, name, Config.load(args.config), args.force) else "kept")


if __name__ == "__main__":
    main()
