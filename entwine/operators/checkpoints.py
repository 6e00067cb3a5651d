"""Checkpoints of models: the latest, the best, and one for each experiment, with what is known of them.

A checkpoint is a folder with the model as Spark ML writes it and metadata.json; it lies in any file system that Spark
reaches. The best one is replaced only by a better value of its metric.
"""

from __future__ import annotations

import json
import platform
import subprocess
import sys
from datetime import UTC, datetime
from pathlib import Path

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..sources import files

LATEST, BEST, EXPERIMENTS = "latest", "best", "experiments"


def git_state(folder: str | None = None) -> dict[str, str]:
    """Commit and branch of a working tree, "unknown" without one."""
    out = {}
    for name, args in (("commit", ["rev-parse", "HEAD"]), ("branch", ["rev-parse", "--abbrev-ref", "HEAD"])):
        try:
            out[name] = subprocess.run(["git", *args], cwd=folder or Path(__file__).parent, capture_output=True, text=True, check=True).stdout.strip()
        except (OSError, subprocess.CalledProcessError):
            out[name] = "unknown"
    return out


def environment(spark: SparkSession) -> dict[str, object]:
    """What a run depends on: platform, versions, the cluster's size and the code's commit."""
    sc = spark.sparkContext
    return {"platform": platform.platform(), "python": sys.version.split()[0], "pyspark": pyspark.__version__, "spark": spark.version, "master": sc.master, "parallelism": sc.defaultParallelism, **git_state()}


def save(model: PipelineModel, root: str, value: float, metric: str = "macro_f_beta", experiment: str | None = None, config: dict | None = None, **more: object) -> dict[str, object]:
    """Writes the latest checkpoint and, if asked for, the experiment's, and the best one if the value is greater than
    that of the best so far. Returns the metadata, with whether it is the best."""
    spark = SparkSession.getActiveSession()
    known = metadata(f"{root}/{BEST}")
    best = known is None or value > known.get("metric_value", float("-inf"))
    about = {"written_at": datetime.now(UTC).isoformat(), "metric_name": metric, "metric_value": float(value), "experiment": experiment, "config": config or {}, "environment": environment(spark), **more}
    for name in [LATEST, *([BEST] if best else []), *([f"{EXPERIMENTS}/{experiment}"] if experiment else [])]:
        model.write().overwrite().save(f"{root}/{name}/model")
        files.write_text(f"{root}/{name}/metadata.json", json.dumps(about, indent=2))
    return about | {"is_best": best}


def metadata(folder: str) -> dict | None:
    """The metadata of a checkpoint, None if there is none."""
    text = files.read_text(f"{folder}/metadata.json")
    return None if text is None else json.loads(text)


def load(root: str, which: str = BEST) -> tuple[PipelineModel, dict] | None:
    """A checkpoint's model and metadata; None if it is not there. One that is there and cannot be read raises."""
    about = metadata(f"{root}/{which}")
    return None if about is None else (PipelineModel.load(f"{root}/{which}/model"), about)


def chosen(root: str) -> tuple[PipelineModel, dict]:
    """The best checkpoint, or the latest where there is no best one."""
    found = load(root, BEST) or load(root, LATEST)
    if found is None:
        raise FileNotFoundError(f"no checkpoint in {root}")
    return found


def experiments(root: str) -> list[tuple[str, float]]:
    """(experiment, value) of all experiments, the greatest value first, equal ones by name; 0 counts like any other."""
    names = files.list_names(f"{root}/{EXPERIMENTS}")
    found = [(n, about["metric_value"]) for n in names if (about := metadata(f"{root}/{EXPERIMENTS}/{n}")) is not None]
    return sorted(found, key=lambda x: (-x[1], x[0]))
