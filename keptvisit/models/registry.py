"""Training runs kept under the fingerprint of their data, for later scoring and reports.

A run is a folder with saved models and tables. It counts only once its manifest
is in place, which is written last and put there by one rename; a run that
stopped half way has none and is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keptvisit.session import together, use_checkpoints


@dataclass(frozen=True)
class Run:
    """A finished training run: its folder, and the saved models of every cell, best first."""

    spark: SparkSession
    folder: str
    models: list[dict]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def best(self) -> dict[tuple[str, str], PipelineModel]:
        """The best saved model of each band and horizon."""
        first = [m for m in self.models if m["rank"] == 1]
        loaded = together(self.spark, [
            partial(PipelineModel.load, f"{self.folder}/models/{m['cohort']}_{m['horizon']}/{m['name']}") for m in first])
        return {(m["cohort"], m["horizon"]): model for m, model in zip(first, loaded)}


def home(spark: SparkSession) -> str:
    """Where runs are kept: beside the checkpoints, so that later sessions find them."""
    use_checkpoints(spark)
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()) + "/training-runs"


def fingerprint(rows: DataFrame, settings: object) -> str:
    """A digest of all rows, in any order, and of the settings."""
    found = rows.agg(F.count(F.lit(1)), *[
        F.sum(F.xxhash64(F.lit(seed), *rows.columns).cast("decimal(38,0)")) for seed in (1, 2)]).first()
    text = json.dumps([rows.columns, *[str(v) for v in found], settings])
    return rows.sparkSession.range(1).select(F.sha2(F.lit(text), 256)).first()[0][:32]


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def find(spark: SparkSession, folder: str, print_: str) -> Run | None:
    """The finished run of a fingerprint."""
    files, where = _files(spark, f"{folder}/{print_}.json")
    if not files.exists(where):
        return None
    manifest = json.loads("".join(r["value"] for r in spark.read.text(f"{folder}/{print_}.json").collect()))
    return Run(spark, f"{folder}/{manifest['run']}", manifest["models"])


def train_once(
    spark: SparkSession, folder: str, print_: str, train: Callable[[str], list[dict]],
) -> Run:
    """The run of a fingerprint; `train` makes one in an empty folder if there is none.

    `train` gives a row per saved model: cohort, horizon, rank, name, auc. Of two
    runs at the same time the first to finish counts.
    """
    known = find(spark, folder, print_)
    if known is not None:
        return known
    run = f"{print_}-{uuid.uuid4().hex}"
    models = train(f"{folder}/{run}")
    draft = f"{folder}/{run}/manifest"
    spark.createDataFrame([(json.dumps({"run": run, "models": models}),)], "value string").coalesce(1).write.text(draft)
    files, where = _files(spark, draft)
    written = next(s.getPath() for s in files.listStatus(where) if s.getPath().getName().startswith("part-"))
    files.rename(written, _files(spark, f"{folder}/{print_}.json")[1])
    return find(spark, folder, print_)
