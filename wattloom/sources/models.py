"""Trained models and the table of their runs."""

from __future__ import annotations

import random
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wattloom.plans.forecast import MODEL_NAME, latest_version
from wattloom.sources.tables import Tables

RUNS = "ml.model_runs"


def _path(tables: Tables, name: str, version: int) -> str:
    return f"{tables.root}/models/{name}/{version}"


def resolve(tables: Tables, name: str = MODEL_NAME, version: int | str = "latest") -> int:
    """A version number; 'latest' is the highest recorded."""
    if version != "latest":
        return int(version)
    runs = tables.read(RUNS) if tables.exists(RUNS) else None
    found = None
    if runs is not None:
        found = tables.spark.range(1).select(latest_version(runs, name)).first()[0]
    if found is None:
        raise LookupError(f"no recorded version of {name}")
    return found


def _claimed(tables: Tables, name: str) -> int:
    """A version of this run's own: above all recorded ones and all that have been claimed.

    A claim is an empty file with the version and an id of the run's own in its name. A run owns the version if,
    once its claim is there, no other has one; of two that claim at once at most one goes on with it. That needs
    no more of the file system than that it lists what has been created. Claims stay, so a number is used once.
    """
    sc = tables.spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{tables.root}/models/{name}")
    system = folder.getFileSystem(sc._jsc.hadoopConfiguration())

    def taken() -> list[int]:
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        return [int(v) for n in names if (v := n.split(".")[0]).isdecimal()]

    try:
        recorded = resolve(tables, name)
    except LookupError:
        recorded = 0
    while True:
        version = max([recorded, *taken()]) + 1
        system.create(path(folder, f"{version}.{uuid.uuid4().hex}.claim"), False).close()
        if taken().count(version) == 1:
            return version
        time.sleep(random.random() / 4)


def save(
    tables: Tables, model: PipelineModel, name: str = MODEL_NAME, metrics: dict[str, float] | None = None
) -> int:
    """Saves the model under a version of its own and records the run with its metrics.

    Parallel runs get different versions. What a run that died has left is neither replaced nor in the way.
    """
    version = _claimed(tables, name)
    model.write().save(_path(tables, name, version))
    pairs = [F.lit(x) for k, v in (metrics or {}).items() for x in (k, float(v))]
    run = tables.spark.range(1, numPartitions=1).select(
        F.lit(name).alias("model_name"),
        F.lit(str(version)).alias("version"),
        F.current_timestamp().alias("trained_at"),
        F.create_map(*pairs).cast("map<string,double>").alias("metrics"),
    )
    tables.append(RUNS, run)
    return version


def load(tables: Tables, name: str = MODEL_NAME, version: int | str = "latest") -> PipelineModel:
    return PipelineModel.load(_path(tables, name, resolve(tables, name, version)))
