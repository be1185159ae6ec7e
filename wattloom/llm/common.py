"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import shared_folder

# Characters between words, as a class for Java's and Python's regular expressions.
SPACES = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, as their Python may lack it."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="spark-")), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def prepare(spark: SparkSession) -> SparkSession:
    """Ships the package, and sets small Arrow batches: one of whole texts must fit a worker."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def whole_text(name: str = "text") -> Column:
    """The text, with null taken as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which driver and executors all see."""
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{folder.rstrip('/')}/wattloom-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again; cuts the lineage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unique_name(df: DataFrame, stem: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
