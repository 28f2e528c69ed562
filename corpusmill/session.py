"""Session helpers: tables of a folder, shared storage for lineage cuts."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for operators that need Python there."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = Path(__file__).resolve().parent
        to = os.path.join(tempfile.mkdtemp(prefix="corpusmill-"), "corpusmill.zip")
        with zipfile.ZipFile(to, "w") as z:
            for p in sorted(here.rglob("*.py")):
                z.write(p, p.relative_to(here.parent))
        spark.sparkContext.addPyFile(to)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a temporary one only where none is set and all runs on one machine, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/corpusmill/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Deletes what this application wrote to the shared folder; results not yet read are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each write within deletes its shuffle files as it ends; else these stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes ``df`` once to the shared folder and returns the written table, so that a lost executor never forces the lineage to run again."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)
