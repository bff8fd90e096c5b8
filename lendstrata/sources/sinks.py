"""Writers and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def sink_csv(df: DataFrame, path: str) -> None:
    """Id and score table as CSV with a header."""
    df.write.mode("overwrite").csv(path, header=True)


def sink_json(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def work_folder(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = _local_folder().name
    return folder


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="lendstrata-")


_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def run_folder(spark: SparkSession, keep: bool = False) -> Iterator[str]:
    """A folder in the shared one that takes the intermediate tables of a ``with`` block, and goes at its end.

    What is to outlive the block has to be written elsewhere before. Without such a block the tables stay until the shared
    folder is cleaned, since lazy results may read them.
    """
    folder = f"{work_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        if not keep:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, or in the run's folder in it."""
    return f"{_RUN.get() or work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table to the shared folder, or the run's folder in it, and read it back.

    Cuts the lineage at a place that outlives executors, and lets later steps prune columns.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
