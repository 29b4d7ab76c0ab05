"""Cutting lineage through a folder that every executor of the cluster sees."""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

# Spark's switch for shuffle files of a query that has ended; without it they stay until the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries started inside remove their shuffle files when they end. For jobs that write what they make and read it
    back: a frame that is run twice inside has its shuffles made again. Enter it in one thread at a time."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one inside the warehouse.

    A warehouse on the file system of one machine is refused on a cluster, whose executors would not see it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not context.master.startswith("local") and urlsplit(warehouse).scheme in ("", "file"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors see; the warehouse is {warehouse}")
        named = f"{warehouse}/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame that several branches of a plan read, once, into reliable storage.

    Survives executor loss: the rows are files in the shared folder, not blocks of an executor.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
