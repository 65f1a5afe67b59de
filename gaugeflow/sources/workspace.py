"""The shared folder for data that has to outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Names that new_folder gives.
WORK_FOLDER = re.compile(r"[a-z-]+-[0-9a-f]{32}")


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, also set on the context if it is not yet.

    Only a local session without one gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="gaugeflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stored(rows: DataFrame, purpose: str, *partitions: str) -> DataFrame:
    """Rows written to a new folder and read back: computed once, and of known size."""
    spark = rows.sparkSession
    folder = new_folder(spark, purpose)
    rows.write.partitionBy(*partitions).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def tasks_for(rows: DataFrame, rows_per_task: int) -> int:
    """Partitions for rows of a stored table, whose number its files tell."""
    return partitions(rows, F.count(F.lit(1)), rows_per_task)


def partitions(rows: DataFrame, number: Column, rows_per_task: int) -> int:
    """Partitions for as many rows as an aggregate of stored rows tells.

    A task's share then does not grow with the input. Adaptive execution merges partitions by their
    compressed bytes, which say little of the memory a row takes, but not those of a given number.
    """
    n = rows.agg(number).first()[0] or 0
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // rows_per_task))


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
