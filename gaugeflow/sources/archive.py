"""Month archives: sorted Parquet, written and read back (A12, A13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schemas import READING_COLUMNS, READING_KEY
from gaugeflow.sources.snapshots import Storage


def write_archive(readings: DataFrame, path: str) -> None:
    """Readings sorted by key as ZSTD Parquet. The key is unique, so sort ranges are even.

    An archive is never written over: it may hold the only copy of its readings.
    """
    (
        readings.select(*READING_COLUMNS)
        .sort(*READING_KEY)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .parquet(path)
    )


def free_path(spark: SparkSession, folder: str, month: str) -> str:
    """The month's archive path, with a number behind it from the second archive on."""
    storage, version = Storage(spark), 1
    while True:
        suffix = "" if version == 1 else f"-{version}"
        path = f"{folder.rstrip('/')}/readings_{month}{suffix}.parquet"
        if not storage.exists(path):
            return path
        version += 1


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*READING_COLUMNS)


def conflicting_keys(existing: DataFrame, archived: DataFrame) -> DataFrame:
    """Keys that forbid a reload: stored already, or more than once in the archive."""
    stored = archived.select(*READING_KEY).join(
        existing.select(*READING_KEY), READING_KEY, "left_semi"
    )
    repeated = archived.groupBy(*READING_KEY).agg(F.count(F.lit(1)).alias("n"))
    return stored.unionByName(repeated.filter(F.col("n") > 1).drop("n"))
