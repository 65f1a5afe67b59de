"""Completeness of ingestion for a month (G3..G6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import round_half_away
from gaugeflow.sources.workspace import stored

EXPECTED_FILES_PER_DAY = 14


def _file_days(scoped: DataFrame) -> DataFrame:
    """Rows per file and day: small, and every distinct count of the scope follows from it."""
    return scoped.groupBy("source_file", F.to_date("recorded_at").alias("reading_date")).agg(
        F.count(F.lit(1)).alias("n")
    )


def scan_stats(scoped: DataFrame) -> DataFrame:
    return _file_days(scoped).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        F.countDistinct("source_file").alias("distinct_files"),
        F.countDistinct("reading_date").alias("distinct_days"),
    )


def file_completeness(scoped: DataFrame, expected: int = EXPECTED_FILES_PER_DAY) -> DataFrame:
    """Days with fewer source files than expected; a day without any row is not listed."""
    received = F.col("files_received")
    return (
        _file_days(scoped)
        .groupBy("reading_date")
        .agg(F.count(F.lit(1)).alias("files_received"))
        .filter(received < expected)
        .select(
            "reading_date", "files_received",
            F.lit(expected).cast("bigint").alias("expected_files"),
            (F.lit(expected).cast("bigint") - received).alias("missing_files"),
        )
    )


def row_count_anomalies(scoped: DataFrame) -> DataFrame:
    """Files with fewer than half the median number of rows.

    Grouping by file and flat first makes the distinct flats a plain count. The rows per file
    are stored, so that their median costs no second pass over the readings; it keeps distinct
    row counts with their frequency, fewer than sqrt(2 x rows of the month).
    """
    per_file = stored(
        scoped.groupBy("source_file", "given_flat_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("recorded_at").alias("lo"),
            F.max("recorded_at").alias("hi"),
        )
        .groupBy("source_file")
        .agg(
            F.sum("n").alias("row_count"),
            F.count(F.lit(1)).alias("num_flats"),
            F.min("lo").alias("first_reading"),
            F.max("hi").alias("last_reading"),
        ),
        "file-rows",
    )
    n, median = F.col("row_count"), F.col("median_rows")
    return (
        per_file.withColumn("median_rows", per_file.agg(F.median("row_count").alias("m")).scalar())
        .filter((median > 0) & (n < F.lit(0.5) * median))
        .select(
            "source_file", "row_count", "median_rows",
            round_half_away(F.lit(100.0) * n / F.nullif(median, F.lit(0.0)), 1)
            .alias("pct_of_median"),
            "num_flats", "first_reading", "last_reading",
        )
    )


def ingestion_log_listing(log: DataFrame) -> DataFrame:
    return log.select("source_file", "file_hash", "ingested_at", "record_count").orderBy(
        F.desc("ingested_at")
    )
