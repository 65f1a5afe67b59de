"""Monthly summary, flat look-up and statistics (B1, B3..B5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.period import Period, month_of, month_start, readings_in, summary_in
from gaugeflow.schemas import METER, SUMMARY_KEY

SUMMARY_COLUMNS = [
    *SUMMARY_KEY, "opening_reading", "closing_reading", "monthly_reading",
    "opening_timestamp", "closing_timestamp",
]


def monthly_summary(readings: DataFrame, period: Period | None = None) -> DataFrame:
    """First and last non-null value per meter and month.

    All four buffers are fixed-width, so this is a hash aggregate combined map-side: one
    row per meter and month crosses the shuffle, however many readings a meter has.
    """
    opening = F.min_by("reading_value", "recorded_at")
    closing = F.max_by("reading_value", "recorded_at")
    return (
        readings_in(readings, period)
        .filter(F.col("reading_value").isNotNull())
        .groupBy(*METER, month_start(F.col("recorded_at")).alias("month"))
        .agg(
            opening.alias("opening_reading"),
            closing.alias("closing_reading"),
            F.min("recorded_at").alias("opening_timestamp"),
            F.max("recorded_at").alias("closing_timestamp"),
        )
        .withColumn("year_month", month_of(F.col("month")))
        .withColumn("monthly_reading", F.col("closing_reading") - F.col("opening_reading"))
        .select(*SUMMARY_COLUMNS)
    )


def show_monthly_summary(summary: DataFrame, month: Period) -> DataFrame:
    return summary_in(summary, month).select(*SUMMARY_COLUMNS).orderBy(*METER)


def flat_readings(
    readings: DataFrame, given_flat_id: str, start: str, end: str, utility_type: str | None = None
) -> DataFrame:
    """One flat between two dates, the end date included.

    Bounds are literals on the bare column, so flat, time range and utility reach the scan;
    of stored readings only the months from start to end are opened.
    """
    since = F.lit(start).cast("timestamp_ntz")
    until = F.lit(end).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(1))
    wanted = (
        (F.col("given_flat_id") == given_flat_id)
        & (F.col("recorded_at") >= since)
        & (F.col("recorded_at") < until)
    )
    if utility_type:
        wanted &= F.col("utility_type") == utility_type
    if "year_month" in readings.columns:
        wanted &= F.col("year_month").between(start[:7], end[:7])
    return (
        readings.filter(wanted)
        .select(*METER, "recorded_at", "reading_value")
        .orderBy("utility_type", "recorded_at")
    )


def table_stats(
    readings: DataFrame, summary: DataFrame, discrepancies: DataFrame, log: DataFrame
) -> DataFrame:
    """Row counts of the four tables and the extent of the readings, as one row.

    The other counts are scalar subqueries: no join, and Parquet answers them from footers.
    """
    per_meter = readings.groupBy(*METER).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("recorded_at").alias("lo"),
        F.max("recorded_at").alias("hi"),
    )
    def rows(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    extent = per_meter.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("readings"),
        F.min("lo").alias("earliest"),
        F.max("hi").alias("latest"),
        F.countDistinct("given_flat_id").alias("distinct_flats"),
        F.countDistinct("utility_type").alias("distinct_utilities"),
    )
    return extent.select(
        "readings",
        rows(summary).alias("monthly_summary"),
        rows(discrepancies).alias("monthly_discrepancy"),
        rows(log).alias("files_ingested"),
        "earliest", "latest", "distinct_flats", "distinct_utilities",
    )
