"""Checks on the monthly summary (E0..E8).

(meter, month) is the primary key, so a window over a meter never holds more rows than
there are months, and a group of a flat's month never more than there are utilities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import round_half_away, sum_of_shares, with_exact_total
from gaugeflow.functions.period import Period, summary_in
from gaugeflow.schemas import METER, METER_WINDOW, SUMMARY_KEY
from gaugeflow.sources.workspace import tasks_for

MONTHS_PER_TASK = 200_000
_READINGS = ["opening_reading", "closing_reading", "monthly_reading"]


def scan_stats(summary: DataFrame, period: Period | None = None) -> DataFrame:
    return summary_in(summary, period).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("given_flat_id").alias("distinct_flats"),
        F.countDistinct("utility_type").alias("distinct_utilities"),
        F.countDistinct("year_month").alias("distinct_months"),
    )


def negative_consumption(summary: DataFrame, period: Period | None = None) -> DataFrame:
    return (
        summary_in(summary, period)
        .filter(F.col("monthly_reading") < 0)
        .select(*SUMMARY_KEY, *_READINGS)
    )


def zero_consumption(summary: DataFrame, period: Period | None = None) -> DataFrame:
    return (
        summary_in(summary, period)
        .filter(F.col("monthly_reading") == 0)
        .select(*SUMMARY_KEY, *_READINGS)
    )


def late_opening(summary: DataFrame, period: Period | None = None) -> DataFrame:
    day = F.dayofmonth("opening_timestamp")
    return (
        summary_in(summary, period)
        .filter(day > 2)
        .select(*SUMMARY_KEY, "opening_timestamp", day.alias("opening_day"))
    )


def early_closing(summary: DataFrame, period: Period | None = None) -> DataFrame:
    day = F.dayofmonth("closing_timestamp")
    return (
        summary_in(summary, period)
        .filter(day < 28)
        .select(*SUMMARY_KEY, "closing_timestamp", day.alias("closing_day"))
    )


def by_meter(summary: DataFrame) -> DataFrame:
    """A stored summary gathered by meter, for checks that look along a meter."""
    return summary.repartition(tasks_for(summary, MONTHS_PER_TASK), *METER_WINDOW)


def continuity_breaks(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Opening value that differs from the previous existing month's closing value.

    The previous month may lie outside the period, so the window sees every month up to
    the period's end and the period is applied afterwards.
    """
    by_month = Window.partitionBy(*METER_WINDOW).orderBy("year_month")
    history = summary if period is None else summary.filter(F.col("year_month") <= period.end)
    gap = F.col("opening_reading") - F.col("prev_closing")
    linked = history.select(
        *SUMMARY_KEY, "opening_reading",
        F.lag("year_month").over(by_month).alias("prev_month"),
        F.lag("closing_reading").over(by_month).alias("prev_closing"),
    )
    return (
        summary_in(linked, period)
        .filter(F.abs(gap) > 0.001)
        .select(
            *SUMMARY_KEY, "prev_month", "prev_closing",
            F.col("opening_reading").alias("curr_opening"), gap.alias("gap"),
        )
    )


def outlier_consumption(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Months more than three standard deviations from the meter's mean over all history."""
    meter = Window.partitionBy(*METER_WINDOW)
    value = F.col("monthly_reading")
    z = (value - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
    rows = summary.select(*SUMMARY_KEY, "monthly_reading").withColumns(
        {"months": F.count(F.lit(1)).over(meter), "n": F.count(value).over(meter),
         "low": F.min(value).over(meter), "high": F.max(value).over(meter)}
    ).filter(F.col("months") >= 3)
    scored = with_exact_total(rows, METER_WINDOW, value, "total").withColumn(
        "mean", F.col("total") / F.nullif(F.col("n"), F.lit(0))
    )
    widest = F.greatest(F.col("high") - F.col("mean"), F.col("mean") - F.col("low"))
    share = (value - F.col("mean")) / F.nullif(widest, F.lit(0.0))
    scored = scored.withColumn("squares", sum_of_shares(share * share, over=meter)).withColumn(
        "std", widest * F.sqrt(F.col("squares") / F.nullif(F.col("n") - 1, F.lit(0)))
    )
    return (
        summary_in(scored, period)
        .filter(F.abs(z) > 3)
        .select(
            *SUMMARY_KEY,
            round_half_away(value, 4).alias("monthly_reading"),
            round_half_away(F.col("mean"), 4).alias("historical_mean"),
            round_half_away(F.col("std"), 4).alias("historical_std"),
            round_half_away(z, 2).alias("z_score"),
        )
    )


def cross_utility_mismatch(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Flat months with a utility at zero while another one is in use."""
    zero = F.when(F.col("monthly_reading") == 0, F.col("utility_type"))
    active = F.when(F.col("monthly_reading") > 0, F.col("utility_type"))
    return (
        summary_in(summary, period)
        .groupBy("given_flat_id", "year_month")
        .agg(
            F.sort_array(F.collect_list(zero)).alias("zero_utilities"),
            F.sort_array(F.collect_list(active)).alias("active_utilities"),
        )
        .withColumn("zero_count", F.size("zero_utilities").cast("bigint"))
        .withColumn("active_count", F.size("active_utilities").cast("bigint"))
        .filter((F.col("zero_count") > 0) & (F.col("active_count") > 0))
    )


def months_in_scope(scoped: DataFrame):
    """Sorted distinct months as a scalar subquery value (one short text per month)."""
    return scoped.agg(F.sort_array(F.collect_set("year_month")).alias("months")).scalar()


def missing_months(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Months of the scope that a meter seen in the scope has no row for.

    The month list is a scalar subquery value and each meter subtracts its own months from
    it, so no meter x month product is built before the gaps are known.
    """
    scoped = summary_in(summary, period)
    per_meter = scoped.groupBy(*METER).agg(F.collect_set("year_month").alias("present"))
    absent = F.array_except(months_in_scope(scoped), F.col("present"))
    return per_meter.select(
        "given_flat_id", "utility_type", F.explode(absent).alias("year_month")
    )
