"""Cross-utility coverage of flats (F0..F5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import exact_totals
from gaugeflow.functions.period import Period, summary_in
from gaugeflow.operators.summary_checks import months_in_scope


def utilities_in_scope(summary: DataFrame, period: Period | None = None) -> DataFrame:
    return summary_in(summary, period).select("utility_type").distinct()


def _utility_list(scoped: DataFrame):
    return scoped.agg(F.sort_array(F.collect_set("utility_type")).alias("utilities")).scalar()


def flat_utilities(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Sorted utilities of every flat: the members of the presence patterns.

    This is the pattern's flat list in long form. One pattern usually covers nearly all
    flats, so collecting its flats into one array would put them all into one task.
    """
    return (
        summary_in(summary, period)
        .groupBy("given_flat_id")
        .agg(F.sort_array(F.collect_set("utility_type")).alias("utilities_present"))
        .select(
            "utilities_present",
            F.size("utilities_present").cast("bigint").alias("num_utilities"),
            "given_flat_id",
        )
    )


def presence_patterns(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Number of flats per set of utilities, and whether the set is complete."""
    everything = F.size(_utility_list(summary_in(summary, period)))
    return (
        flat_utilities(summary, period)
        .groupBy("utilities_present", "num_utilities")
        .agg(F.count(F.lit(1)).alias("num_flats"))
        .withColumn("is_complete", F.col("num_utilities") == everything)
    )


def incomplete_coverage(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Utility/month slots a flat lacks, out of all utilities and months of the scope.

    Both lists are scalar subquery values. A flat's state is one month list per utility,
    bounded by the slots it can have; the flats x utilities x months product is never built.
    With a single month in scope there is no coverage to compare and the result is empty.
    """
    scoped = summary_in(summary, period)
    per_meter = scoped.groupBy("given_flat_id", "utility_type").agg(
        F.collect_set("year_month").alias("present")
    )
    lists = {"_utilities": _utility_list(scoped), "_months": months_in_scope(scoped)}
    per_flat = per_meter.groupBy("given_flat_id").agg(
        F.map_from_entries(F.collect_list(F.struct("utility_type", "present"))).alias("_present")
    )
    absent = F.transform(
        "_utilities",
        lambda utility: F.struct(
            utility.alias("utility"),
            F.array_except(
                F.col("_months"),
                F.coalesce(
                    F.try_element_at("_present", utility), F.array().cast("array<string>")
                ),
            ).alias("months"),
        ),
    )
    lacking = F.filter("_absent", lambda slot: F.size(slot["months"]) > 0)
    months = F.flatten(F.col("_absent.months"))
    return (
        per_flat.withColumns(lists)
        .filter(F.size("_months") > 1)
        .withColumn("_absent", absent)
        .select(
            "given_flat_id",
            F.size(months).cast("bigint").alias("missing_slots"),
            F.transform(lacking, lambda slot: slot["utility"]).alias("missing_utilities"),
            F.array_sort(F.array_distinct(months)).alias("missing_months"),
        )
        .filter(F.col("missing_slots") > 0)
    )


def zero_profiles(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Flats whose total is zero for some utilities and positive for others."""
    totals = exact_totals(
        summary_in(summary, period), ["given_flat_id", "utility_type"], F.col("monthly_reading")
    )
    zero = F.when(F.col("total") == 0, F.col("utility_type"))
    active = F.when(F.col("total") > 0, F.col("utility_type"))
    return (
        totals.groupBy("given_flat_id")
        .agg(
            F.sort_array(F.collect_list(zero)).alias("zero_utilities"),
            F.sort_array(F.collect_list(active)).alias("active_utilities"),
        )
        .withColumn("zero_count", F.size("zero_utilities").cast("bigint"))
        .withColumn("active_count", F.size("active_utilities").cast("bigint"))
        .filter((F.col("zero_count") > 0) & (F.col("active_count") > 0))
    )


def zero_profile_patterns(summary: DataFrame, period: Period | None = None) -> DataFrame:
    return (
        zero_profiles(summary, period)
        .groupBy("zero_utilities", "active_utilities")
        .agg(F.count(F.lit(1)).alias("num_flats"))
    )


def coverage_summary(summary: DataFrame, period: Period | None = None) -> DataFrame:
    patterns = presence_patterns(summary, period)
    zero_flats = zero_profiles(summary, period).agg(F.count(F.lit(1)).alias("n")).scalar()
    complete = F.col("is_complete")
    distinct_utilities = F.size(_utility_list(summary_in(summary, period)))
    return patterns.agg(
        F.coalesce(F.sum("num_flats"), F.lit(0)).cast("bigint").alias("flats_scanned"),
        F.count(F.lit(1)).alias("patterns"),
        F.coalesce(F.sum(F.when(complete, F.col("num_flats"))), F.lit(0))
        .cast("bigint").alias("full_coverage_flats"),
        F.count_if(~complete).alias("partial_patterns"),
    ).select(
        "flats_scanned",
        distinct_utilities.cast("bigint").alias("utility_types"),
        "patterns", "full_coverage_flats", "partial_patterns",
        zero_flats.alias("zero_on_some_flats"),
    )
