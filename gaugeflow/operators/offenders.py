"""Repeat offenders (D8, E9) and scan reports (D9, E11, G7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeat_offenders(rows: DataFrame, month: Column) -> DataFrame:
    """Flats flagged in more than one month; utilities are merged.

    Rows are counted per flat and month first, so a flat's state is its list of months.
    """
    return (
        rows.groupBy("given_flat_id", month.alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("given_flat_id")
        .agg(
            F.sum("n").alias("times_flagged"),
            F.count(F.lit(1)).alias("months_flagged"),
            F.array_join(F.sort_array(F.collect_list("month")), ", ").alias("month_list"),
        )
        .filter(F.col("months_flagged") > 1)
    )


def repeat_null_readings(nulls: DataFrame) -> DataFrame:
    """Missing values are already counted per meter: meters with several months stay as they are."""
    return nulls.filter(F.col("months_affected") > 1).select(
        "given_flat_id",
        F.col("months_affected").alias("times_flagged"),
        F.col("months_affected").alias("months_flagged"),
        F.lit(None).cast("string").alias("month_list"),
    )


def labelled_union(frames: dict[str, DataFrame]) -> DataFrame:
    """Stack same-shaped frames under a check_name column."""
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("check_name"), "*") for name, df in frames.items()],
    )


def scan_report(
    issues: dict[str, DataFrame | None], informational: tuple[str, ...] = ()
) -> DataFrame:
    """One row per check: its number of issues and PASS / found / SKIPPED, with the totals.

    A check given as None was not run. Informational checks are listed but not counted.
    Counts are brought together as one array of as many entries as there are checks, so
    each check is evaluated once.
    """
    counts = labelled_union(
        {
            name: df.agg(F.count(F.lit(1)).alias("issue_count"))
            for name, df in issues.items()
            if df is not None
        }
    )
    totals = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("check_name", "issue_count"))).alias("found")
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(number).alias("check_no"),
                F.lit(name).alias("check_name"),
                F.try_element_at("found", F.lit(name)).alias("issue_count"),
                F.lit(name not in informational).alias("counted"),
            )
            for number, name in enumerate(issues, 1)
        ]
    )
    relevant = F.transform(
        F.filter(listed, lambda check: check["counted"]),
        lambda check: F.coalesce(check["issue_count"], F.lit(0)),
    )
    count = F.col("issue_count")
    status = (
        F.when(count.isNull(), "SKIPPED")
        .when(~F.col("counted"), F.concat(count.cast("string"), F.lit(" listed")))
        .when(count > 0, F.concat(count.cast("string"), F.lit(" found")))
        .otherwise("PASS")
    )
    return totals.select(
        F.aggregate(relevant, F.lit(0).cast("bigint"), lambda total, n: total + n).alias(
            "total_issues"
        ),
        F.size(F.filter(relevant, lambda n: n > 0)).cast("bigint").alias("categories_hit"),
        F.inline(listed),
    ).select(
        "check_no", "check_name", F.coalesce(count, F.lit(0)).cast("bigint").alias("issue_count"),
        status.alias("status"), "total_issues", "categories_hit",
    )
