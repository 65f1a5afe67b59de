"""Recorded findings (E10) and their report (G1, G2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import float_text
from gaugeflow.functions.period import Period, summary_in
from gaugeflow.operators import summary_checks as checks
from gaugeflow.schemas import FINDING_KEY, SUMMARY_KEY

WARNING, ERROR = "warning", "error"


def _text(name: str) -> Column:
    return float_text(F.col(name))


def _finding(rows: DataFrame, check: str, severity: str, remark: list, detail: list[str]):
    """Findings of one check: remark pieces are concatenated, detail columns become JSON."""
    pieces = [F.lit(part) if isinstance(part, str) else part for part in remark]
    return rows.select(
        *SUMMARY_KEY,
        F.lit(check).alias("check_name"),
        F.lit(severity).alias("severity"),
        F.concat(*pieces).alias("remark"),
        F.to_json(F.struct(*detail)).alias("detail_json"),
    )


def _listed(utilities: str) -> Column:
    """['Gas', 'Water'] as text."""
    return F.concat(F.lit("['"), F.array_join(utilities, "', '"), F.lit("']"))


def negative_findings(rows: DataFrame) -> DataFrame:
    return _finding(
        rows, "negative_consumption", ERROR,
        [
            "Negative monthly_reading: ", F.format_string("%.2f", "monthly_reading"),
            " (open=", _text("opening_reading"), ", close=", _text("closing_reading"), ")",
        ],
        ["opening_reading", "closing_reading", "monthly_reading"],
    )


def zero_findings(rows: DataFrame) -> DataFrame:
    return _finding(
        rows, "zero_consumption", WARNING,
        [
            "Zero monthly_reading (open=", _text("opening_reading"),
            ", close=", _text("closing_reading"), ")",
        ],
        ["opening_reading", "closing_reading"],
    )


def late_opening_findings(rows: DataFrame) -> DataFrame:
    timed = rows.withColumn("opening_timestamp", F.col("opening_timestamp").cast("string"))
    return _finding(
        timed, "late_opening", WARNING,
        ["Opening reading on day ", F.col("opening_day").cast("string"), " (expected day <= 2)"],
        ["opening_timestamp", "opening_day"],
    )


def early_closing_findings(rows: DataFrame) -> DataFrame:
    timed = rows.withColumn("closing_timestamp", F.col("closing_timestamp").cast("string"))
    return _finding(
        timed, "early_closing", WARNING,
        ["Closing reading on day ", F.col("closing_day").cast("string"), " (expected day >= 28)"],
        ["closing_timestamp", "closing_day"],
    )


def continuity_findings(rows: DataFrame) -> DataFrame:
    return _finding(
        rows, "continuity_break", ERROR,
        [
            "Continuity break: prev_closing=", _text("prev_closing"),
            ", curr_opening=", _text("curr_opening"), ", gap=", F.format_string("%.4f", "gap"),
        ],
        ["prev_month", "prev_closing", "curr_opening", "gap"],
    )


def outlier_findings(rows: DataFrame) -> DataFrame:
    return _finding(
        rows, "outlier_consumption", WARNING,
        [
            "Outlier: monthly_reading=", _text("monthly_reading"), ", z_score=", _text("z_score"),
            " (mean=", _text("historical_mean"), ", std=", _text("historical_std"), ")",
        ],
        ["monthly_reading", "z_score", "historical_mean", "historical_std"],
    )


def cross_utility_findings(rows: DataFrame) -> DataFrame:
    """One finding per utility that is at zero."""
    each = rows.withColumn("utility_type", F.explode("zero_utilities"))
    return _finding(
        each, "cross_utility_mismatch", WARNING,
        [
            "Cross-utility mismatch: ", F.col("utility_type"), " is zero while ",
            _listed("active_utilities"), " are active",
        ],
        ["zero_utilities", "active_utilities"],
    )


RECORDED = {
    checks.negative_consumption: negative_findings,
    checks.zero_consumption: zero_findings,
    checks.late_opening: late_opening_findings,
    checks.early_closing: early_closing_findings,
    checks.continuity_breaks: continuity_findings,
    checks.outlier_consumption: outlier_findings,
    checks.cross_utility_mismatch: cross_utility_findings,
}


ALONG_METERS = {checks.continuity_breaks, checks.outlier_consumption}


def summary_findings(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Findings of all recorded summary checks; (meter, month, check) is unique.

    The summary is read once per check and should be stored.
    """
    gathered = checks.by_meter(summary)
    return reduce(
        DataFrame.unionByName,
        [as_findings(check(gathered if check in ALONG_METERS else summary, period))
         for check, as_findings in RECORDED.items()],
    )


def discrepancy_filter(
    discrepancies: DataFrame,
    period: Period | None = None,
    check_name: str | None = None,
    severity: str | None = None,
) -> DataFrame:
    wanted = summary_in(discrepancies, period)
    if check_name:
        wanted = wanted.filter(F.col("check_name") == check_name)
    if severity:
        wanted = wanted.filter(F.col("severity") == severity)
    return wanted


def discrepancy_report(discrepancies: DataFrame, *args, **kwargs) -> DataFrame:
    return (
        discrepancy_filter(discrepancies, *args, **kwargs)
        .select(*FINDING_KEY, "severity", "remark")
        .orderBy("year_month", "check_name", "utility_type", "given_flat_id")
    )


def discrepancy_counts(discrepancies: DataFrame, *args, **kwargs) -> DataFrame:
    return (
        discrepancy_filter(discrepancies, *args, **kwargs)
        .groupBy("check_name", "severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "check_name", "severity")
    )
