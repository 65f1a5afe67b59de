"""The jobs a user runs: ingest, summarize, archive, reload, look up and check.

Checks return DataFrames (declared, not run). Jobs that write return small facts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.period import Period, month_of, parse_period, readings_in, single_month
from gaugeflow.operators import (
    coverage, daily, findings, granular, intake, intake_checks, offenders, summary_checks,
)
from gaugeflow.operators import summary as summaries
from gaugeflow.operators.merge import insert_if_absent
from gaugeflow.operators.sheets import SHEET_POSITION, Sheets, contents_of, records_of, with_time_cell
from gaugeflow.schemas import READING_KEY
from gaugeflow.sources import archive, files
from gaugeflow.sources.snapshots import expire_folders
from gaugeflow.sources.tables import MeterTables
from gaugeflow.sources.workspace import stored

# -- checks ----------------------------------------------------------------------------

# Column that places a granular finding in a month.
GRANULAR_TIME = {
    "backward_readings": "recorded_at",
    "zero_consumption": "month",
    "gap_detection": "reading_date",
    "spike_detection": "recorded_at",
    "stale_runs": "stale_from",
}

# The order in which reports list the rows of a check ('-' means descending).
REPORT_ORDER = {
    "backward_readings": ["utility_type", "given_flat_id", "recorded_at"],
    "zero_consumption": ["month", "utility_type", "given_flat_id"],
    "gap_detection": ["reading_date", "utility_type", "given_flat_id"],
    "spike_detection": ["-z_score"],
    "stale_runs": ["-stale_seconds", "utility_type", "given_flat_id"],
    "null_readings": ["-null_count", "utility_type", "given_flat_id"],
    "out_of_order": ["source_file", "given_flat_id", "recorded_at"],
    "negative_consumption": ["monthly_reading"],
    "zero_consumption_summary": ["year_month", "utility_type", "given_flat_id"],
    "late_opening": ["-opening_day", "utility_type", "given_flat_id"],
    "early_closing": ["closing_day", "utility_type", "given_flat_id"],
    "continuity_breaks": ["-abs(gap)"],
    "outlier_consumption": ["-abs(z_score)"],
    "cross_utility_mismatch": ["given_flat_id", "year_month"],
    "missing_months": ["given_flat_id", "utility_type", "year_month"],
    "presence_patterns": ["-num_flats"],
    "flat_utilities": ["utilities_present", "given_flat_id"],
    "incomplete_coverage": ["-missing_slots", "given_flat_id"],
    "zero_profiles": ["-zero_count", "given_flat_id"],
    "zero_profile_patterns": ["-num_flats"],
    "file_completeness": ["reading_date"],
    "row_count_anomalies": ["row_count"],
    "ingestion_log": ["-ingested_at"],
}


@dataclass(frozen=True)
class Scan:
    """Outcome of a family of checks, each a DataFrame."""

    stats: DataFrame
    checks: dict[str, DataFrame]
    report: DataFrame | None = None
    repeat_offenders: DataFrame | None = None

    def listing(self, check: str, limit: int | None = None) -> DataFrame:
        """Rows of a check in report order; with a limit this is a top-k, not a full sort."""
        order = [
            F.expr(by.removeprefix("-")).desc() if by.startswith("-") else F.expr(by).asc()
            for by in REPORT_ORDER[check]
        ]
        ordered = self.checks[check].orderBy(*order)
        return ordered if limit is None else ordered.limit(limit)


def as_period(period: str | Period | None) -> Period | None:
    return parse_period(period) if isinstance(period, str) else period


def _month_text(time: str) -> Column:
    return F.substring(F.col(time).cast("string"), 1, 7)


def detect_discrepancies(readings: DataFrame, period: str | Period) -> Scan:
    """All checks on the readings of a period; repeat offenders if it has several months.

    The readings are read twice, whatever is asked of the scan: once for the states of meter days,
    once, in time order, for the checks that compare neighbours. Both are stored in the shared
    folder, the states at one row per meter and day and the findings of the other checks as they
    are; statistics, report, offenders and listings take them from there.
    """
    scope = as_period(period)
    scoped = readings_in(readings, scope)
    days = stored(granular.day_states(scoped), "days")
    shared = granular.Readings(scoped, days=days)
    ordered = _stored_together({
        "backward_readings": granular.backward_readings(shared),
        "spike_detection": granular.spike_detection(shared),
        "stale_runs": granular.stale_runs(shared),
    })
    checks = {
        "backward_readings": ordered["backward_readings"],
        "zero_consumption": granular.zero_consumption_of_days(days),
        "gap_detection": granular.gap_detection_of_days(days),
        "spike_detection": ordered["spike_detection"],
        "stale_runs": ordered["stale_runs"],
        "null_readings": granular.null_readings_of_days(days),
        "out_of_order": granular.out_of_order(scoped),
    }
    repeats = None
    if scope.is_multi_month:
        per_check = {
            name: offenders.repeat_offenders(checks[name], _month_text(time))
            for name, time in GRANULAR_TIME.items()
        }
        per_check["null_readings"] = offenders.repeat_null_readings(checks["null_readings"])
        repeats = offenders.labelled_union(per_check)
    return Scan(granular.scan_stats_of_days(days), checks, offenders.scan_report(checks), repeats)


def _stored_together(checks: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Checks on the same rows, evaluated by one job so that they share scan and shuffle."""
    found = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [rows.select(F.lit(name).alias("check_name"), F.struct("*").alias(name)) for name, rows in checks.items()],
    )
    kept = stored(found, "findings", "check_name")
    return {name: kept.filter(F.col("check_name") == name).select(f"{name}.*") for name in checks}


def summary_scan(summary: DataFrame, period: str | Period | None = None) -> Scan:
    """All checks on the stored monthly summary. Missing months need more than one month in scope."""
    scope = as_period(period)
    gathered = summary_checks.by_meter(summary)
    several = scope is not None and scope.is_multi_month
    checks = {
        "negative_consumption": summary_checks.negative_consumption(summary, scope),
        "zero_consumption_summary": summary_checks.zero_consumption(summary, scope),
        "late_opening": summary_checks.late_opening(summary, scope),
        "early_closing": summary_checks.early_closing(summary, scope),
        "continuity_breaks": summary_checks.continuity_breaks(gathered, scope),
        "outlier_consumption": summary_checks.outlier_consumption(gathered, scope),
        "cross_utility_mismatch": summary_checks.cross_utility_mismatch(summary, scope),
    }
    listed: dict[str, DataFrame | None] = {**checks, "missing_months": None}
    if scope is None or several:
        listed["missing_months"] = summary_checks.missing_months(summary, scope)
        checks["missing_months"] = listed["missing_months"]
    repeats = None
    if several:
        repeats = offenders.labelled_union(
            {
                name: offenders.repeat_offenders(rows, F.col("year_month"))
                for name, rows in checks.items()
            }
        )
    stats = summary_checks.scan_stats(summary, scope)
    return Scan(stats, checks, offenders.scan_report(listed), repeats)


def detect_summary_discrepancies(
    tables: MeterTables, period: str | Period | None = None
) -> Scan:
    """Check the stored monthly summary and record the findings."""
    scope = as_period(period)
    summary = tables.monthly_summary
    tables.upsert_findings(findings.summary_findings(summary, scope), scope)
    return summary_scan(summary, scope)


def check_cross_utility(summary: DataFrame, period: str | Period | None = None) -> Scan:
    scope = as_period(period)
    checks = {
        "presence_patterns": coverage.presence_patterns(summary, scope),
        "flat_utilities": coverage.flat_utilities(summary, scope),
        "incomplete_coverage": coverage.incomplete_coverage(summary, scope),
        "zero_profiles": coverage.zero_profiles(summary, scope),
        "zero_profile_patterns": coverage.zero_profile_patterns(summary, scope),
    }
    return Scan(
        summary_checks.scan_stats(summary, scope), checks, coverage.coverage_summary(summary, scope)
    )


def show_discrepancies(
    tables: MeterTables,
    period: str | Period | None = None,
    check_name: str | None = None,
    severity: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Recorded findings and their number per check."""
    wanted = (tables.monthly_discrepancy, as_period(period), check_name, severity)
    return findings.discrepancy_report(*wanted), findings.discrepancy_counts(*wanted)


def detect_ingestion_issues(
    readings: DataFrame,
    log: DataFrame,
    year_month: str,
    expected_files: int = intake_checks.EXPECTED_FILES_PER_DAY,
) -> Scan:
    scoped = readings_in(readings, single_month(year_month))
    checks = {
        "file_completeness": intake_checks.file_completeness(scoped, expected_files),
        "row_count_anomalies": intake_checks.row_count_anomalies(scoped),
        "ingestion_log": intake_checks.ingestion_log_listing(log),
    }
    report = offenders.scan_report(checks, informational=("ingestion_log",))
    return Scan(intake_checks.scan_stats(scoped), checks, report)


# -- jobs that write -------------------------------------------------------------------


def ingest_sheets(tables: MeterTables, sheet_rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Load the sheets of a run: rows, log entries, and the outcome of every file.

    The numbered rows are written to the shared folder once, their time cells as a column of
    their own; the long cells, which verdicts and records come from, once more. Only stored
    readings of the batch's months and hours are compared with it. If another run stores readings
    meanwhile, the comparison is made again. The outcome tells how many rows had no time or
    repeated one, and how many records were there already (`skipped`).
    """
    rows = with_time_cell(sheet_rows.select("source_file", "row_idx", "cells"))
    sheets = Sheets(stored(rows, "sheets"))
    cells = stored(sheets.cells(), "cells")
    outcomes = intake.file_outcomes(hashes, contents_of(cells), tables.ingestion_log).checkpoint()
    taken = intake.ingested_files(outcomes).select("source_file")
    records = records_of(cells.join(taken, "source_file", "left_semi"))
    month = month_of(F.col("recorded_at")).alias("month")
    spans = records.groupBy(month).agg(F.min("recorded_at").alias("lo"), F.max("recorded_at").alias("hi")).collect()

    def fresh(existing: DataFrame) -> DataFrame:
        near = [F.col("recorded_at").between(F.lit(span.lo), F.lit(span.hi)) for span in spans]
        known = existing.filter(reduce(Column.__or__, near, F.lit(False)))
        return insert_if_absent(known, records, READING_KEY, SHEET_POSITION)

    written = tables.insert_readings(fresh, [span.month for span in spans])
    inserted = written.groupBy("source_file").agg(F.count(F.lit(1)).alias("inserted"))
    tables.append_log(intake.log_entries(outcomes, inserted))
    new = F.coalesce("inserted", F.lit(0)).cast("bigint")
    loaded = F.col("outcome").isin(intake.INGESTED, intake.LOG_CONFLICT)
    return (
        outcomes.join(inserted, "source_file", "left")
        .join(sheets.dropped_rows(), "source_file", "left")
        .select(
            "source_file", "outcome", "records", new.alias("inserted"),
            F.when(loaded, F.col("records") - new).otherwise(0).alias("skipped"),
            F.coalesce("untimed_rows", F.lit(0)).cast("bigint").alias("untimed_rows"),
            F.coalesce("repeated_rows", F.lit(0)).cast("bigint").alias("repeated_rows"),
        )
    )


def ingest_directory(tables: MeterTables, directory: str, name_glob: str = files.CSV_GLOB):
    """Load a directory of sheets exported as delimited text."""
    read = files.delimited_files(tables.spark, directory, name_glob)
    return ingest_sheets(tables, files.sheet_rows(read), read.files)


def summarize(tables: MeterTables, year_month: str) -> DataFrame:
    """Compute and store a month's summary; rows of meters without readings are kept."""
    month = single_month(year_month)
    tables.upsert_summary(summaries.monthly_summary(tables.readings, month), month)
    return summaries.show_monthly_summary(tables.monthly_summary, month)


class NotSummarized(ValueError):
    """The month has no summary yet, so its readings must not be purged."""


def archive_month(tables: MeterTables, year_month: str, archive_dir: str) -> str | None:
    """Write a month's readings to Parquet, verify it, then purge the month.

    All steps work on one snapshot, and only its folders are purged: readings that come in
    meanwhile stay stored. Returns the path, or None if the month has no readings.
    """
    month = single_month(year_month)
    if tables.table("monthly_summary").read(months=[month.start]).isEmpty():
        raise NotSummarized(f"No monthly summary for {month.start}; compute it first")
    table = tables.table("readings")
    snapshot = table.snapshot()
    scoped = table.read(snapshot, [month.start])
    expected = scoped.count()
    if expected == 0:
        return None
    path = archive.free_path(tables.spark, archive_dir, month.start)
    archive.write_archive(scoped, path)
    written = archive.read_archive(tables.spark, path)
    if (count := written.count()) != expected:
        raise RuntimeError(f"{path} has {count} rows instead of {expected}; nothing purged")
    if not scoped.join(written, READING_KEY, "left_anti").isEmpty():
        raise RuntimeError(f"{month.start} has readings that {path} lacks; nothing purged")
    table.remove(month.start, snapshot)
    return path


def reload_archive(tables: MeterTables, path: str) -> int:
    """Append an archive; refuse it if a key is already stored or occurs twice."""
    archived = archive.read_archive(tables.spark, path)
    months = [
        row.month
        for row in archived.select(month_of(F.col("recorded_at")).alias("month"))
        .distinct()
        .collect()
    ]

    def checked(existing: DataFrame) -> DataFrame:
        if not archive.conflicting_keys(existing, archived).isEmpty():
            raise ValueError(f"{path} holds readings that are already stored")
        return archived

    return tables.insert_readings(checked, months).count()


def write_daily_records(
    spark: SparkSession, directory: str, path: str, name_glob: str = files.CSV_GLOB
) -> DataFrame:
    """Daily opening and closing values of all sheets of a directory as CSV.

    Returns the files left out because of their names or damage, with the reason.
    """
    read = files.delimited_files(spark, directory, name_glob)
    daily.write_daily_csv(daily.daily_open_close(files.sheet_rows(read)), path)
    return daily.unusable_files(read.files)


def maintain(tables: MeterTables, keep: int = 10, older_than_hours: float = 24.0) -> dict[str, int]:
    """Compact months of many folders, remove old snapshots and intermediate folders nobody needs.

    Gives the number of folders removed, per table and of the shared folder.
    """
    tables.compact()
    removed = tables.expire(keep, older_than_hours)
    return {**removed, "intermediate": expire_folders(tables.spark, older_than_hours)}


def look_up(
    tables: MeterTables, given_flat_id: str, start: str, end: str, utility_type: str | None = None
) -> DataFrame:
    """A flat's stored readings from start to end (dates, both included)."""
    return summaries.flat_readings(tables.readings, given_flat_id, start, end, utility_type)


def table_stats(tables: MeterTables) -> DataFrame:
    return summaries.table_stats(
        tables.readings, tables.monthly_summary, tables.monthly_discrepancy, tables.ingestion_log
    )
