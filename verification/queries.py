"""Registered queries: every operator on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import cells
from gaugeflow.functions.period import Period, month_of, parse_period, readings_in, summary_in
from gaugeflow.operators import (
    coverage, daily, findings, granular, intake, intake_checks, merge, offenders, sheets,
    summary_checks,
)
from gaugeflow.operators import summary as summaries
from gaugeflow.operators.slices import SlicePolicy
from gaugeflow.plans import jobs
from gaugeflow.schemas import READING_COLUMNS, READING_KEY
from gaugeflow.sources import archive, files
from gaugeflow.sources.tables import MeterTables
from gaugeflow.sources.workspace import new_folder, stored
from verification import bindings as bind

Query = Callable[[SparkSession, str], DataFrame]

JANUARY = Period("2024-01", "2024-01")
QUARTER = Period("1996-01", "1996-03")
YEAR = Period("1996-01", "1996-12")
ALL_YEARS = Period("1995-01", "2001-12")
CLOSE_SLICES = SlicePolicy(min_rows=100)
PERIODS = [
    "1996-08", "1996_01:1996.06", "1996", "1996-H1", "1996-h2", "1996-Q1", "1996/q4", "1996-13",
    "1996-06:1996-01", "1996-00:1996-13",
]
FIRST_ROWS = ["source_file", "row_idx", "col_idx"]


def _joined(df: DataFrame) -> DataFrame:
    """Lists as text, so that results compare across engines."""
    lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.withColumns({name: F.array_join(name, ",") for name in lists})


def _r1(spark, sf_dir):
    return readings_in(bind.event_readings(spark, sf_dir), JANUARY)


def _on_r1(check) -> Query:
    return lambda spark, sf_dir: check(_r1(spark, sf_dir))


def _on_r2(check) -> Query:
    return lambda spark, sf_dir: check(
        readings_in(bind.shipment_readings(spark, sf_dir), ALL_YEARS)
    )


def _lagged_r1(check) -> Query:
    return lambda spark, sf_dir: check(granular.Readings(_r1(spark, sf_dir)))


def _sliced_r1(check) -> Query:
    return lambda spark, sf_dir: check(
        granular.Readings(bind.event_readings(spark, sf_dir, skewed=True), CLOSE_SLICES)
    )


def _on_summary(check, period: Period | None = None, with_gaps: bool = False) -> Query:
    return lambda spark, sf_dir: _joined(
        check(bind.summary(spark, sf_dir, with_gaps=with_gaps), period)
    )


# -- sheets ----------------------------------------------------------------------------


def _sheets(spark, sf_dir):
    return sheets.Sheets(bind.stored_sheet_rows(spark, sf_dir))


def discover_files(spark, sf_dir):
    suffix = F.element_at(
        F.array(*map(F.lit, ["readings.xls", "Readings.xlsx", "readings.csv", "READINGS.xls"])),
        (F.col("event_id") % 4 + 1).cast("int"),
    )
    name = F.regexp_replace(bind.sheet_name(), "readings.xls$", "")
    paths = bind.table(spark, sf_dir, "events").select(
        F.concat(F.lit("/in/"), name, suffix).alias("path")
    )
    return intake.discover_files(paths)


def parse_filename(spark, sf_dir):
    lower = F.when(F.col("event_id") % 3 == 0, F.lower(bind.sheet_name()))
    upper = F.when(
        F.col("event_id") % 3 == 1, F.regexp_replace(bind.sheet_name(), " readings", " Readings")
    )
    names = bind.table(spark, sf_dir, "events").select(
        F.regexp_replace(F.coalesce(lower, upper, bind.sheet_name()), "^t ", "T ").alias(
            "source_file"
        )
    )
    return sheets.parse_filenames(names.distinct())


def _outcomes(rows, parsed):
    files = bind.run_files(rows)
    return intake.file_outcomes(files, parsed.contents(), bind.run_log(files))


def skip_seen_files(spark, sf_dir):
    rows = bind.stored_sheet_rows(spark, sf_dir)
    return _outcomes(rows, sheets.Sheets(rows)).select("source_file", "file_hash", "outcome")


def sheet_unpivot(spark, sf_dir):
    return _sheets(spark, sf_dir).records()


def normalize_flat_id(spark, sf_dir):
    columns = _sheets(spark, sf_dir).columns
    return columns.select("source_file", "tower_name", "utility_type", F.inline("flats"))


def raw_flat_id(spark, sf_dir):
    columns = sheets.sheet_columns(bind.sheet_rows(spark, sf_dir), strip_tower_letter=False)
    return columns.select("source_file", "tower_name", F.inline("flats"))


def parse_reading_time(spark, sf_dir):
    return bind.sheet_cells(spark, sf_dir, bind.READING_TIMES).select(
        "event_id", cells.parse_reading_time(cells.present(F.col("c0"))).alias("recorded_at")
    )


def parse_time_24h(spark, sf_dir):
    return bind.sheet_cells(spark, sf_dir, bind.DAILY_TIMES).select(
        "event_id", cells.parse_time_24h(cells.present(F.col("c0"))).alias("recorded_at")
    )


def drop_repeat_timestamps(spark, sf_dir):
    kept = _sheets(spark, sf_dir).kept.rows
    return kept.select("source_file", "row_idx", "recorded_at")


def drop_repeat_timestamps_sliced(spark, sf_dir):
    rows = bind.stored_sheet_rows(spark, sf_dir)
    kept = sheets.drop_repeated_times(rows, policy=SlicePolicy(min_rows=20)).rows
    return kept.select("source_file", "row_idx", "recorded_at")


def dropped_rows(spark, sf_dir):
    return _sheets(spark, sf_dir).dropped_rows()


def coerce_readings(spark, sf_dir):
    return _sheets(spark, sf_dir).contents()


def insert_if_absent(spark, sf_dir):
    records = _sheets(spark, sf_dir).records()
    fresh = merge.insert_if_absent(
        bind.stored_readings(records), records, READING_KEY, FIRST_ROWS
    )
    return fresh.drop("row_idx", "col_idx")


def _tables(spark) -> MeterTables:
    return MeterTables(spark, root=new_folder(spark, "tables"))


def _ingested(spark, sf_dir):
    """The tables after the ingestion job, and what it says of every file."""
    rows, tables = bind.stored_sheet_rows(spark, sf_dir), _tables(spark)
    tables.append_readings(bind.stored_readings(sheets.Sheets(rows).records()))
    files = bind.run_files(rows)
    earlier = bind.run_log(files)
    unknown = {"ingested_at": F.lit(None).cast("timestamp_ntz"), "record_count": F.lit(None).cast("int")}
    tables.append_log(earlier.withColumns(unknown))
    return tables, jobs.ingest_sheets(tables, rows, files)


def ingestion_log_append(spark, sf_dir):
    tables, _ = _ingested(spark, sf_dir)
    return tables.ingestion_log.filter(F.col("ingested_at").isNotNull()).drop("ingested_at")


def ingest_directory(spark, sf_dir):
    return _ingested(spark, sf_dir)[1].select("source_file", "outcome", "records", "inserted")


def ingested_readings(spark, sf_dir):
    """All readings that are stored after the job."""
    return _ingested(spark, sf_dir)[0].readings.select(*READING_COLUMNS)


def quoted_sheet_cells(spark, sf_dir):
    """Events written as delimited text with quotes, quoted delimiters and line breaks, and read back."""
    def quoted(cell):
        return F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))

    broken = F.concat("event_type", F.lit(',\n"'), "props")
    cells = [F.col("event_id").cast("string"), quoted(F.col("props")), quoted(broken), F.concat("event_type", F.lit(' 5"'))]
    folder = new_folder(spark, "quoted")
    bind.table(spark, sf_dir, "events").select(F.concat_ws(",", *cells)).write.text(folder)
    read = files.delimited_files(spark, folder, "part-*").rows()
    names = ["event_id", "props", "broken", "inches"]
    picked = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    return read.select(*picked, F.size("cells").alias("width")).withColumn("event_id", F.col("event_id").cast("bigint"))


def daily_open_close(spark, sf_dir):
    return daily.daily_open_close(bind.sheet_rows(spark, sf_dir, bind.DAILY_TIMES))


def write_daily_csv(spark, sf_dir):
    path = new_folder(spark, "daily")
    daily.write_daily_csv(daily_open_close(spark, sf_dir), path)
    return spark.read.csv(path, header=True)


# -- archive ---------------------------------------------------------------------------


def archive_month(spark, sf_dir):
    path = new_folder(spark, "archive")
    archive.write_archive(_r1(spark, sf_dir), path)
    return archive.read_archive(spark, path)


def reload_parquet(spark, sf_dir):
    """A month is archived and purged, then read back: all readings are there again."""
    readings = bind.shipment_readings(spark, sf_dir).withColumns(
        {"tower_name": F.lit("S"), "flat_id": F.col("given_flat_id")}
    ).select(*READING_COLUMNS)
    month = Period("1996-05", "1996-05")
    path = new_folder(spark, "archive")
    archive.write_archive(readings_in(readings, month), path)
    archived = archive.read_archive(spark, path)
    kept = readings.filter(~month.of_time(F.col("recorded_at")))
    if not archive.conflicting_keys(kept, archived).isEmpty():
        raise ValueError("archived readings are still stored")
    return kept.unionByName(archived)


def reload_conflicts(spark, sf_dir):
    """Keys that forbid a reload while the first three days are still stored."""
    archived = bind.event_readings(spark, sf_dir)
    stored = archived.filter(F.dayofmonth("recorded_at") <= 3)
    return archive.conflicting_keys(stored, archived)


# -- summary ---------------------------------------------------------------------------


def _stored_shipments(spark, sf_dir) -> MeterTables:
    tables = _tables(spark)
    tables.append_readings(bind.shipment_readings(spark, sf_dir).withColumns(
        {"tower_name": F.lit("S"), "flat_id": F.col("given_flat_id")}))
    return tables


def archived_month(spark, sf_dir):
    """Where the readings are after a month was summarised and archived by the jobs."""
    tables = _stored_shipments(spark, sf_dir)
    jobs.summarize(tables, "1996-05")
    path = jobs.archive_month(tables, "1996-05", new_folder(spark, "archive"))
    left = tables.readings.select(*READING_COLUMNS, F.lit("stored").alias("place"))
    return left.unionByName(archive.read_archive(spark, path).withColumn("place", F.lit("archived")))


def summarized_month(spark, sf_dir):
    """A month's stored summary after the job ran twice."""
    tables = _stored_shipments(spark, sf_dir)
    jobs.summarize(tables, "1996-05")
    return jobs.summarize(tables, "1996-05").drop("computed_at")


def detected_discrepancies(spark, sf_dir):
    """The findings that the job records from the stored summary."""
    tables = _tables(spark)
    tables.upsert_summary(bind.summary(spark, sf_dir))
    jobs.detect_summary_discrepancies(tables)
    return tables.monthly_discrepancy.drop("detected_at")


def summary_upsert(spark, sf_dir):
    """Summary of the A and N readings, on which the summary of 1996 is recomputed."""
    readings = bind.shipment_readings(spark, sf_dir)
    stored = summaries.monthly_summary(readings.filter(F.col("utility_type") != "R"))
    doubled = readings.withColumn("reading_value", F.col("reading_value") * 2)
    fresh = summaries.monthly_summary(doubled, YEAR)
    tables = _tables(spark)
    tables.upsert_summary(stored)
    tables.upsert_summary(fresh, YEAR)
    return tables.monthly_summary.drop("computed_at")


def show_monthly_summary(spark, sf_dir):
    return summaries.show_monthly_summary(
        bind.summary(spark, sf_dir), Period("1996-05", "1996-05")
    )


def flat_readings(spark, sf_dir):
    return summaries.flat_readings(
        bind.event_readings(spark, sf_dir), "F7", "2024-01-05", "2024-01-20", "click"
    )


def flat_readings_all_utilities(spark, sf_dir):
    return summaries.flat_readings(
        bind.shipment_readings(spark, sf_dir), "S3", "1996-02-01", "1997-01-31"
    )


def db_stats(spark, sf_dir):
    summary = bind.stored_summary(spark, sf_dir)
    return summaries.table_stats(
        bind.event_readings(spark, sf_dir), summary,
        findings.summary_findings(summary), bind.ingestion_log(spark, sf_dir),
    )


def period_filter(spark, sf_dir):
    """Readings per month for every form of the grammar, selected by time range."""
    readings = bind.shipment_readings(spark, sf_dir)
    per_period = {
        text: readings_in(readings, parse_period(text))
        .groupBy(month_of(F.col("recorded_at")).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
        for text in PERIODS
    }
    return offenders.labelled_union(per_period).withColumnRenamed("check_name", "period")


def month_filter(spark, sf_dir):
    """Summary rows per month for every form of the grammar, selected by month text."""
    summary = bind.summary(spark, sf_dir)
    per_period = {
        parse_period(text).label: summary_in(summary, parse_period(text))
        .groupBy("year_month")
        .agg(F.count(F.lit(1)).alias("n"))
        for text in PERIODS
    }
    return offenders.labelled_union(per_period).withColumnRenamed("check_name", "label")


# -- reports ---------------------------------------------------------------------------


def repeat_offenders(spark, sf_dir):
    readings = stored(bind.shipment_readings(spark, sf_dir), "readings")
    return jobs.detect_discrepancies(readings, ALL_YEARS).repeat_offenders


def repeat_offenders_with_nulls(spark, sf_dir):
    """The readings of every ninth day of a month are missing."""
    missing = F.dayofmonth("recorded_at") % 9 == 0
    readings = bind.shipment_readings(spark, sf_dir).withColumn(
        "reading_value", F.when(~missing, F.col("reading_value"))
    )
    return jobs.detect_discrepancies(stored(readings, "readings"), ALL_YEARS).repeat_offenders


def granular_scan_report(spark, sf_dir):
    return jobs.detect_discrepancies(bind.event_readings(spark, sf_dir), "2024-01").report


def summary_repeat_offenders(spark, sf_dir):
    return jobs.summary_scan(bind.stored_summary(spark, sf_dir), YEAR).repeat_offenders


def summary_scan_report(spark, sf_dir):
    return jobs.summary_scan(bind.stored_summary(spark, sf_dir), "1996-05").report


def record_discrepancies(spark, sf_dir):
    """Findings of the first half of 1996, recorded over those of all months but March."""
    summary = bind.stored_summary(spark, sf_dir)
    found = findings.summary_findings(summary)
    earlier = found.filter(F.col("year_month") != "1996-03").withColumn("remark", F.lit("old"))
    fresh = findings.summary_findings(summary, parse_period("1996-H1"))
    tables = _tables(spark)
    tables.upsert_findings(earlier)
    tables.upsert_findings(fresh, parse_period("1996-H1"))
    return tables.monthly_discrepancy.drop("detected_at")


def discrepancy_report(spark, sf_dir):
    return findings.discrepancy_report(
        bind.discrepancies(spark, sf_dir), YEAR, severity=findings.ERROR
    )


def discrepancy_counts(spark, sf_dir):
    return findings.discrepancy_counts(bind.discrepancies(spark, sf_dir))


def ingestion_scan_report(spark, sf_dir):
    return jobs.detect_ingestion_issues(
        bind.event_readings(spark, sf_dir), bind.ingestion_log(spark, sf_dir), "2024-01", 70
    ).report


def ingestion_log_listing(spark, sf_dir):
    return intake_checks.ingestion_log_listing(bind.ingestion_log(spark, sf_dir))


def _shipments(spark, sf_dir, **kwargs):
    readings = bind.shipment_readings(spark, sf_dir, skewed="policy" in kwargs)
    lines = bind.shipment_lines(spark, sf_dir, skewed="policy" in kwargs)
    return granular.Readings(readings, measured=lines, **kwargs)


def stale_runs(spark, sf_dir):
    return granular.stale_runs(_shipments(spark, sf_dir))


def stale_runs_skewed(spark, sf_dir):
    return granular.stale_runs(_shipments(spark, sf_dir, policy=CLOSE_SLICES))


QUERIES: dict[str, Query] = {
    # sources, ingestion, sinks
    "discover_files": discover_files,
    "parse_filename": parse_filename,
    "skip_seen_files": skip_seen_files,
    "sheet_unpivot": sheet_unpivot,
    "normalize_flat_id": normalize_flat_id,
    "parse_reading_time": parse_reading_time,
    "drop_repeat_timestamps": drop_repeat_timestamps,
    "drop_repeat_timestamps_sliced": drop_repeat_timestamps_sliced,
    "dropped_rows": dropped_rows,
    "coerce_readings": coerce_readings,
    "insert_if_absent": insert_if_absent,
    "ingestion_log_append": ingestion_log_append,
    "ingest_directory": ingest_directory,
    "ingested_readings": ingested_readings,
    "quoted_sheet_cells": quoted_sheet_cells,
    "reload_parquet": reload_parquet,
    "reload_conflicts": reload_conflicts,
    "archive_month": archive_month,
    "archived_month": archived_month,
    "daily_open_close": daily_open_close,
    "parse_time_24h": parse_time_24h,
    "raw_flat_id": raw_flat_id,
    "write_daily_csv": write_daily_csv,
    # summary, look-up, statistics
    "monthly_summary": lambda spark, sf_dir: bind.summary(spark, sf_dir),
    "summary_upsert": summary_upsert,
    "summarized_month": summarized_month,
    "show_monthly_summary": show_monthly_summary,
    "flat_readings": flat_readings,
    "flat_readings_all_utilities": flat_readings_all_utilities,
    "db_stats": db_stats,
    # periods
    "period_filter": period_filter,
    "month_filter": month_filter,
    # checks on readings
    "scan_stats": _on_r2(granular.scan_stats),
    "backward_readings": _lagged_r1(granular.backward_readings),
    "zero_consumption_granular": _on_r2(granular.zero_consumption),
    "gap_detection": _on_r1(granular.gap_detection),
    "spike_detection": _lagged_r1(granular.spike_detection),
    "stale_runs": stale_runs,
    "null_readings": _on_r1(granular.null_readings),
    "repeat_offenders": repeat_offenders,
    "repeat_offenders_with_nulls": repeat_offenders_with_nulls,
    "granular_scan_report": granular_scan_report,
    # the same with one meter holding a third of the rows, cut into many slices
    "backward_readings_skewed": _sliced_r1(granular.backward_readings),
    "spike_detection_skewed": _sliced_r1(granular.spike_detection),
    "stale_runs_skewed": stale_runs_skewed,
    # checks on the summary
    "summary_scan_stats": _on_summary(summary_checks.scan_stats),
    "negative_consumption": _on_summary(summary_checks.negative_consumption),
    "zero_consumption_summary": _on_summary(summary_checks.zero_consumption),
    "late_opening": _on_summary(summary_checks.late_opening),
    "early_closing": _on_summary(summary_checks.early_closing),
    "continuity_breaks": _on_summary(summary_checks.continuity_breaks),
    "continuity_breaks_in_period": _on_summary(summary_checks.continuity_breaks, QUARTER),
    "outlier_consumption": _on_summary(summary_checks.outlier_consumption),
    "outlier_consumption_in_period": _on_summary(summary_checks.outlier_consumption, YEAR),
    "cross_utility_mismatch": _on_summary(summary_checks.cross_utility_mismatch),
    "missing_months": _on_summary(summary_checks.missing_months, with_gaps=True),
    "summary_repeat_offenders": summary_repeat_offenders,
    "record_discrepancies": record_discrepancies,
    "detected_discrepancies": detected_discrepancies,
    "summary_scan_report": summary_scan_report,
    # coverage
    "utilities_in_scope": _on_summary(coverage.utilities_in_scope, QUARTER),
    "presence_patterns": _on_summary(coverage.presence_patterns, with_gaps=True),
    "presence_pattern_flats": _on_summary(coverage.flat_utilities, Period("1996-01", "1996-01")),
    "incomplete_coverage": _on_summary(coverage.incomplete_coverage, with_gaps=True),
    "zero_profiles": _on_summary(coverage.zero_profiles, QUARTER),
    "zero_profile_patterns": _on_summary(coverage.zero_profile_patterns, QUARTER),
    "coverage_summary": _on_summary(coverage.coverage_summary, QUARTER),
    "utilities_in_all_months": _on_summary(coverage.utilities_in_scope),
    "zero_profiles_all_months": _on_summary(coverage.zero_profiles),
    "zero_profile_patterns_all_months": _on_summary(coverage.zero_profile_patterns),
    "coverage_summary_all_months": _on_summary(coverage.coverage_summary),
    "presence_pattern_flats_all_months": _on_summary(coverage.flat_utilities),
    # recorded findings, ingestion checks
    "discrepancy_report": discrepancy_report,
    "discrepancy_counts": discrepancy_counts,
    "ingestion_scan_stats": _on_r1(intake_checks.scan_stats),
    "file_completeness": _on_r1(lambda scoped: intake_checks.file_completeness(scoped, 70)),
    "row_count_anomalies": _on_r1(intake_checks.row_count_anomalies),
    "ingestion_log_listing": ingestion_log_listing,
    "ingestion_scan_report": ingestion_scan_report,
}
