"""Time the headline queries and print one JSON line.

"queries" are the registered queries: every view is recomputed from the driver's Parquet
files. "stored_tables" are the same checks on the project's own tables (readings and
monthly summary written once beforehand, not timed), which is how they are used.
"jobs" are whole jobs: sheets to stored readings, daily values, a scan with its report, a
month summarised and archived. One run each, results consumed by a no-op sink, after one small
job that starts the JVM.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from gaugeflow.functions.period import Period
from gaugeflow.operators import coverage, granular, intake_checks, summary_checks
from gaugeflow.operators.summary import monthly_summary
from gaugeflow.session import build_session
from gaugeflow.sources.tables import MeterTables
from verification import bindings as bind
from verification.queries import JANUARY, QUARTER, QUERIES

HEADLINE = [
    "backward_readings", "zero_consumption_granular", "gap_detection", "spike_detection",
    "stale_runs", "null_readings", "monthly_summary", "negative_consumption",
    "zero_consumption_summary", "late_opening", "early_closing", "continuity_breaks",
    "outlier_consumption", "cross_utility_mismatch", "missing_months", "incomplete_coverage",
    "zero_profiles", "presence_pattern_flats", "file_completeness", "row_count_anomalies",
]


JOBS = ["ingested_readings", "quoted_sheet_cells", "daily_open_close", "granular_scan_report", "archived_month"]


def stored_checks(spark, sf_dir: str) -> dict:
    """Write the three relations as tables and return the checks on them."""
    def stored(name: str, readings) -> MeterTables:
        tables = MeterTables(spark, name).create()
        tables.append_readings(
            readings.withColumns({"tower_name": F.lit("T"), "flat_id": F.col("given_flat_id")})
        )
        return tables

    events = stored("bench_events", bind.event_readings(spark, sf_dir))
    shipments = stored("bench_shipments", bind.shipment_readings(spark, sf_dir))
    shipments.upsert_summary(monthly_summary(shipments.readings))
    month = events.readings.filter(JANUARY.of_month(F.col("year_month")))
    summary = shipments.monthly_summary
    january = Period("1996-01", "1996-01")
    return {
        "backward_readings": lambda: granular.backward_readings(granular.Readings(month)),
        "zero_consumption_granular": lambda: granular.zero_consumption(shipments.readings),
        "gap_detection": lambda: granular.gap_detection(month),
        "spike_detection": lambda: granular.spike_detection(granular.Readings(month)),
        "stale_runs": lambda: granular.stale_runs(granular.Readings(shipments.readings)),
        "null_readings": lambda: granular.null_readings(month),
        "monthly_summary": lambda: monthly_summary(shipments.readings),
        "negative_consumption": lambda: summary_checks.negative_consumption(summary),
        "zero_consumption_summary": lambda: summary_checks.zero_consumption(summary),
        "late_opening": lambda: summary_checks.late_opening(summary),
        "early_closing": lambda: summary_checks.early_closing(summary),
        "continuity_breaks": lambda: summary_checks.continuity_breaks(summary),
        "outlier_consumption": lambda: summary_checks.outlier_consumption(summary),
        "cross_utility_mismatch": lambda: summary_checks.cross_utility_mismatch(summary),
        "missing_months": lambda: summary_checks.missing_months(summary),
        "incomplete_coverage": lambda: coverage.incomplete_coverage(summary),
        "zero_profiles": lambda: coverage.zero_profiles(summary, QUARTER),
        "presence_pattern_flats": lambda: coverage.flat_utilities(summary, january),
        "file_completeness": lambda: intake_checks.file_completeness(month, 70),
        "row_count_anomalies": lambda: intake_checks.row_count_anomalies(month),
    }


def timed(declare) -> float:
    started = time.perf_counter()
    declare().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    queries = {name: timed(lambda: QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    stored = {name: timed(check) for name, check in stored_checks(spark, sf_dir).items()}
    whole = {name: timed(lambda: QUERIES[name](spark, sf_dir)) for name in JOBS}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries from the driver's files, one run each",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "stored_tables_total": round(sum(stored.values()), 3),
        "stored_tables": stored,
        "jobs": whole,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
