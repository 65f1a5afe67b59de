"""Work and memory of a task that must not grow with the input."""

import re

from pyspark.sql import functions as F

from gaugeflow.operators import findings, granular, summary_checks
from gaugeflow.sources import workspace
from gaugeflow.sources.snapshots import SnapshotTable
from gaugeflow.sources.tables import MeterTables
from tests.helpers import summary, values
from tests.test_queries import SMALL, exchanges, plan
from verification import bindings as bind
from verification.queries import QUERIES


def test_tasks_follow_the_number_of_rows(spark):
    rows = spark.range(100_000)
    assert workspace.tasks_for(rows, 1000) == 100
    assert workspace.tasks_for(rows, 1_000_000) == spark.sparkContext.defaultParallelism


def test_shipments_are_shuffled_once_into_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(bind, "ROWS_PER_TASK", 100)
    lines = bind.table(spark, SMALL, "lineitem").count()
    for name in ("monthly_summary", "scan_stats"):
        found = exchanges(plan(QUERIES[name](spark, SMALL)))
        assert [e for e in found if e.endswith(f", {-(-lines // 100)}")] and "recorded_at" not in "".join(found)


def test_findings_take_the_summary_from_storage(spark):
    for name in ("discrepancy_counts", "discrepancy_report", "db_stats", "summary_scan_report"):
        assert "l_suppkey" not in plan(QUERIES[name](spark, SMALL))


def test_checks_along_meters_get_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(summary_checks, "MONTHS_PER_TASK", 10)
    stored = bind.stored_summary(spark, SMALL)
    tasks = -(-stored.count() // 10)
    text = plan(findings.summary_findings(stored))
    gathered = [e for e in exchanges(text) if re.fullmatch(rf"given_flat_id#\d+, utility_type#\d+, {tasks}", e)]
    assert len(gathered) >= 2


def test_an_upsert_writes_new_rows_once_and_keeps_the_others(spark, monkeypatch):
    tables, written = MeterTables(spark, root=workspace.new_folder(spark, "tables")), []
    write = SnapshotTable.write

    def counted(self, rows):
        written.append(rows.count())
        return write(self, rows)

    monkeypatch.setattr(SnapshotTable, "write", counted)
    old = summary(spark, [("Gas", f"F{i}", month, 1, 2) for i in range(3) for month in ("2025-01", "2025-02")])
    tables.upsert_summary(old)
    assert written == [6]
    new = summary(spark, [("Gas", "F0", "2025-02", 1, 9), ("Gas", "F9", "2025-03", 1, 9)])
    tables.upsert_summary(new)
    assert written == [6, 2, 2]
    found = values(tables.monthly_summary, "given_flat_id", "year_month", "closing_reading")
    assert found == sorted(
        [(f"F{i}", "2025-01", 2.0) for i in range(3)] + [("F1", "2025-02", 2.0), ("F2", "2025-02", 2.0)]
        + [("F0", "2025-02", 9.0), ("F9", "2025-03", 9.0)])
    tables.upsert_summary(new)
    assert values(tables.monthly_summary.groupBy("year_month").agg(F.count("*").alias("n")), "year_month", "n") == [
        ("2025-01", 3), ("2025-02", 3), ("2025-03", 1)]


def test_ordered_checks_of_a_scan_get_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(granular, "ROWS_PER_TASK", 100)
    readings = workspace.stored(bind.shipment_readings(spark, SMALL), "readings")
    days = workspace.stored(granular.day_states(readings), "days")
    found = exchanges(plan(granular.spike_detection(granular.Readings(readings, days=days))))
    assert [e for e in found if e.endswith(f", {-(-readings.count() // 100)}")] == found


def test_sheet_rows_are_put_together_once(spark):
    for name in ("drop_repeat_timestamps_sliced", "dropped_rows", "sheet_unpivot", "skip_seen_files"):
        assert "posexplode" not in plan(QUERIES[name](spark, SMALL))
    for name in ("repeat_offenders", "repeat_offenders_with_nulls"):
        assert "l_suppkey" not in plan(QUERIES[name](spark, SMALL))
