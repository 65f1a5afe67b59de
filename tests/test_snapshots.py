"""Snapshots: all months at once, writers at the same time, expiry and compaction."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from gaugeflow.plans import jobs
from gaugeflow.sources.snapshots import Conflict, Snapshot, SnapshotTable, Storage
from gaugeflow.sources.tables import MeterTables
from gaugeflow.sources.workspace import new_folder
from tests.helpers import readings, summary, values

ROWS = "given_flat_id STRING NOT NULL, n INT"


@pytest.fixture
def table(spark):
    return SnapshotTable(spark, new_folder(spark, "table"), ROWS, ["given_flat_id"])


def rows(spark, *given):
    return spark.createDataFrame(given, f"{ROWS}, year_month string")


def test_snapshots_are_read_whole_and_earlier_ones_stay(spark, table):
    assert table.read().count() == 0 and table.snapshot() == Snapshot()
    table.append(rows(spark, ("a", 1, "2025-01"), ("b", 2, "2025-02")))
    table.append(rows(spark, ("c", 3, "2025-02"), ("d", 4, None)))
    assert values(table.read(), "given_flat_id", "year_month") == [
        ("a", "2025-01"), ("b", "2025-02"), ("c", "2025-02"), ("d", None)]
    assert values(table.read(months=["2025-02"]), "n") == [(2,), (3,)]
    assert values(table.read(table.snapshot(1)), "n") == [(1,), (2,)]
    plan = table.read().filter("year_month = '2025-01'")._jdf.queryExecution().executedPlan().toString()
    assert "year_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_failure_between_months_leaves_the_old_version_whole(spark, tables, monkeypatch):
    tables.upsert_summary(summary(spark, [("Gas", "F1", "2025-01", 1, 2), ("Gas", "F1", "2025-02", 2, 3)]))
    before = values(tables.monthly_summary, "*")
    new = summary(spark, [("Gas", "F1", "2025-01", 5, 9), ("Gas", "F1", "2025-02", 9, 9)])
    poisoned = new.withColumn("closing_reading", F.when(F.col("year_month") == "2025-02", F.raise_error(F.lit("lost"))).otherwise(F.col("closing_reading")))
    with pytest.raises(Exception, match="lost"):
        tables.upsert_summary(poisoned)
    assert values(tables.monthly_summary, "*") == before
    with monkeypatch.context() as patch:
        patch.setattr(Storage, "write_new", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.upsert_summary(new)
    assert values(tables.monthly_summary, "*") == before
    tables.upsert_summary(new)
    assert values(tables.monthly_summary, "opening_reading") == [(5.0,), (9.0,)]


def test_of_two_writers_from_one_snapshot_one_loses_and_starts_again(spark, table):
    base = table.snapshot()
    first, second = table.write(rows(spark, ("a", 1, "2025-01"))), table.write(rows(spark, ("b", 2, "2025-01")))
    assert table.commit(base, base.plus(first)) and not table.commit(base, base.plus(second))
    tries = []

    def make(found):
        tries.append(found.version)
        if len(tries) == 1:  # another writer comes first
            table.append(rows(spark, ("c", 3, "2025-02")))
        return found.plus(second)

    table.change(make)
    assert tries == [1, 2] and values(table.read(), "n") == [(1,), (2,), (3,)]
    assert table.versions() == [1, 2, 3]


def test_concurrent_upserts_lose_no_rows(spark, tables):
    def work(utility):
        tables.upsert_summary(summary(spark, [(utility, "F1", "2025-01", 1, 2), (utility, "F1", "2025-02", 2, 3)]))

    threads = [threading.Thread(target=work, args=(u,)) for u in ("Gas", "Water", "Diesel")]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert values(tables.monthly_summary, "utility_type", "year_month") == [
        (u, m) for u in ("Diesel", "Gas", "Water") for m in ("2025-01", "2025-02")]


def test_readings_that_come_in_during_an_archive_run_stay(spark, tables, tmp_path, monkeypatch):
    tables.append_readings(readings(spark, [("2025-01-02", 1.0), ("2025-01-30", 2.0)]))
    jobs.summarize(tables, "2025-01")
    inner = jobs.archive.write_archive

    def write(scoped, path):
        inner(scoped, path)
        tables.append_readings(readings(spark, [("2025-01-15", 7.0)]))

    monkeypatch.setattr(jobs.archive, "write_archive", write)
    path = jobs.archive_month(tables, "2025-01", str(tmp_path))
    assert values(tables.readings, "reading_value") == [(7.0,)]
    assert values(jobs.archive.read_archive(spark, path), "reading_value") == [(1.0,), (2.0,)]


def test_a_month_that_was_rewritten_is_not_purged(spark, table):
    for n in range(3):
        table.append(rows(spark, ("a", n, "2025-01")))
    seen = table.snapshot()
    assert table.compact(most_folders=2) == ["2025-01"]
    with pytest.raises(Conflict):
        table.remove("2025-01", seen)
    assert len(table.snapshot().parts["2025-01"]) == 1 and values(table.read(), "n") == [(0,), (1,), (2,)]


def test_old_versions_and_unnamed_folders_expire(spark, table):
    for n in range(4):
        table.append(rows(spark, ("a", n, "2025-01")))
    table.compact(most_folders=1)
    table.write(rows(spark, ("z", 9, "2025-01")))  # of a writer that failed
    folder = f"{table.root}/data"
    assert len(os.listdir(folder)) == 6
    assert table.expire(keep=1, older_than_hours=1) == 0  # too young
    assert table.versions() == [5]
    assert table.expire(keep=1, older_than_hours=-1) == 5
    assert len(os.listdir(folder)) == 1 and values(table.read(), "n") == [(0,), (1,), (2,), (3,)]
    table.append(rows(spark, ("b", 7, "2025-03")))
    assert table.versions() == [5, 6]


def test_maintenance_keeps_everything_that_is_stored(spark, tables):
    for day in range(1, 11):
        tables.append_readings(readings(spark, [(f"2025-01-{day:02}", float(day))]))
    jobs.summarize(tables, "2025-01")
    before = values(tables.readings, "*")
    folder = new_folder(spark, "old-things")
    spark.range(1).write.parquet(folder)
    removed = jobs.maintain(tables, keep=1, older_than_hours=24)
    assert values(tables.readings, "*") == before and os.path.exists(folder) and set(removed.values()) == {0}
    stale = time.time() - 7200
    os.utime(folder, (stale, stale))
    assert jobs.maintain(tables, keep=1, older_than_hours=1)["intermediate"] == 1 and not os.path.exists(folder)
    assert len(tables.table("readings").snapshot().parts["2025-01"]) == 1


def test_tables_are_views_for_sql(spark):
    tables = MeterTables(spark, root=new_folder(spark, "tables"))
    tables.append_readings(readings(spark, [("2025-01-02", 1.0)]))
    tables.register_views()
    assert spark.sql("SELECT sum(reading_value) AS s FROM readings WHERE year_month = '2025-01'").first().s == 1.0
    assert spark.sql("SELECT count(*) AS n FROM ingestion_log").first().n == 0
