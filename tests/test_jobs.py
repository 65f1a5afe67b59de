"""Whole jobs on stored tables."""

import pytest
from pyspark.sql import functions as F

from gaugeflow.plans import jobs
from gaugeflow.sources.snapshots import SnapshotTable
from tests.helpers import grid, readings, sheet, summary, values

GAS, WATER = "T C Gas readings.xls", "T C Water readings.xls"
MORNING = [["12-01-2025 00:00", 1.0, 5], ["12-01-2025 00:15", 2.5, None]]


def hashes(spark, **by_letter):
    rows = [(name, content) for name, content in by_letter.pop("files").items()]
    return spark.createDataFrame(rows, "source_file string, file_hash string")


def run(tables, files, contents):
    spark = tables.spark
    outcome = jobs.ingest_sheets(tables, sheet(spark, files), hashes(spark, files=contents))
    return {row.source_file: (row.outcome, row.inserted) for row in outcome.collect()}


def test_ingest_loads_rows_and_log_and_a_second_run_adds_nothing(tables):
    files = {GAS: grid(["C G001", 101.0], MORNING)}
    assert run(tables, files, {GAS: "h1"}) == {GAS: ("ingested", 4)}
    assert values(tables.readings, "given_flat_id", "reading_value") == [
        ("Aurum101", 5.0), ("Aurum101", None), ("AurumG001", 1.0), ("AurumG001", 2.5)
    ]
    assert values(tables.ingestion_log, "source_file", "record_count") == [(GAS, 4)]
    assert run(tables, files, {GAS: "h1"}) == {GAS: ("content already ingested", 0)}
    assert tables.readings.count() == 4


def test_stored_reading_wins_and_only_new_rows_are_counted(tables):
    run(tables, {GAS: grid(["G001"], [["12-01-2025 00:00", 1]])}, {GAS: "h1"})
    other = "T C Gas Readings.xls"
    later = grid(["G001"], [["12-01-2025 00:00", 9], ["12-01-2025 00:15", 2]])
    assert run(tables, {other: later}, {other: "h2"}) == {other: ("ingested", 1)}
    assert values(tables.readings, "reading_value") == [(1.0,), (2.0,)]


def test_same_name_with_new_content_inserts_but_keeps_the_log(tables):
    run(tables, {GAS: grid(["G001"], [["12-01-2025 00:00", 1]])}, {GAS: "h1"})
    new = {GAS: grid(["G001"], [["13-01-2025 00:00", 2]])}
    conflict = {GAS: ("ingested, but the log already has this name", 1)}
    assert run(tables, new, {GAS: "h2"}) == conflict
    assert tables.readings.count() == 2
    assert values(tables.ingestion_log, "file_hash") == [("h1",)]
    assert run(tables, new, {GAS: "h2"})[GAS][1] == 0


def test_bad_cell_rejects_its_file_only(tables):
    files = {
        GAS: grid(["G001"], [["12-01-2025 00:00", "x"], ["12-01-2025 00:15", 2]]),
        WATER: grid(["G001"], [["12-01-2025 00:00", 3]]),
        "T I Gas readings.xls": grid(["G001"], MORNING),
        "T C Steam readings.xls": grid(["G001"], MORNING),
        "T C Dg readings.xls": grid(["G001"], [["no time", 3]]),
    }
    assert run(tables, files, {name: name for name in files}) == {
        GAS: ("cell is not a number", 0),
        WATER: ("ingested", 1),
        "T I Gas readings.xls": ("unknown tower", 0),
        "T C Steam readings.xls": ("unknown utility", 0),
        "T C Dg readings.xls": ("no records", 0),
    }


def test_dropped_rows_are_counted(tables):
    rows = [["12-01-2025 00:00", 1], ["12-01-2025 00:00", 2], ["soon", 3], [None, 4], ["12-01-2025 00:15", 5]]
    files = {GAS: grid(["G001"], rows)}
    run(tables, {WATER: grid(["G001"], rows[:1])}, {WATER: "h0"})
    outcome = jobs.ingest_sheets(
        tables, sheet(tables.spark, files), hashes(tables.spark, files={GAS: "h1"})
    )
    assert values(outcome, "records", "inserted", "skipped", "untimed_rows", "repeated_rows") == [
        (2, 2, 0, 1, 1)
    ]
    other = {"T C Gas Readings.xls": grid(["G001"], rows[-1:])}
    outcome = jobs.ingest_sheets(
        tables, sheet(tables.spark, other), hashes(tables.spark, files={"T C Gas Readings.xls": "h2"})
    )
    assert values(outcome, "inserted", "skipped") == [(0, 1)]
    found = jobs.look_up(tables, "AurumG001", "2025-01-12", "2025-01-12", "Gas")
    assert [r.reading_value for r in found.collect()] == [1.0, 5.0]


def test_daily_job_names_the_files_it_leaves_out(spark, tmp_path):
    for name in ("T A Gas readings.csv", "T A Steam readings.csv", "T I Gas readings.csv"):
        (tmp_path / name).write_text("x\n,101\nx\n12-01-2025 00:00,1\n")
    left_out = jobs.write_daily_records(spark, str(tmp_path), f"{tmp_path}/out")
    assert values(left_out, "source_file", "reject_reason") == [
        ("T A Steam readings.csv", "unknown utility"), ("T I Gas readings.csv", "unknown tower")
    ]
    assert spark.read.csv(f"{tmp_path}/out", header=True).count() == 1


def test_copy_is_skipped_only_after_a_logged_file(tables):
    """Name order decides; a file that fails does not stop its copy."""
    first, copy = "T A Gas readings.xls", "T B Gas readings.xls"
    unusable = "T A Steam readings.xls"
    files = {name: grid(["G001"], MORNING) for name in (first, copy, unusable)}
    assert run(tables, files, {first: "h", copy: "h", unusable: "u"}) == {
        first: ("ingested", 2), copy: ("content already ingested", 0),
        unusable: ("unknown utility", 0),
    }
    assert run(
        tables, {unusable: files[unusable], WATER: files[first]}, {unusable: "u", WATER: "u"}
    ) == {unusable: ("unknown utility", 0), WATER: ("ingested", 2)}


def test_summarize_replaces_by_key_and_keeps_rows_after_a_purge(tables, tmp_path):
    tables.append_readings(
        readings(tables.spark, [("2025-01-02", 1.0), ("2025-01-30", 4.0), ("2025-02-01", 5.0)])
    )
    shown = jobs.summarize(tables, "2025_01")
    assert values(shown, "year_month", "monthly_reading") == [("2025-01", 3.0)]
    jobs.summarize(tables, "2025-02")
    tables.append_readings(readings(tables.spark, [("2025-01-31", 9.0)]))
    jobs.summarize(tables, "2025-01")
    assert values(tables.monthly_summary, "year_month", "monthly_reading") == [
        ("2025-01", 8.0), ("2025-02", 0.0)
    ]
    jobs.archive_month(tables, "2025-01", str(tmp_path))
    jobs.summarize(tables, "2025-01")
    assert tables.monthly_summary.count() == 2


def test_archive_and_reload_restore_the_readings(tables, tmp_path):
    tables.append_readings(
        readings(tables.spark, [("2025-01-02", 1.0), ("2025-01-30", None), ("2025-02-01", 5.0)])
    )
    with pytest.raises(jobs.NotSummarized):
        jobs.archive_month(tables, "2025-01", str(tmp_path))
    before = values(tables.readings, "*")
    jobs.summarize(tables, "2025-01")
    path = jobs.archive_month(tables, "2025-01", str(tmp_path))
    assert values(tables.readings, "reading_value") == [(5.0,)]
    assert jobs.archive_month(tables, "2025-01", str(tmp_path)) is None
    assert jobs.reload_archive(tables, path) == 2
    assert values(tables.readings, "*") == before
    with pytest.raises(ValueError, match="already stored"):
        jobs.reload_archive(tables, path)
    assert tables.readings.count() == 3


def test_a_late_reading_gets_an_archive_of_its_own(tables, tmp_path):
    tables.append_readings(readings(tables.spark, [("2025-01-02", 1.0), ("2025-01-30", 2.0)]))
    jobs.summarize(tables, "2025-01")
    first = jobs.archive_month(tables, "2025-01", str(tmp_path))
    tables.append_readings(readings(tables.spark, [("2025-01-20", 3.0)]))
    second = jobs.archive_month(tables, "2025-01", str(tmp_path))
    assert first != second and tables.readings.count() == 0
    assert jobs.reload_archive(tables, first) + jobs.reload_archive(tables, second) == 3
    assert values(tables.readings, "reading_value") == [(1.0,), (2.0,), (3.0,)]


def test_look_up_opens_only_the_months_asked_for(tables):
    tables.append_readings(readings(tables.spark, [("2025-01-02", 1.0), ("2025-03-01", 2.0)]))
    from gaugeflow.operators.summary import flat_readings

    flat = tables.readings.first().given_flat_id
    found = flat_readings(tables.readings, flat, "2025-01-01", "2025-02-01")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "year_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert values(found, "reading_value") == [(1.0,)]


def test_findings_are_upserted_and_never_removed(tables):
    spark = tables.spark
    tables.upsert_summary(
        summary(spark, [("Gas", "F1", "2025-01", 5, 3), ("Gas", "F1", "2025-02", 3, 3)]), None
    )
    scan = jobs.detect_summary_discrepancies(tables, "2025-01:2025-02")
    assert scan.checks["negative_consumption"].count() == 1
    report, counts = jobs.show_discrepancies(tables, severity="error")
    assert values(report, "check_name", "remark") == [
        ("negative_consumption", "Negative monthly_reading: -2.00 (open=5.0, close=3.0)")
    ]
    assert values(counts, "check_name", "count") == [("negative_consumption", 1)]
    recorded = tables.monthly_discrepancy.count()
    jobs.detect_summary_discrepancies(tables, "2025-01:2025-02")
    assert tables.monthly_discrepancy.count() == recorded
    tables.upsert_summary(summary(spark, [("Gas", "F1", "2025-01", 5, 7)]), None)
    jobs.detect_summary_discrepancies(tables)
    found = tables.monthly_discrepancy.filter(F.col("check_name") == "negative_consumption")
    assert found.count() == 1


def test_stats_of_empty_and_filled_tables(tables):
    columns = ["readings", "monthly_summary", "files_ingested", "distinct_flats"]
    assert values(jobs.table_stats(tables), *columns) == [(0, 0, 0, 0)]
    run(tables, {GAS: grid(["G001", "G002"], MORNING)}, {GAS: "h1"})
    jobs.summarize(tables, "2025-01")
    assert values(jobs.table_stats(tables), *columns) == [(4, 2, 1, 2)]


def test_directory_of_csv_sheets(tables, tmp_path):
    name = "T C Eb readings.csv"
    (tmp_path / name).write_text(
        'Energy\nRecorded Date/Time,C G001,"102",\n,,,\n'
        "12-01-2025  00:00 ,1.5,7,\n12-01-2025 00:00,8,8,8\n13-01-2025 01:00 PM,2.5,n/a,9\n"
    )
    (tmp_path / "notes.csv").write_text("a,b\n")
    outcome = jobs.ingest_directory(tables, str(tmp_path))
    assert values(outcome, "source_file", "outcome", "inserted") == [(name, "ingested", 4)]
    assert values(tables.readings, "given_flat_id", "recorded_at", "reading_value") == sorted(
        [
            ("Aurum102", *_reading("2025-01-12 00:00", 7.0)),
            ("Aurum102", *_reading("2025-01-13 13:00", None)),
            ("AurumG001", *_reading("2025-01-12 00:00", 1.5)),
            ("AurumG001", *_reading("2025-01-13 13:00", 2.5)),
        ],
        key=repr,
    )


def _reading(time, value):
    from tests.helpers import at

    return at(time), value


def test_an_upsert_that_fails_before_the_switch_leaves_the_old_rows(tables, monkeypatch):
    tables.append_readings(readings(tables.spark, [("2025-01-01", 1.0), ("2025-01-31", 4.0)]))
    jobs.summarize(tables, "2025-01")
    tables.append_readings(readings(tables.spark, [("2025-01-31 12:00", 9.0)]))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "commit", fail)
        with pytest.raises(OSError):
            jobs.summarize(tables, "2025-01")
    assert values(tables.monthly_summary, "closing_reading") == [(4.0,)]
    jobs.summarize(tables, "2025-01")
    assert values(tables.monthly_summary, "closing_reading") == [(9.0,)]
