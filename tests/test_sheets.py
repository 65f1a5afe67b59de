from pyspark.sql import functions as F

from gaugeflow.operators.daily import DAILY_COLUMNS, daily_open_close, write_daily_csv
from gaugeflow.operators.merge import first_per_key, insert_if_absent, keyed_upsert
from gaugeflow.operators.sheets import Sheets, rows_from_cells
from gaugeflow.operators.slices import SlicePolicy
from gaugeflow.sources.files import delimited_sheet_rows, file_hashes, list_files
from tests.helpers import grid, sheet, values

GAS = "T C Gas readings.xls"


def test_repeated_times_are_dropped_as_whole_rows(spark):
    """Only directly repeated times count; a row without a time in between changes nothing."""
    rows = [
        ["12-01-2025 00:00", 1, 10],
        ["12-01-2025 00:00:00", 2, 20],
        ["bad time", 3, 30],
        ["2025-01-12 00:00", 4, 40],
        ["12-01-2025 00:15", 5, 50],
        ["12-01-2025 00:00", 6, 60],
    ]
    for policy in (SlicePolicy(), SlicePolicy(min_rows=2)):
        records = Sheets(sheet(spark, {GAS: grid(["G1", "G2"], rows)}), policy).records()
        assert values(records, "row_idx", "flat_id", "reading_value") == [
            (3, "G1", 1.0), (3, "G2", 10.0), (7, "G1", 5.0), (7, "G2", 50.0), (8, "G1", 6.0),
            (8, "G2", 60.0),
        ]


def test_columns_without_header_and_missing_cells(spark):
    rows = [["12-01-2025 00:00", 1, 2, 3], ["12-01-2025 00:15", None]]
    records = Sheets(sheet(spark, {GAS: grid(["G1", None, "G3"], rows)})).records()
    assert values(records, "given_flat_id", "col_idx", "reading_value") == [
        ("AurumG1", 1, 1.0), ("AurumG1", 1, None), ("AurumG3", 3, 3.0), ("AurumG3", 3, None)
    ]


def test_bad_cell_counts_only_where_it_is_read(spark):
    files = {
        "T A Gas readings.xls": grid(["G1", None], [["12-01-2025 00:00", 1, "x"]]),
        "T B Gas readings.xls": grid(["G1"], [["no time", "x"], ["12-01-2025 00:00", 1]]),
        "T C Gas readings.xls": grid(["G1"], [["12-01-2025 00:00", 1], ["12-01-2025 00:00", "x"]]),
        "T D Gas readings.xls": grid(["G1"], [["12-01-2025 00:00", "x"]]),
    }
    contents = Sheets(sheet(spark, files)).contents()
    assert values(contents, "source_file", "records", "has_bad_cell") == [
        ("T A Gas readings.xls", 1, False), ("T B Gas readings.xls", 1, False),
        ("T C Gas readings.xls", 1, False), ("T D Gas readings.xls", 1, True),
    ]


def test_cell_table_with_gaps(spark):
    cells = spark.createDataFrame(
        [(GAS, 0, 0, "a"), (GAS, 0, 1, None), (GAS, 0, 2, "c"), (GAS, 1, 2, "z"), (GAS, 1, 0, "x")],
        "source_file string, row_idx int, col_idx int, cell string",
    )
    rows = {r.row_idx: r.cells for r in rows_from_cells(cells).collect()}
    assert rows == {0: ["a", None, "c"], 1: ["x", None, "z"]}


def test_daily_values_follow_row_order_and_need_both_ends(spark, tmp_path):
    rows = [
        ["12-01-2025 23:00 PM", "9", 1],
        ["12-01-2025 08:00", "5.50", 2],
        ["13-01-2025 00:00", "7", None],
        ["12-01-2025 01:00", "6", 4],
        ["2025-01-13 05:00", "8", 5],
    ]
    daily = daily_open_close(sheet(spark, {GAS: grid([" C G001", 102.0], rows)}))
    assert values(daily, *DAILY_COLUMNS) == [
        ("Gas", "Aurum102", "12-01-2025", "1", "4"),
        ("Gas", "AurumC G001", "12-01-2025", "9", "6"),
        ("Gas", "AurumC G001", "13-01-2025", "7", "7"),
    ]
    write_daily_csv(daily, str(tmp_path / "daily"))
    written = spark.read.csv(str(tmp_path / "daily"), header=True)
    assert [tuple(r)[1:3] for r in written.coalesce(1).collect()] == [
        ("AurumC G001", "12-01-2025"), ("Aurum102", "12-01-2025"), ("AurumC G001", "13-01-2025")
    ]


def test_large_delimited_file_keeps_row_numbers_over_splits(spark, tmp_path):
    name = "T C Eb readings.csv"
    lines = [f"row {i},{i}" for i in range(3000)]
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    (tmp_path / "T D Eb readings.csv").write_text("x,y")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = delimited_sheet_rows(spark, str(tmp_path)).cache()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        found = rows.filter(F.col("source_file") == name)
        assert sorted((r.row_idx, *r.cells) for r in found.collect()) == [
            (i, f"row {i}", str(i)) for i in range(3000)
        ]
        assert rows.count() == 3001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_listing_and_hashes(spark, tmp_path):
    for name in ("T C Eb readings.xls", "T C Gas Readings.xlsx", "T C Dg readings.csv", "x.xls"):
        (tmp_path / name).write_text("a")
    assert values(list_files(spark, str(tmp_path)), "source_file") == [
        ("T C Eb readings.xls",), ("T C Gas Readings.xlsx",)
    ]
    (tmp_path / "T E Eb readings.xls").write_text("a\n")
    hashes = {r.source_file: r.file_hash for r in file_hashes(spark, str(tmp_path)).collect()}
    assert len(hashes) == 3 and len(set(hashes.values())) == 2
    assert hashes["T C Eb readings.xls"] == hashes["T C Gas Readings.xlsx"]


ROWS = "k int, source_file string, row_idx int, col_idx int, v double"
ORDER = ["source_file", "row_idx", "col_idx"]


def test_first_of_many_copies_wins_and_stored_keys_are_skipped(spark):
    batch = spark.createDataFrame(
        [(1, "b", 3, 1, 9.0), (1, "a", 4, 1, 8.0), (1, "a", 3, 2, 7.0), (2, "a", 3, 1, 6.0),
         (3, "a", 9, 1, None)] + [(1, "c", i, 1, 0.0) for i in range(500)],
        ROWS,
    )
    assert values(first_per_key(batch, ["k"], ORDER), "k", "v") == [(1, 7.0), (2, 6.0), (3, None)]
    stored = spark.createDataFrame([(2,)], "k int")
    assert values(insert_if_absent(stored, batch, ["k"], ORDER), "k", "v") == [(1, 7.0), (3, None)]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = keyed_upsert(old, new, ["k"])
    expected = [(1, "a"), (2, "c"), (3, "d")]
    assert values(once, "k", "v") == expected
    assert values(keyed_upsert(once, new, ["k"]), "k", "v") == expected
