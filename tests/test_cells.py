import pytest
from pyspark.sql import functions as F

from gaugeflow.functions import cells
from gaugeflow.functions.numbers import float_text, round_half_away
from gaugeflow.operators import intake, sheets
from tests.helpers import values


def one(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-01-05 13:04:05", "2025-01-05 13:04:05"),
        ("2025-1-5 3:4", "2025-01-05 03:04:00"),
        ("05-01-2025 13:04:05", "2025-01-05 13:04:05"),
        (" 5-1-2025  13:04 ", "2025-01-05 13:04:00"),
        ("\t05-01-2025\t13:04\n", "2025-01-05 13:04:00"),
        ("05-01-2025 02:00 PM", "2025-01-05 14:00:00"),
        ("05-01-2025 02:00 pm", "2025-01-05 14:00:00"),
        ("05-01-2025 12:00 AM", "2025-01-05 00:00:00"),
        ("05-01-2025 12:30:15 PM", "2025-01-05 12:30:15"),
        ("05-01-2025 13:00 PM", None),
        ("05-01-2025 00:10 AM", None),
        ("2025-01-05 02:00 PM", None),
        ("05-01-2025 02:00PM", None),
        ("31-02-2025 10:00", None),
        ("05-01-2025", None),
        ("2025-01-05T10:00", None),
        ("05-01-2025 24:00", None),
        ("05-01-2025 10:00:60", None),
        ("05/01/2025 10:00", None),
        ("05-01-25 10:00", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_reading_time(spark, text, expected):
    found = one(spark, cells.parse_reading_time, text)
    assert (None if found is None else str(found)) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("05-01-2025 02:00 PM", "2025-01-05 02:00:00"),
        ("05-01-2025 14:00 am", "2025-01-05 14:00:00"),
        ("05-01-2025 14:00:30  AM ", "2025-01-05 14:00:30"),
        ("05-01-2025 14:00 Pm", None),
        ("05-01-2025 14:00 AM PM", None),
        ("2025-01-05 14:00", None),
        ("05-01-2025 14:00", "2025-01-05 14:00:00"),
    ],
)
def test_daily_time(spark, text, expected):
    found = one(spark, cells.parse_time_24h, text)
    assert (None if found is None else str(found)) == expected


@pytest.mark.parametrize(
    ("header", "stripped", "raw"),
    [
        (" G001 ", "G001", "G001"),
        ("C G001", "G001", "C G001"),
        ("cG001", "G001", "cG001"),
        ("CC1", "C1", "CC1"),
        ("101.7", "101", "101"),
        ("101", "101", "101"),
        ("0101", "0101", "0101"),
        ("007", "007", "007"),
        ("+5", "+5", "+5"),
        ("12345678901234567", "12345678901234567", "12345678901234567"),
        ("12345678901234567890.9", "12345678901234567890", "12345678901234567890"),
        ("-0.4", "0", "0"),
        ("-3.9", "-3", "-3"),
        ("C", "", "C"),
        ("C-101.5", "-101.5", "C-101.5"),
    ],
)
def test_flat_ids(spark, header, stripped, raw):
    assert one(spark, lambda c: cells.normalize_flat_id(c, F.lit("C")), header) == stripped
    assert one(spark, cells.raw_flat_id, header) == raw


@pytest.mark.parametrize(
    ("text", "value", "bad"),
    [
        ("1.5", 1.5, False), (" -2 ", -2.0, False), ("+.5", 0.5, False), ("1e3", 1000.0, False),
        ("5.", 5.0, False), ("1_000", 1000.0, False), ("inf", float("inf"), False),
        ("NAN", None, False), ("1d", None, True), ("1_", None, True), ("0x10", None, True),
        ("ERR", None, True), ("1,5", None, True), ("", None, False), ("n/a", None, False),
        (None, None, False),
    ],
)
def test_reading_values(spark, text, value, bad):
    assert one(spark, lambda c: cells.reading_value(cells.present(c)), text) == value
    assert one(spark, lambda c: cells.is_bad_number(cells.present(c)), text) is bad


def test_file_names(spark):
    names = [
        "T C Eb readings.xls", "T C Gas Readings.xls", "T c WATER extra readings.xlsx",
        "T C readings.xls", "X C Eb readings.xls", "T I Eb readings.xls", "T C Steam readings.xls",
        "T Cc Eb readings.xls", "T  C  Dg readings.xls",
    ]
    files = spark.createDataFrame([(n,) for n in names], "source_file string")
    found = {
        r.source_file: (r.tower_name, r.utility_type, r.reject_reason)
        for r in sheets.parse_filenames(files).collect()
    }
    assert found == {
        "T C Eb readings.xls": ("Aurum", "Electricity", None),
        "T C Gas Readings.xls": ("Aurum", "Gas", None),
        "T c WATER extra readings.xlsx": ("Aurum", "Water", None),
        "T C readings.xls": ("Aurum", None, "unexpected file name"),
        "X C Eb readings.xls": ("Aurum", "Electricity", "unexpected file name"),
        "T I Eb readings.xls": (None, "Electricity", "unknown tower"),
        "T C Steam readings.xls": ("Aurum", None, "unknown utility"),
        "T Cc Eb readings.xls": (None, "Electricity", "unknown tower"),
        "T  C  Dg readings.xls": ("Aurum", "Diesel", None),
    }


def test_discovered_names(spark):
    paths = [
        "/a/T C Eb readings.xls", "/a/T C Eb Readings.xlsx", "/a/T C Eb READINGS.xls",
        "/a/T C readings.xls", "/a/T C Eb readings.xlsm", "/a/t C Eb readings.xls",
        "/a/T C Eb readings.xls",
    ]
    found = intake.discover_files(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert values(found, "path") == [("/a/T C Eb Readings.xlsx",), ("/a/T C Eb readings.xls",)]


@pytest.mark.parametrize(
    ("value", "text"),
    [(12.0, "12.0"), (0.0, "0.0"), (12345678.25, "12345678.25"), (-1e7, "-10000000.0"),
     (0.0005, "0.0005"), (1e-5, "1.0E-5"), (55.8842, "55.8842"), (100.0, "100.0")],
)
def test_float_text(spark, value, text):
    assert one(spark, float_text, value, "double") == text


@pytest.mark.parametrize(
    ("value", "digits", "rounded"),
    [(1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (-1.25, 1, -1.3), (0.0, 2, 0.0)],
)
def test_rounding(spark, value, digits, rounded):
    assert one(spark, lambda c: round_half_away(c, digits), value, "double") == rounded
