import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.period import Period, parse_period, readings_in, single_month
from tests.helpers import readings, values


@pytest.mark.parametrize(
    ("text", "start", "end"),
    [
        ("2026-08", "2026-08", "2026-08"),
        (" 2026_08 ", "2026-08", "2026-08"),
        ("2026-01:2026-06", "2026-01", "2026-06"),
        ("2026/01:2026.06", "2026-01", "2026-06"),
        ("2026", "2026-01", "2026-12"),
        ("2026-H1", "2026-01", "2026-06"),
        ("2026-h2", "2026-07", "2026-12"),
        ("2026-Q1", "2026-01", "2026-03"),
        ("2026-q2", "2026-04", "2026-06"),
        ("2026-Q3", "2026-07", "2026-09"),
        ("2026-Q4", "2026-10", "2026-12"),
        ("2026-13", "2026-13", "2026-13"),
        ("2026-06:2026-01", "2026-06", "2026-01"),
    ],
)
def test_grammar(text, start, end):
    assert parse_period(text) == Period(start, end)


@pytest.mark.parametrize(
    "text", ["", "26", "2026-1", "2026-H3", "2026-H4", "2026-Q5", "2026-Q0", "2026-01:2026",
             "2026-01:2026-02:2026-03", "2026-X1", "August", "2026-01 : 2026-02"]
)
def test_invalid_periods(text):
    with pytest.raises(ValueError, match="Invalid period"):
        parse_period(text)


def test_label_and_month_argument():
    assert parse_period("2026-Q1").label == "2026-01 to 2026-03"
    assert parse_period("2026-01").label == "2026-01"
    assert single_month("2026/07").start == "2026-07"


TIMES = [
    "2023-12-31 23:59:59.999999", "2024-01-01", "2024-01-31 23:45", "2024-02-29", "2024-12-31 23:59",
    "2025-01-01", "2025-06-15",
]


@pytest.mark.parametrize(
    ("start", "end"),
    [("2024-01", "2024-01"), ("2024-01", "2024-12"), ("2024-13", "2024-13"), ("2024-00", "2024-00"),
     ("2024-00", "2024-13"), ("2024-12", "2024-13"), ("2024-13", "2025-00"), ("2024-13", "2025-01"),
     ("2024-06", "2024-01"), ("0001-01", "9999-12"), ("0000-01", "9999-99")],
)
def test_time_range_selects_the_same_rows_as_the_month_text(spark, start, end):
    rows = readings(spark, [(time, 1.0) for time in TIMES])
    month = F.date_format("recorded_at", "yyyy-MM")
    by_text = rows.filter(month.between(start, end))
    by_range = readings_in(rows, Period(start, end))
    assert values(by_range, "recorded_at") == values(by_text, "recorded_at")


def test_a_bad_month_argument_matches_nothing(spark):
    rows = readings(spark, [("2024-01-01", 1.0)])
    assert readings_in(rows, single_month("January")).count() == 0
