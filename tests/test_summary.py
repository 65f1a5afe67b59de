import json

from gaugeflow.functions.period import Period
from gaugeflow.operators import coverage, findings, summary_checks
from gaugeflow.operators import summary as summaries
from gaugeflow.plans import jobs
from tests.helpers import at, readings, summary, values


def test_monthly_summary_uses_first_and_last_value_by_time(spark):
    rows = readings(spark, [
        ("2025-01-31 23:45", 7.0), ("2025-01-01", None), ("2025-01-02", 9.0), ("2025-02-01", 1.0),
    ])
    found = summaries.monthly_summary(rows, Period("2025-01", "2025-01"))
    assert [tuple(r) for r in found.collect()] == [
        ("Gas", "AurumG001", "2025-01", 9.0, 7.0, -2.0, at("2025-01-02"), at("2025-01-31 23:45"))
    ]


def test_flat_readings_include_the_end_date(spark):
    rows = readings(spark, [
        ("2025-01-11 23:59", 1.0), ("2025-01-12", 2.0), ("2025-01-15 23:59:59", 3.0),
        ("2025-01-16", 4.0), ("OTHER", "2025-01-13", 5.0),
    ])
    for utility in (None, "Gas"):
        found = summaries.flat_readings(rows, "AurumG001", "2025-01-12", "2025-01-15", utility)
        assert [r.reading_value for r in found.collect()] == [2.0, 3.0]
    assert summaries.flat_readings(rows, "AurumG001", "2025-01-12", "2025-01-15", "Dg").isEmpty()


def test_continuity_uses_the_previous_existing_month_outside_the_period(spark):
    rows = summary(spark, [
        ("Gas", "F", "2024-11", 1, 5), ("Gas", "F", "2025-02", 6, 9), ("Gas", "F", "2025-03", 9, 9),
        ("Gas", "G", "2025-02", 1, 2), ("Gas", "H", "2025-01", 1, 2.0005),
        ("Gas", "H", "2025-02", 2.001, 3),
    ])
    found = summary_checks.continuity_breaks(rows, Period("2025-02", "2025-02"))
    assert values(found, "given_flat_id", "prev_month", "prev_closing", "curr_opening", "gap") == [
        ("F", "2024-11", 5.0, 6.0, 1.0)
    ]


def test_outliers_use_all_history_and_three_months(spark):
    steady = [("Gas", "F", f"2024-{m:02d}", 0, 10 + m % 2) for m in range(1, 13)]
    rows = summary(spark, [*steady, ("Gas", "F", "2025-01", 0, 100), ("Gas", "S", "2025-01", 0, 9),
                           ("Gas", "S", "2025-02", 0, 900), ("Gas", "Z", "2025-01", 0, 5),
                           ("Gas", "Z", "2025-02", 0, 5), ("Gas", "Z", "2025-03", 0, 5)])
    found = summary_checks.outlier_consumption(rows, Period("2025-01", "2025-01"))
    assert values(found, "given_flat_id", "year_month", "monthly_reading") == [
        ("F", "2025-01", 100.0)
    ]
    assert summary_checks.outlier_consumption(rows, Period("2025-02", "2025-02")).count() == 0


def test_cross_utility_mismatch_and_its_findings(spark):
    rows = summary(spark, [
        ("Water", "F", "2025-01", 1, 1), ("Gas", "F", "2025-01", 1, 1),
        ("Eb", "F", "2025-01", 1, 4), ("Dg", "F", "2025-01", 1, 0),
        ("Water", "G", "2025-01", 1, 1), ("Gas", "G", "2025-01", 1, 0),
    ])
    found = summary_checks.cross_utility_mismatch(rows)
    columns = ["given_flat_id", "zero_utilities", "active_utilities", "zero_count"]
    assert values(found, *columns) == [("F", ["Gas", "Water"], ["Eb"], 2)]
    recorded = findings.cross_utility_findings(found)
    assert values(recorded, "utility_type", "remark") == [
        ("Gas", "Cross-utility mismatch: Gas is zero while ['Eb'] are active"),
        ("Water", "Cross-utility mismatch: Water is zero while ['Eb'] are active"),
    ]
    detail = json.loads(recorded.first().detail_json)
    assert detail == {"zero_utilities": ["Gas", "Water"], "active_utilities": ["Eb"]}


def test_missing_months_only_for_meters_and_months_in_scope(spark):
    rows = summary(spark, [
        ("Gas", "F", "2025-01", 1, 2), ("Gas", "F", "2025-03", 1, 2), ("Gas", "G", "2025-02", 1, 2),
        ("Water", "F", "2025-04", 1, 2),
    ])
    found = summary_checks.missing_months(rows, Period("2025-01", "2025-03"))
    assert values(found, "utility_type", "given_flat_id", "year_month") == [
        ("Gas", "F", "2025-02"), ("Gas", "G", "2025-01"), ("Gas", "G", "2025-03")
    ]


def test_missing_months_are_skipped_for_one_month(spark):
    rows = summary(spark, [("Gas", "F", "2025-01", 2, 1)])
    scan = jobs.summary_scan(rows, "2025-01")
    assert "missing_months" not in scan.checks and scan.repeat_offenders is None
    report = {r.check_name: (r.status, r.total_issues, r.categories_hit)
              for r in scan.report.collect()}
    assert report["missing_months"] == ("SKIPPED", 1, 1)
    assert report["negative_consumption"] == ("1 found", 1, 1)
    everything = jobs.summary_scan(rows)
    assert everything.checks["missing_months"].count() == 0
    assert everything.repeat_offenders is None


def test_coverage(spark):
    rows = summary(spark, [
        ("Gas", "F", "2025-01", 1, 2), ("Water", "F", "2025-01", 1, 1),
        ("Gas", "F", "2025-02", 1, 2), ("Water", "F", "2025-02", 1, 1),
        ("Gas", "G", "2025-01", 0.1, 0.4), ("Gas", "G", "2025-02", 0.4, 0.1),
        ("Gas", "H", "2025-02", 5, 1), ("Water", "H", "2025-01", 1, 3),
    ])
    assert values(coverage.presence_patterns(rows), "utilities_present", "num_flats",
                  "is_complete") == [(["Gas", "Water"], 2, True), (["Gas"], 1, False)]
    assert values(coverage.incomplete_coverage(rows), "given_flat_id", "missing_slots",
                  "missing_utilities", "missing_months") == [
        ("G", 2, ["Water"], ["2025-01", "2025-02"]),
        ("H", 2, ["Gas", "Water"], ["2025-01", "2025-02"]),
    ]
    january = Period("2025-01", "2025-01")
    assert coverage.incomplete_coverage(rows, january).count() == 0
    assert values(coverage.zero_profiles(rows), "given_flat_id", "zero_utilities",
                  "active_utilities") == [("F", ["Water"], ["Gas"])]
    assert [tuple(r) for r in coverage.coverage_summary(rows).collect()] == [(3, 2, 2, 2, 1, 1)]


def test_repeat_offenders_of_the_summary(spark):
    rows = summary(spark, [("Gas", "F", "2025-01", 2, 1), ("Water", "F", "2025-03", 2, 1)])
    repeats = jobs.summary_scan(rows, "2025-Q1").repeat_offenders
    found = {r.check_name: (r.given_flat_id, r.month_list) for r in repeats.collect()}
    assert found == {
        "negative_consumption": ("F", "2025-01, 2025-03"),
        "missing_months": ("F", "2025-01, 2025-03"),
    }
