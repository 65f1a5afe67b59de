import random
from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeflow.functions.period import Period, readings_in
from gaugeflow.operators import granular, intake_checks
from gaugeflow.operators.slices import SlicePolicy, hot_keys, lag_in_slices
from gaugeflow.plans import jobs
from tests.helpers import at, readings, values


def test_first_reading_in_scope_has_no_predecessor(spark):
    rows = readings(spark, [("2025-01-31", 9.0), ("2025-02-01", 5.0), ("2025-02-02", 4.0)])
    scoped = readings_in(rows, Period("2025-02", "2025-02"))
    found = granular.backward_readings(granular.Readings(scoped))
    assert values(found, "recorded_at", "prev_value", "delta") == [(at("2025-02-02"), 5.0, -1.0)]


def test_missing_values_do_not_break_the_chain(spark):
    rows = readings(spark, [("2025-01-01", 9.0), ("2025-01-02", None), ("2025-01-03", 4.0)])
    found = granular.backward_readings(granular.Readings(rows))
    assert values(found, "prev_value", "reading_value", "month") == [(9.0, 4.0, "2025-01")]


def test_zero_consumption_needs_two_readings(spark):
    rows = readings(spark, [
        ("A", "2025-01-01", 3.0), ("A", "2025-01-02", 3.0), ("A", "2025-01-03", None),
        ("B", "2025-01-01", 3.0), ("C", "2025-01-01", 3.0), ("C", "2025-01-09", 4.0),
    ])
    assert values(granular.zero_consumption(rows), "given_flat_id", "min_val", "num_readings") == [
        ("AurumA", 3.0, 2)
    ]


def test_gap_is_strictly_below_80_percent_of_the_median(spark):
    counts = {"A": 10, "B": 10, "C": 8, "D": 7, "E": 10}
    rows = [
        (flat, f"2025-01-01 {hour:02d}:00", None) for flat, n in counts.items() for hour in range(n)
    ]
    found = granular.gap_detection(readings(spark, rows))
    assert values(found, "given_flat_id", "readings_per_day", "median_count", "pct_of_median") == [
        ("AurumD", 7, 10.0, 70.0)
    ]


def test_spikes_need_a_positive_deviation(spark):
    steady = [(f"2025-01-{day:02d}", 0.1 * day) for day in range(1, 29)]
    assert granular.spike_detection(granular.Readings(readings(spark, steady[:2]))).count() == 0
    whole = [(f"2025-01-{day:02d}", 2.0 * day) for day in range(1, 29)]
    assert granular.spike_detection(granular.Readings(readings(spark, whole))).count() == 0
    spiked = [(t, v if t < "2025-01-20" else v + 100) for t, v in whole]
    found = granular.spike_detection(granular.Readings(readings(spark, spiked)))
    assert values(found, "recorded_at", "delta", "mean_delta") == [
        (at("2025-01-20"), 102.0, round((26 * 2 + 102) / 27, 4))
    ]


def test_stale_run_must_be_longer_than_a_day(spark):
    rows = readings(spark, [
        ("A", "2025-01-01 00:00", 1.0), ("A", "2025-01-02 00:00", 1.0),
        ("B", "2025-01-01 00:00", 1.0), ("B", "2025-01-02 00:00:00.000001", 1.0),
        ("C", "2025-01-01", 1.0), ("C", "2025-01-02", 2.0), ("C", "2025-01-03", 2.0),
        ("C", "2025-01-05", 2.0), ("C", "2025-01-06", 1.0),
    ])
    found = granular.stale_runs(granular.Readings(rows))
    assert values(found, "given_flat_id", "stale_from", "consecutive_same", "stale_seconds") == [
        ("AurumB", at("2025-01-01"), 1, 86400), ("AurumC", at("2025-01-02"), 2, 3 * 86400)
    ]


def test_null_readings(spark):
    rows = readings(spark, [("2025-01-01", None), ("2025-02-03", None), ("2025-02-01", 1.0)])
    columns = ["null_count", "months_affected", "first_null", "last_null"]
    assert values(granular.null_readings(rows), *columns) == [
        (2, 2, at("2025-01-01"), at("2025-02-03"))
    ]


def _skewed(spark, seed):
    """One meter with a third of the rows, in bursts, long stale runs and few values."""
    chance = random.Random(seed)
    rows, seen = [], set()
    for i in range(1500):
        flat = "HOT" if i % 3 == 0 else f"F{chance.randrange(40)}"
        minutes = int(chance.random() ** 4 * 60 * 24 * 300)
        if (flat, minutes) in seen:
            continue
        seen.add((flat, minutes))
        time = at("2025-01-01") + timedelta(minutes=minutes)
        value = float(chance.choice([1, 1, 1, 1, 1, 2, 50]))
        rows.append((flat, time.isoformat(), None if chance.random() < 0.05 else value))
    return readings(spark, rows)


@pytest.mark.parametrize(("seed", "min_rows"), [(1, 10), (2, 100), (3, 10)])
def test_slices_give_what_plain_windows_give(spark, seed, min_rows):
    rows = _skewed(spark, seed).cache()
    policy = SlicePolicy(min_rows=min_rows, bucket_seconds=600 if seed == 1 else 3600)
    sliced, plain = granular.Readings(rows, policy), granular.Readings(rows)
    assert sliced.lagged.hot is not None and plain.lagged.hot is None
    for check in (granular.backward_readings, granular.spike_detection, granular.stale_runs):
        assert values(check(sliced), "*") == values(check(plain), "*"), check
    assert granular.stale_runs(sliced).count() > 0
    assert granular.out_of_order(rows).count() == 0


def test_lag_over_slices_by_row_number(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("k"),
        (F.col("id") * F.col("id")).cast("int").alias("pos"),
        F.col("id").alias("v"),
    )
    sliced = lag_in_slices(rows, ["k"], "pos", {"prev": "v"}, SlicePolicy(min_rows=50))
    window = Window.partitionBy("k").orderBy("pos")
    plain = rows.withColumn("prev", F.lag("v").over(window))
    assert values(sliced.rows, "k", "pos", "prev") == values(plain, "k", "pos", "prev")
    assert sliced.rows.select("_slice").distinct().count() > 20


def test_only_large_keys_are_hot(spark):
    rows = _skewed(spark, 4).filter(F.col("reading_value").isNotNull())
    keys = ["utility_type", "given_flat_id"]
    hot = hot_keys(rows, keys, "recorded_at", SlicePolicy(min_rows=200))
    assert values(hot, "given_flat_id") == [("AurumHOT",)]
    assert hot_keys(rows, keys, "recorded_at", SlicePolicy()) is None


def test_an_outlier_in_time_does_not_undo_the_slices(spark):
    even = spark.range(20_000).select(
        F.lit("Gas").alias("utility_type"), F.lit("F1").alias("given_flat_id"),
        (F.lit(at("2025-01-01")) + F.make_dt_interval(mins=F.col("id").cast("int") * 15))
        .cast("timestamp_ntz").alias("recorded_at"),
        F.sqrt("id").alias("reading_value"),
    )
    typo = even.limit(1).withColumn("recorded_at", F.lit(at("0205-01-01")).cast("timestamp_ntz"))
    cut = granular.Readings(even.unionByName(typo), SlicePolicy(min_rows=1000)).lagged
    sizes = [row["count"] for row in cut.rows.groupBy("_slice").count().collect()]
    assert sum(sizes) == 20_001 and max(sizes) < 2000 and len(sizes) > 10


@pytest.mark.parametrize("size", [1.0, 1e-7, 1e12])
def test_mean_and_deviation_are_bit_equal_in_slices(spark, size):
    chance = random.Random(5)
    rows, value = [], 0.0
    for i in range(900):
        value += size * (chance.random() ** 7 * 1000 if i % 90 else 3e4)
        time = at("2025-01-01") + timedelta(minutes=15 * i)
        rows.append((("HOT", "B", "C")[0 if i % 2 else i % 3], time.isoformat(), value))
    rows = readings(spark, rows).cache()
    sliced = granular.Readings(rows, SlicePolicy(min_rows=50))
    found = values(granular.spike_detection(sliced), "*")
    assert sliced.lagged.hot is not None and found
    assert found == values(granular.spike_detection(granular.Readings(rows)), "*")


def test_repeat_offenders_merge_utilities_and_nulls_stay_per_meter(spark):
    gas = [("2025-01-01", 5.0), ("2025-01-02", 4.0), ("2025-01-03", None), ("2025-02-03", None)]
    water = [("2025-02-01", 5.0), ("2025-02-02", 4.0)]
    rows = readings(spark, gas).unionByName(readings(spark, water, utility="Water"))
    scan = jobs.detect_discrepancies(rows, "2025-Q1")
    columns = ["check_name", "given_flat_id", "times_flagged", "months_flagged", "month_list"]
    assert values(scan.repeat_offenders, *columns) == [
        ("backward_readings", "AurumG001", 2, 2, "2025-01, 2025-02"),
        ("null_readings", "AurumG001", 2, 2, None),
    ]
    assert jobs.detect_discrepancies(rows, "2025-01").repeat_offenders is None
    report = values(scan.report, "check_no", "check_name", "status", "total_issues")
    assert report[0] == (1, "backward_readings", "2 found", 3)
    assert report[6] == (7, "out_of_order", "PASS", 3)
    assert [r.delta for r in scan.listing("backward_readings", 1).collect()] == [-1.0]


def test_ingestion_checks(spark):
    rows = readings(spark, [(f"2025-01-01 {h:02d}:00", 1.0) for h in range(8)], source="a")
    rows = rows.unionByName(
        readings(spark, [("X", "2025-01-01 09:00", 1.0), ("X", "2025-01-03", 1.0)], source="b")
    ).unionByName(readings(spark, [(f"2025-01-02 {h:02d}:00", 1.0) for h in range(8)], source="c"))
    log = spark.createDataFrame(
        [("a", "h", at("2025-01-04"), 8)],
        "source_file string, file_hash string, ingested_at timestamp_ntz, record_count int",
    )
    scan = jobs.detect_ingestion_issues(rows, log, "2025_01", 2)
    assert values(scan.checks["file_completeness"], "reading_date", "missing_files") == [
        (at("2025-01-02").date(), 1), (at("2025-01-03").date(), 1)
    ]
    assert values(scan.checks["row_count_anomalies"], "source_file", "pct_of_median") == [
        ("b", 25.0)
    ]
    assert values(scan.report, "check_no", "status", "total_issues", "categories_hit") == [
        (1, "2 found", 3, 2), (2, "1 found", 3, 2), (3, "1 listed", 3, 2)
    ]
    assert values(intake_checks.scan_stats(rows), "distinct_files", "distinct_days") == [(3, 3)]
