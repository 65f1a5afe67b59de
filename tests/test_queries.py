"""Registered queries: results against SQL, and the shape of their plans."""

import os
import re

import pytest

import __spark_entry__ as driver
from verification import bindings as bind
from verification.compare import compare, connect
from verification.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql())


def test_flagship_query(spark):
    assert driver.entry(spark).count() == 445


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    """Equal to its SQL; no cross join, Python worker or window over everything."""
    result = QUERIES[name](spark, SMALL)
    text = plan(result)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Arrow", text)
    assert not re.search(r"Window \[[^\n]*\], \[\], \[", text)
    assert compare(result, con, name).startswith("ok")


def test_flats_of_presence_patterns_are_read_from_all_months(spark):
    assert "1996-01" in plan(QUERIES["presence_pattern_flats"](spark, SMALL))
    assert "1996-01" not in plan(QUERIES["presence_pattern_flats_all_months"](spark, SMALL))


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_lag_checks_shuffle_the_readings_once(spark):
    assert len(exchanges(plan(QUERIES["backward_readings"](spark, SMALL)))) == 1
    # stale_runs on readings that are not grouped first, as stored readings are
    from gaugeflow.operators import granular

    rows = granular.Readings(bind.event_readings(spark, SMALL))
    for check in (granular.spike_detection, granular.stale_runs):
        assert len(exchanges(plan(check(rows)))) == 1


@pytest.mark.parametrize("period", ["1996-05", "1995-01:2001-12"])
def test_a_scan_reads_the_readings_twice(spark, period):
    """For report, offenders, statistics and all listings together."""
    from gaugeflow.plans import jobs
    from gaugeflow.sources.workspace import stored

    readings = stored(bind.shipment_readings(spark, SMALL), "readings")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    scan = jobs.detect_discrepancies(readings.mapInArrow(count, readings.schema), period)
    scan.stats.collect(), scan.report.collect()
    for rows in scan.checks.values():
        rows.collect()
    if scan.repeat_offenders is not None:
        scan.repeat_offenders.collect()
    assert seen.value == 2 * readings.count()


def test_daily_values_are_fetched_late(spark):
    text = plan(QUERIES["daily_open_close"](spark, SMALL))
    assert "SortAggregate" not in text.split("Scan parquet")[0] and "BroadcastHashJoin" in text
    assert not any("source_file" in e and "row_idx" in e for e in exchanges(text.split("Generate")[0]))


def test_row_counts_take_one_scan(spark):
    text = plan(QUERIES["row_count_anomalies"](spark, SMALL))
    assert "ts" not in re.findall(r"ReadSchema: struct<([^>]*)>", text)[0] and "row_count" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["flat_readings"](spark, SMALL))
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert re.search(r"ReadSchema: struct<[^>]*>", text)
    assert "props" not in re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
