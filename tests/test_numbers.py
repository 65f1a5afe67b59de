"""Totals and rounding keep every value, whatever the order of the rows."""

import math
import random
import struct
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import exact_totals, round_half_away, sum_of_shares, with_exact_total


def bits(value):
    return None if value is None else struct.pack(">d", value)


def both_totals(frame):
    """Total of column v per key k, as an aggregate and over windows; both must be the same."""
    grouped = {r.k: r.total for r in exact_totals(frame, ["k"], F.col("v")).collect()}
    windows = {}
    for row in with_exact_total(frame, ["k"], F.col("v"), "total").collect():
        windows.setdefault(row.k, set()).add(bits(row.total))
    assert windows == {k: {bits(total)} for k, total in grouped.items()}
    return grouped


@pytest.mark.parametrize(
    ("values", "total"),
    [
        ([4e-7, 3e-7], 7e-7),
        ([1e18, 3e18, 4.0], 4e18 + 4),
        ([0.1, 0.2, -0.3], 0.0),
        ([1e-7, -1e-7], 0.0),
        ([math.inf, 1.0], math.inf),
        ([math.inf, -math.inf], math.nan),
        ([math.nan, 1.0], math.nan),
        ([1e15, 0.25], 1e15 + 0.25),
        ([None, 2.0], 2.0),
        ([None], None),
        ([1e300, 1e-300, -1e300], 1e-300),
        ([-1e300, 1e200, 1e300, -1e200, -5e-324], -5e-324),
        ([2.0**1000, -(2.0**947), -(2.0**1000)], -(2.0**947)),
    ],
)
def test_totals(spark, values, total):
    frame = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    found = both_totals(frame)["a"]
    row = exact_totals(frame, ["k"], F.col("v")).first()
    known = [v for v in values if v is not None]
    assert row.n == len(known)
    if total is not None and math.isnan(total):
        assert math.isnan(found)
        return
    assert found == (total if total is None else pytest.approx(total, rel=1e-15, abs=0))
    assert (row.low, row.high) == ((min(known), max(known)) if known else (None, None))


def exact(values):
    """Six-digit decimals and what they leave, added as fractions."""
    decimals = leftovers = Fraction(0)
    for v in values:
        part = Decimal(repr(v)).quantize(Decimal("1e-6"), ROUND_HALF_UP) if abs(v) < 1e17 else Decimal(0)
        decimals += Fraction(part)
        leftovers += Fraction(v - float(part))
    return float(decimals), float(leftovers)


def test_totals_are_bit_equal_under_any_partitioning(spark):
    chance = random.Random(3)
    wide = [chance.choice([-1, 1]) * chance.random() * 10.0 ** chance.randint(-300, 300) for _ in range(1500)]
    # what is large cancels, so that the total hangs on the small values
    rows = [("wide", v) for v in wide] + [("cancelled", v) for v in wide] + [("cancelled", -v) for v in wide]
    rows += [("cancelled", 3e-200)] + [("meter", chance.random() * 1e4) for _ in range(1500)]
    rows += [("steps", chance.choice([-1, 1]) * chance.random() * 10.0 ** chance.randint(-12, 3)) for _ in range(1500)]
    seen = set()
    for seed in range(20):
        chance.shuffle(rows)
        frame = spark.createDataFrame(rows, "k string, v double").repartition(chance.randint(1, 12), F.rand(seed))
        totals = both_totals(frame) if seed < 3 else {
            r.k: r.total for r in exact_totals(frame, ["k"], F.col("v")).collect()}
        seen.add(tuple(sorted((k, bits(v)) for k, v in totals.items())))
    assert len(seen) == 1
    for key, total in totals.items():
        decimals, leftovers = exact([v for k, v in rows if k == key])
        assert total == pytest.approx(decimals + leftovers, rel=1e-15, abs=0)


def test_shares_are_added_in_any_order(spark):
    chance = random.Random(4)
    values = [1.0, 0.0, 1e-12] + [chance.random() ** 9 for _ in range(2000)]
    seen = set()
    for seed in range(5):
        chance.shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(seed + 1, F.rand(seed))
        seen.add(bits(frame.agg(sum_of_shares(F.col("v"))).first()[0]))
    assert len(seen) == 1 and struct.unpack(">d", seen.pop())[0] == pytest.approx(math.fsum(values), rel=1e-15, abs=0)
    for given, total in [([None], None), ([0.5, None], 0.5)]:
        frame = spark.createDataFrame([(v,) for v in given], "v double")
        assert frame.agg(sum_of_shares(F.col("v"))).first()[0] == total
    frame = spark.createDataFrame([(0.5,), (math.nan,)], "v double")
    assert math.isnan(frame.agg(sum_of_shares(F.col("v"))).first()[0])


def test_totals_of_nothing(spark):
    frame = spark.createDataFrame([], "k string, v double")
    assert both_totals(frame) == {}


@pytest.mark.parametrize(
    ("value", "rounded"),
    [(1.5e15, 1.5e15), (math.inf, math.inf), (-math.inf, -math.inf), (-2.00005, -2.0001), (1e300, 1e300), (0.0, 0.0)],
)
def test_rounding(spark, value, rounded):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(round_half_away(F.col("v"), 4)).first()[0] == rounded
