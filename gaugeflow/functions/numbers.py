"""Number handling that gives the same answer whatever the partitioning is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


DECIMAL_BOUND = 1e17
DIGIT_BITS = 45
# A double's exponent lies in -1074..1023; bin b starts at exponent DIGIT_BITS * b.
_FIRST_BIN, _LAST_BIN = -25, 24
_UNIT_SHIFT = 54


def _integer(value: int) -> Column:
    return F.lit(value).cast("decimal(38,0)")


def _powers_of_two(exponents: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{2.0**e!r}D' for e in exponents)})")


def _six_digits(value: Column) -> Column:
    """Six-digit decimal part of a double; zero for values that a decimal does not hold."""
    return F.when(F.abs(value) < DECIMAL_BOUND, value.try_cast("decimal(24,6)")).when(
        value.isNotNull(), F.lit(0).cast("decimal(24,6)")
    )


def _scaled(value: Column, bin_: Column, up: bool) -> Column:
    """Value times the unit of a bin, 2**(DIGIT_BITS * bin - 54), or divided by it.

    Two factors from a table of powers of two, as one would leave the range of a double.
    """
    sign = 1 if up else -1
    shifts = [sign * (DIGIT_BITS * b - _UNIT_SHIFT) for b in range(_FIRST_BIN, _LAST_BIN + 3)]
    halves = _powers_of_two([shift // 2 for shift in shifts])
    others = _powers_of_two([shift - shift // 2 for shift in shifts])
    at = (bin_ - F.lit(_FIRST_BIN)).cast("int")
    return value * F.get(halves, at) * F.get(others, at)


def _parts(rows: DataFrame, value: Column) -> DataFrame:
    """Rows with the exact parts of a double: decimal, bin with two digits, and what is not finite.

    What the decimal leaves is an integer of at most 100 bits in units of its bin. Its lower 45
    bits are a digit of this bin and the upper ones of the next bin.
    """
    rest = F.col("_value") - F.col("_decimal").cast("double")
    finite = (F.abs("_rest") < float("inf")) & (F.col("_rest") != 0)
    bin_ = F.floor(F.floor(F.log2(F.abs("_rest"))) / DIGIT_BITS).cast("int")
    upper = F.floor(F.col("_whole") / float(1 << DIGIT_BITS))
    lower = F.col("_whole") - upper.cast("double") * float(1 << DIGIT_BITS)
    return (
        rows.withColumn("_value", value.cast("double"))
        .withColumn("_decimal", _six_digits(F.col("_value")))
        .withColumn("_rest", rest)
        .withColumn("_bin", F.when(finite, bin_))
        .withColumn("_whole", _scaled(F.col("_rest"), F.col("_bin"), up=False))
        .withColumn("_upper", upper.cast("decimal(28,0)"))
        .withColumn("_lower", lower.cast("bigint").cast("decimal(28,0)"))
        .withColumn("_other", F.when(~finite & (F.col("_rest") != 0), F.col("_rest")))
    )


_PART_COLUMNS = ["_value", "_decimal", "_rest", "_bin", "_whole", "_upper", "_lower", "_other"]


def _bin_sums() -> Column:
    return F.struct(
        F.col("_bin").alias("bin"), F.col("_upper").cast("decimal(38,0)").alias("upper"),
        F.col("_lower").cast("decimal(38,0)").alias("lower"),
    )


def _folded(bins: Column) -> Column:
    """Double of the exact number that the digits of at most 50 bins make up."""
    def digit(place: Column) -> Column:
        return F.aggregate(bins, _integer(0), lambda total, x: (
            total + F.when(x["bin"] == place, x["lower"]).when(x["bin"] == place - 1, x["upper"]).otherwise(_integer(0))
        ).cast("decimal(38,0)"))

    def carried(sign: int) -> Column:
        def step(state: Column, place: Column) -> Column:
            total = (state["carry"] + _integer(sign) * digit(place)).cast("decimal(38,0)")
            base = _integer(1 << DIGIT_BITS)
            rest = F.pmod(total, base).cast("decimal(38,0)")
            carry = F.call_function("div", (total - rest).cast("decimal(38,0)"), base).cast("decimal(38,0)")
            entry = F.struct(place.alias("bin"), rest.cast("double").alias("digit"))
            return F.struct(carry.alias("carry"), F.array_append(state["digits"], entry).alias("digits"))

        places = F.sequence(
            F.array_min(F.transform(bins, lambda x: x["bin"])), F.array_max(F.transform(bins, lambda x: x["bin"])) + 2)
        start = F.struct(_integer(0).alias("carry"), F.array().cast("array<struct<bin:int,digit:double>>").alias("digits"))
        return F.aggregate(places, start, step)

    def added(digits: Column) -> Column:
        return F.aggregate(
            F.reverse(digits), F.lit(0.0), lambda total, x: total + _scaled(x["digit"], x["bin"], up=True))

    plus, minus = carried(1), carried(-1)
    return F.when(F.size(bins) == 0, F.lit(0.0)).when(plus["carry"] < 0, -added(minus["digits"])).otherwise(
        added(plus["digits"]))


def exact_totals(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """keys, total, n, low and high of doubles per key, whatever the order of the rows.

    Six-digit decimal parts are added exactly, so a total of 0.1 + 0.2 - 0.3 is zero. What the
    decimal leaves of a value (digits from the seventh on, values beyond 1e17) is added as
    integers per exponent bin, of which a key has at most 50; only the end is rounded. Infinity
    and NaN are added as doubles. Nulls are left out, and a key without values has a null total.
    Sums per key and bin are combined before the shuffle; a key of any size is one row per task and bin.
    """
    per_bin = (
        _parts(rows.select(*keys, value.cast("double").alias("_given")), F.col("_given"))
        .groupBy(*keys, "_bin")
        .agg(
            F.sum("_decimal").alias("_decimal"), F.sum("_upper").alias("_upper"), F.sum("_lower").alias("_lower"),
            F.sum("_other").alias("_other"), F.count("_value").alias("n"),
            F.min("_value").alias("low"), F.max("_value").alias("high"),
        )
    )
    return (
        per_bin.groupBy(*keys)
        .agg(
            F.sum("_decimal").alias("_decimal"), F.sum("_other").alias("_other"), F.sum("n").alias("n"),
            F.min("low").alias("low"), F.max("high").alias("high"),
            F.collect_list(F.when(F.col("_bin").isNotNull(), _bin_sums())).alias("_bins"),
        )
        .select(
            *keys,
            (F.col("_decimal").cast("double") + _folded(F.col("_bins")) + F.coalesce("_other", F.lit(0.0)))
            .alias("total"),
            "n", "low", "high",
        )
    )


def with_exact_total(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Rows with the total of their key as `name`, the same as `exact_totals` to the last bit.

    Windows over the keys and over keys and bin share one sort; nothing is shuffled if the rows
    are clustered by the keys. The digits of a key are put together once per bin.
    """
    per_key, per_bin = Window.partitionBy(*keys), Window.partitionBy(*keys, "_bin")
    earlier = F.lag("_bin").over(per_key.orderBy("_bin"))
    first_of_bin = F.col("_bin").isNotNull() & F.col("_first")
    return (
        _parts(rows, value)
        .withColumns({
            "_upper": F.sum("_upper").over(per_bin), "_lower": F.sum("_lower").over(per_bin),
            "_first": ~earlier.eqNullSafe(F.col("_bin")),
        })
        .withColumns({
            "_bins": F.collect_list(F.when(first_of_bin, _bin_sums())).over(per_key),
            "_decimal": F.sum("_decimal").over(per_key), "_other": F.sum("_other").over(per_key),
        })
        .withColumn("_folded", F.max(F.when(first_of_bin, _folded(F.col("_bins")))).over(per_key))
        .withColumn(
            name, F.col("_decimal").cast("double") + F.coalesce("_folded", F.lit(0.0)) + F.coalesce("_other", F.lit(0.0))
        )
        .drop(*_PART_COLUMNS, "_first", "_bins", "_folded")
    )


SHARE_UNIT = float(1 << 60)


def sum_of_shares(share: Column, over: WindowSpec | None = None) -> Column:
    """Total of doubles between 0 and 1, added as integers of 2**-60, so in any order the same.

    For totals of at least about 1 that is finer than a double. NaN makes the total NaN.
    """
    units = F.when(share <= 1.0, F.rint(share * SHARE_UNIT).cast("bigint").cast("decimal(28,0)"))
    sums = F.sum(units), F.sum(F.when(share > 1.0, share))
    if over is not None:
        sums = sums[0].over(over), sums[1].over(over)
    whole = F.when(sums[0].isNotNull() | sums[1].isNotNull(), F.coalesce(sums[0].cast("double"), F.lit(0.0)))
    return whole / SHARE_UNIT + F.coalesce(sums[1], F.lit(0.0))


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double by scaling it, ties away from zero.

    F.round works on the shortest decimal text (1.005 -> 1.01); scaling gives 1.0 as the
    double arithmetic of the SQL this replaces does. A value without digits to round away
    (2**52 and more once scaled, infinity, NaN) stays as it is.
    """
    scale = float(10**digits)
    scaled = F.abs(value) * scale
    return F.when(scaled >= 2.0**52, value).otherwise(
        F.signum(value) * F.floor(scaled + 0.5) / scale
    )


def float_text(value: Column) -> Column:
    """Double as positional text with at least one decimal (12.0, 12345678.25).

    Casting to string switches to exponents from 1.0E7 on; remarks should not.
    """
    positional = F.regexp_replace(
        value.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1"
    )
    size = F.abs(value)
    plain = (value == 0) | ((size >= 1e-4) & (size < 1e16))
    return F.when(plain, positional).otherwise(value.cast("string"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two zone-less timestamps (no session zone involved)."""
    return (end - start).cast("bigint")
