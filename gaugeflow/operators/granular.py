"""Checks on the readings themselves (D0..D7).

Every check takes readings that are already cut to the period, so the first reading in
scope has no predecessor.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import elapsed_seconds, exact_totals, round_half_away, sum_of_shares, with_exact_total
from gaugeflow.functions.period import month_of, month_start
from gaugeflow.operators.slices import DEFAULT_POLICY, SLICE, SlicedRows, SlicePolicy, lag_in_slices
from gaugeflow.schemas import METER, METER_WINDOW
from gaugeflow.sources.workspace import partitions

ROWS_PER_TASK = 500_000


def _month() -> Column:
    return month_of(F.col("recorded_at")).alias("month")


def _month_start() -> Column:
    return month_start(F.col("recorded_at")).alias("month")


class Readings:
    """Readings in scope; the lagged rows are declared once and shared by three checks.

    `measured` may name a cheaper superset of the rows to take meter sizes from, where the
    readings are themselves the result of a shuffle; `days` their day states, if they are stored.
    """

    def __init__(
        self,
        scoped: DataFrame,
        policy: SlicePolicy = DEFAULT_POLICY,
        measured: DataFrame | None = None,
        days: DataFrame | None = None,
    ):
        self.scoped = scoped
        self.policy = policy
        self.sizes = None if days is None else days.groupBy(*METER_WINDOW).agg(F.sum("n").alias("_n"))
        self.tasks = None if days is None else partitions(days, F.sum("n"), ROWS_PER_TASK)
        self.measured = scoped if measured is None else measured

    @cached_property
    def lagged(self) -> SlicedRows:
        values = self.scoped.filter(F.col("reading_value").isNotNull()).select(
            *METER, "recorded_at", "reading_value"
        )
        return lag_in_slices(
            values,
            METER_WINDOW,
            "recorded_at",
            {"prev_value": "reading_value", "prev_time": "recorded_at"},
            self.policy,
            self.measured,
            self.sizes,
            self.tasks,
        )


def day_states(scoped: DataFrame) -> DataFrame:
    """What statistics, zero consumption, gaps and missing values need to know of a meter's day.

    All parts can be merged over days; a day of 96 readings becomes one row.
    """
    value, time = F.col("reading_value"), F.col("recorded_at")
    missing = F.when(value.isNull(), time)
    return scoped.groupBy(*METER, F.to_date("recorded_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("lo"), F.max(time).alias("hi"),
        F.count(value).alias("n_values"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.min(missing).alias("first_null"), F.max(missing).alias("last_null"),
    )


def _month_of_day() -> Column:
    return F.trunc("day", "month").alias("month")


def scan_stats(scoped: DataFrame) -> DataFrame:
    """One row of scope statistics; distinct counts run on the pre-grouped meter months."""
    return _stats(scoped.groupBy(*METER, _month_start()).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("recorded_at").alias("lo"),
        F.max("recorded_at").alias("hi"),
    ))


def scan_stats_of_days(days: DataFrame) -> DataFrame:
    return _stats(days.groupBy(*METER, _month_of_day()).agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def _stats(per_month: DataFrame) -> DataFrame:
    return per_month.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        F.countDistinct("given_flat_id").alias("distinct_flats"),
        F.countDistinct("utility_type").alias("distinct_utilities"),
        F.min("lo").alias("earliest"),
        F.max("hi").alias("latest"),
        F.countDistinct("month").alias("months_covered"),
    )


def backward_readings(readings: Readings) -> DataFrame:
    return (
        readings.lagged.rows.filter(F.col("reading_value") < F.col("prev_value"))
        .select(
            *METER, _month(), "recorded_at", "reading_value", "prev_value",
            (F.col("reading_value") - F.col("prev_value")).alias("delta"),
        )
    )


def zero_consumption(scoped: DataFrame) -> DataFrame:
    return (
        scoped.filter(F.col("reading_value").isNotNull())
        .groupBy(*METER, _month_start())
        .agg(
            F.min("reading_value").alias("min_val"),
            F.max("reading_value").alias("max_val"),
            F.count(F.lit(1)).alias("num_readings"),
        )
        .filter((F.col("min_val") == F.col("max_val")) & (F.col("num_readings") > 1))
        .withColumn("month", month_of(F.col("month")))
    )


def zero_consumption_of_days(days: DataFrame) -> DataFrame:
    return (
        days.filter(F.col("n_values") > 0)
        .groupBy(*METER, _month_of_day())
        .agg(F.min("low").alias("min_val"), F.max("high").alias("max_val"), F.sum("n_values").alias("num_readings"))
        .filter((F.col("min_val") == F.col("max_val")) & (F.col("num_readings") > 1))
        .withColumn("month", month_of(F.col("month")))
    )


def gap_detection(scoped: DataFrame) -> DataFrame:
    """Meter days with fewer than 80% of the day's median count.

    The median sees one count per meter and day. It keeps the distinct counts of a day with
    their frequency, and d distinct counts need at least d(d+1)/2 readings, so the state is
    below sqrt(2 x readings of the day). Medians are one row per calendar day of the scope.
    """
    per_day = scoped.groupBy(*METER, F.to_date("recorded_at").alias("reading_date")).agg(
        F.count(F.lit(1)).alias("readings_per_day")
    )
    return _gaps(per_day)


def gap_detection_of_days(days: DataFrame) -> DataFrame:
    return _gaps(days.select(*METER, F.col("day").alias("reading_date"), F.col("n").alias("readings_per_day")))


def _gaps(per_day: DataFrame) -> DataFrame:
    medians = per_day.groupBy("reading_date").agg(
        F.median("readings_per_day").alias("median_count")
    )
    n, median = F.col("readings_per_day"), F.col("median_count")
    return (
        per_day.join(medians, "reading_date")
        .filter((median > 0) & (n < F.lit(0.8) * median))
        .select(
            *METER, "reading_date", "readings_per_day", "median_count",
            round_half_away(F.lit(100.0) * n / F.nullif(median, F.lit(0.0)), 1)
            .alias("pct_of_median"),
        )
    )


def spike_detection(readings: Readings) -> DataFrame:
    """Increases more than three standard deviations above the meter's mean increase.

    Mean and deviation are windows over the rows that are already clustered by meter. For
    sliced meters they are combined map-side and joined back to the slices instead. Both ways
    add the same parts exactly: squares of the distance from the mean as a share of the widest
    one, so that neither the order of rows nor their size changes the sum.
    """
    lagged, delta = readings.lagged, F.col("delta")
    steps = lagged.rows.withColumn("delta", F.col("reading_value") - F.col("prev_value")).filter(
        delta >= 0
    )
    widest = F.greatest(F.col("high") - F.col("mean"), F.col("mean") - F.col("low"))
    share = (delta - F.col("mean")) / F.nullif(widest, F.lit(0.0))
    mean = F.col("total") / F.nullif(F.col("n"), F.lit(0))
    if lagged.hot is None:
        meter = Window.partitionBy(*METER_WINDOW)
        scored = with_exact_total(steps, METER_WINDOW, delta, "total").withColumns(
            {"low": F.min(delta).over(meter), "high": F.max(delta).over(meter), "n": F.count(delta).over(meter)}
        ).withColumn("mean", mean)
        scored = scored.withColumn("squares", sum_of_shares(share * share, over=meter))
    else:
        firsts = exact_totals(steps, METER, delta).withColumn("mean", mean).drop("total")
        centred = lagged.join(firsts, steps)
        squares = centred.groupBy(*METER).agg(sum_of_shares(share * share).alias("squares"))
        scored = lagged.join(squares, centred)
    std = widest * F.sqrt(F.col("squares") / F.nullif(F.col("n") - 1, F.lit(0)))
    scored = scored.withColumn("std", std)
    z = (delta - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
    return (
        scored.filter((delta > 0) & (z > 3))
        .select(
            *METER, _month(), "recorded_at",
            round_half_away(delta, 4).alias("delta"),
            round_half_away(F.col("mean"), 4).alias("mean_delta"),
            round_half_away(F.col("std"), 4).alias("std_delta"),
            round_half_away(z, 2).alias("z_score"),
        )
    )


def stale_runs(readings: Readings, longer_than_hours: int = 24) -> DataFrame:
    """Stretches of one unchanged value that last longer than a day.

    A run is named by the time of the last change before it, a running maximum. In a sliced
    meter it is known only inside the slice; fragments of runs that began earlier get it
    from the slices before, of which there is one row each, and are then put together.
    """
    lagged = readings.lagged
    changed_at = F.when(F.col("reading_value") != F.col("prev_value"), F.col("recorded_at"))
    so_far = (
        Window.partitionBy(*lagged.cluster)
        .orderBy("recorded_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = lagged.rows.filter(F.col("prev_value").isNotNull())
    runs = (
        rows.withColumn("run", F.max(changed_at).over(so_far))
        .filter(F.col("reading_value") == F.col("prev_value"))
        .groupBy(*lagged.cluster, "run")
        .agg(
            F.min("prev_time").alias("first"),
            F.max("recorded_at").alias("last"),
            F.max("reading_value").alias("value"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    if lagged.hot is not None:
        runs = _join_fragments(runs, rows.withColumn("change", changed_at))
    longer = F.col("last") - F.col("first") > F.make_dt_interval(hours=F.lit(longer_than_hours))
    return runs.filter(longer).select(
        *METER,
        F.col("first").alias("stale_from"),
        F.col("last").alias("stale_until"),
        F.col("value").alias("reading_value"),
        F.col("n").alias("consecutive_same"),
        elapsed_seconds(F.col("first"), F.col("last")).alias("stale_seconds"),
    )


def _join_fragments(fragments: DataFrame, rows: DataFrame) -> DataFrame:
    """Runs of sliced meters (slice > 0) put together from their fragments per slice."""
    columns = [*METER, "first", "last", "value", "n"]
    earlier = (
        Window.partitionBy(*METER_WINDOW).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    inherited = (
        rows.filter(F.col(SLICE) > 0)
        .groupBy(*METER_WINDOW, SLICE)
        .agg(F.max("change").alias("change"))
        .select(*METER, SLICE, F.max("change").over(earlier).alias("inherited"))
    )
    joined = (
        fragments.filter(F.col(SLICE) > 0)
        .join(inherited, [*METER_WINDOW, SLICE], "left")
        .groupBy(*METER, F.coalesce("run", "inherited").alias("run"))
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.max("value").alias("value"),
            F.sum("n").alias("n"),
        )
    )
    whole = fragments.filter(F.col(SLICE) == 0)
    return whole.select(*columns).unionByName(joined.select(*columns))


def null_readings(scoped: DataFrame) -> DataFrame:
    """Missing values per meter; a meter's distinct months are a short set."""
    return (
        scoped.filter(F.col("reading_value").isNull())
        .groupBy(*METER)
        .agg(
            F.count(F.lit(1)).alias("null_count"),
            F.size(F.collect_set(_month_start())).cast("bigint").alias("months_affected"),
            F.min("recorded_at").alias("first_null"),
            F.max("recorded_at").alias("last_null"),
        )
    )


def null_readings_of_days(days: DataFrame) -> DataFrame:
    return (
        days.filter(F.col("n") > F.col("n_values"))
        .groupBy(*METER)
        .agg(
            F.sum(F.col("n") - F.col("n_values")).alias("null_count"),
            F.size(F.collect_set(_month_of_day())).cast("bigint").alias("months_affected"),
            F.min("first_null").alias("first_null"),
            F.max("last_null").alias("last_null"),
        )
    )


def out_of_order(scoped: DataFrame) -> DataFrame:
    """Readings earlier than their predecessor in the same file and meter.

    The predecessor is taken in time order, so the result is always empty; the check is
    kept because reports list it. Nothing is read for it.
    """
    return scoped.filter(F.lit(False)).select(
        "source_file", *METER, F.col("recorded_at").alias("prev_time"), "recorded_at",
        F.lit(0).cast("bigint").alias("gap_seconds"),
    )
