"""Time-ordered work on keys of any size.

A window over a key puts the whole key into one task, and one meter may hold a third of
all rows. Such keys are cut into slices along the order column; every slice is an own
window partition, and the last row of a slice is handed to the next one as a carry row.

Which keys are large is measured first, by one count per key that is combined map-side
and reads only key and order columns. Without large keys the plan is the plain window.

A large key is cut by its own counts: its rows are counted per narrow bucket of the order
column, and a slice starts wherever the running count passes a multiple of half the target.
An outlier in time costs one bucket, and a slice holds at most half the target and one bucket.

Bounds: the target is min_rows, or 1/MAX_SLICES of all rows if that is more. Keys above it
are at most MAX_SLICES and have at most 3 * MAX_SLICES slices together, whatever the input;
their slice starts are what is collected and broadcast. No large key is left whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.numbers import elapsed_seconds

MAX_SLICES = 100_000
SLICE = "_slice"
# Steps of a binary search among the starts of one key.
_STEPS = [1 << bit for bit in reversed(range((3 * MAX_SLICES).bit_length()))]


@dataclass(frozen=True)
class SlicePolicy:
    """Keys with more than `min_rows` rows are sliced, into slices of less than that.

    Buckets are `bucket_seconds` wide for timestamps, which readings to the second fill with
    as many rows at most, and a sixteenth of `min_rows` for row numbers.
    """

    min_rows: int = 10_000_000
    bucket_seconds: int = 3600


DEFAULT_POLICY = SlicePolicy()


@dataclass(frozen=True)
class SlicedRows:
    """Rows clustered by `cluster`: the keys, and the slice if there are hot keys."""

    rows: DataFrame
    keys: list[str]
    hot: DataFrame | None

    @property
    def cluster(self) -> list[str]:
        return self.keys if self.hot is None else [*self.keys, SLICE]

    def join(self, per_key: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """Join a one-row-per-key table to the rows without shuffling the rows again.

        The table is copied to every slice of its key and joined on (keys, slice): there is
        no hot join key, and only hot keys have more than one copy.
        """
        rows = self.rows if rows is None else rows
        if self.hot is None:
            return rows.join(per_key, self.keys)
        all_slices = F.sequence(F.lit(1), F.size("_starts"))
        only_slice = F.array(F.lit(0))
        copies = (
            per_key.join(F.broadcast(self.hot), self.keys, "left")
            .withColumn(SLICE, F.explode(F.coalesce(all_slices, only_slice)))
            .drop("_starts")
        )
        return rows.join(copies, self.cluster)


def _bucket(df: DataFrame, order: str, policy: SlicePolicy) -> Column:
    """Bucket of the order column, a long that grows with it."""
    if df.schema[order].dataType.typeName() == "timestamp_ntz":
        since = elapsed_seconds(F.lit("1970-01-01").cast("timestamp_ntz"), F.col(order))
        return F.floor(since / policy.bucket_seconds)
    return F.floor(F.col(order) / max(policy.min_rows // 16, 1))


def _slice_of(bucket: Column) -> Column:
    """Number of starts up to the bucket, by binary search."""
    def further(found: Column, step: Column) -> Column:
        return F.when(F.get("_starts", found + step - 1) <= bucket, found + step).otherwise(found)

    search = F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), further)
    return F.when(F.col("_starts").isNotNull(), search).otherwise(F.lit(0))


def hot_keys(
    df: DataFrame, keys: list[str], order: str, policy: SlicePolicy, sizes: DataFrame | None = None
) -> DataFrame | None:
    """The keys to slice as (keys, _starts), or None. Runs one job, a second one if there are any.

    `sizes` (keys, _n) may be given where they are known; then df is read for large keys only.
    """
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = F.ceil(sizes.agg(F.sum("_n").alias("total")).scalar() / MAX_SLICES)
    target = F.greatest(F.lit(policy.min_rows).cast("bigint"), share)
    sized = sizes.withColumn("_target", target).filter(F.col("_n") > F.col("_target")).drop("_n")
    found = sized.collect()
    if not found:
        return None
    large = df.sparkSession.createDataFrame(found, sized.schema)
    so_far = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.select(*keys, _bucket(df, order, policy).alias("_bucket"))
        .join(F.broadcast(large), keys)
        .groupBy(*keys, "_target", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
        .groupBy(*keys, F.floor(2 * F.col("_before") / F.col("_target")).alias("_number"))
        .agg(F.min("_bucket").alias("_start"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_start")).alias("_starts"))
    )
    return df.sparkSession.createDataFrame(starts.collect(), starts.schema)


def lag_in_slices(
    df: DataFrame,
    keys: list[str],
    order: str,
    previous: dict[str, str],
    policy: SlicePolicy = DEFAULT_POLICY,
    measured: DataFrame | None = None,
    sizes: DataFrame | None = None,
    tasks: int | None = None,
) -> SlicedRows:
    """Add the previous row's values per key: `previous` maps new column -> source column.

    `order` must be unique per key and the source columns must not be NULL, so that a NULL
    result means "no previous row". Key sizes are taken from `measured` where counting df
    itself would be costly; it must hold all rows of df. The rows are shuffled once, into `tasks`
    partitions if that is given.
    """
    hot = hot_keys(df if measured is None else measured, keys, order, policy, sizes)

    def with_lag(rows: DataFrame, cluster: list[str]) -> DataFrame:
        before = Window.partitionBy(*cluster).orderBy(order)
        rows = rows if tasks is None else rows.repartition(tasks, *cluster)
        return rows.withColumns(
            {name: F.lag(source).over(before) for name, source in previous.items()}
        )

    if hot is None:
        return SlicedRows(with_lag(df, keys), keys, None)

    sliced = (
        df.join(F.broadcast(hot), keys, "left")
        .withColumn(SLICE, _slice_of(_bucket(df, order, policy)))
    )
    carried = sorted({*previous.values()} - {order})
    last_rows = (
        sliced.filter(F.col("_starts").isNotNull())
        .groupBy(*keys, SLICE)
        .agg(
            *[F.max_by(name, order).alias(name) for name in carried],
            F.max(order).alias(order),
        )
    )
    next_slice = F.lead(SLICE).over(Window.partitionBy(*keys).orderBy(SLICE))
    carry_rows = last_rows.withColumn(SLICE, next_slice).filter(F.col(SLICE).isNotNull())
    both = (
        sliced.select(*df.columns, SLICE)
        .withColumn("_carry", F.lit(False))
        .unionByName(carry_rows.withColumn("_carry", F.lit(True)), allowMissingColumns=True)
    )
    lagged = with_lag(both, [*keys, SLICE]).filter(~F.col("_carry")).drop("_carry")
    return SlicedRows(lagged, keys, hot)
