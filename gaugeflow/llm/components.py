"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is two keyed aggregations and joins over the links, never a pass over a group in one
task; each round is cut off by a checkpoint in the shared folder. A node with many links is dealt
over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.sources.workspace import checkpoint_dir

SHARES = 256  # a key with more than one part in so many of all rows is dealt out
LEAST_SHARE = 100


def join_per_key(
    rows: DataFrame, per_key: DataFrame, key: str, total: int, counts: DataFrame | None = None
) -> DataFrame:
    """Inner join of rows (about `total`) to one row per key, which has the key's row count as `n`
    (also in `counts`, where that is cheaper to read).

    Keys beyond a share of all rows, of which there are at most SHARES, are broadcast; their rows
    are dealt over copies of the key's row. Null keys have no partner.
    """
    pieces = F.ceil(F.col("n") / max(total / SHARES, LEAST_SHARE)).cast("int")
    sized = per_key.withColumn("pieces", F.greatest(pieces, F.lit(1)))
    hot = (per_key if counts is None else counts).select(F.col(key).alias("hot_key"), pieces.alias("hot_pieces"))
    hot = hot.filter("hot_pieces > 1")
    dealt = (
        rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
        .withColumn("piece", F.pmod(F.monotonically_increasing_id(), F.coalesce("hot_pieces", F.lit(1))).cast("int"))
        .drop("hot_key", "hot_pieces")
    )
    copies = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces", "n")
    return dealt.join(copies, [key, "piece"]).drop("piece")


def _large_star(links: DataFrame, total: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select(
        "u", F.least("u", "m").alias("m"), "n")
    return (
        join_per_key(both.filter("v > u"), least, "u", 2 * total)
        .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
    )


def _small_star(links: DataFrame, total: int) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = join_per_key(down, least, "u", total).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: every node of the links (long columns u, v) with the least node reachable."""
    checkpoint_dir(links.sparkSession)
    links = links.filter("u != v").distinct().checkpoint()
    total, seen = links.count(), None
    while True:
        links = _small_star(_large_star(links, total), total).checkpoint()
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or state.n == 0:
            break
        seen, total = state, state.n
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
