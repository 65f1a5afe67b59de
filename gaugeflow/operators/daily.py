"""Daily opening and closing values per flat, straight from the sheets (A14..A17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.cells import parse_time_24h, present
from gaugeflow.operators.sheets import (
    drop_repeated_times, flat_cells, parse_filenames, sheet_columns,
)
from gaugeflow.operators.slices import DEFAULT_POLICY, SlicePolicy
from gaugeflow.sources.workspace import stored

DAILY_COLUMNS = ["Type_of_utility", "given_flat_id", "date", "starting_reading", "closing_reading"]
SHEET_ORDER = ["source_file", "first_row", "col_idx"]


def daily_open_close(sheet_rows: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Values in the first and last sheet row of each day, where both are present.

    A day's first and last row are the same for all flats. They are found on row numbers and
    times alone and stored; then they are fetched from the grid, 2 of a day's 96 rows, and only
    they are unpivoted. The stored numbers are small enough to be broadcast unless the grid has
    some hundred million rows; beyond that a join by row number takes their place.
    """
    kept = drop_repeated_times(sheet_rows, parse_time_24h, policy, with_cells=False)
    days = kept.rows.groupBy("source_file", F.to_date("recorded_at").alias("day")).agg(
        F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row")
    )
    both = F.array_distinct(F.array("first_row", "last_row"))
    wanted = stored(days.select("source_file", "day", "first_row", F.explode(both).alias("row_idx")), "day-rows")
    fetched = sheet_rows.select("source_file", "row_idx", "cells").join(wanted, ["source_file", "row_idx"])
    of_day = Window.partitionBy("source_file", "day").orderBy("row_idx")
    pairs = (
        fetched.withColumn("closing", F.coalesce(F.lead("cells").over(of_day), F.col("cells")))
        .filter(F.col("row_idx") == F.col("first_row"))
        .withColumnRenamed("cells", "opening")
    )
    return (
        pairs.join(sheet_columns(sheet_rows, strip_tower_letter=False), "source_file")
        .select(
            "source_file", "first_row", "utility_type", "day",
            F.inline(flat_cells(opening="opening", closing="closing")),
        )
        .select(
            *SHEET_ORDER,
            F.col("utility_type").alias("Type_of_utility"),
            "given_flat_id",
            F.date_format("day", "dd-MM-yyyy").alias("date"),
            present(F.col("opening")).alias("starting_reading"),
            present(F.col("closing")).alias("closing_reading"),
        )
        .filter(F.col("starting_reading").isNotNull() & F.col("closing_reading").isNotNull())
    )


def unusable_files(files: DataFrame) -> DataFrame:
    """Files (source_file, maybe damage) that give no daily records, and why."""
    damage = F.col("damage") if "damage" in files.columns else F.lit(None).cast("string")
    return (
        parse_filenames(files)
        .select("source_file", F.coalesce("reject_reason", damage).alias("reject_reason"))
        .filter(F.col("reject_reason").isNotNull())
    )


def write_daily_csv(daily: DataFrame, path: str) -> None:
    """Daily records as CSV in file, day and column order (unique, so ranges are even)."""
    (
        daily.orderBy(*SHEET_ORDER)
        .select(*DAILY_COLUMNS)
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
