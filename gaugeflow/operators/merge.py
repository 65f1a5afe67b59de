"""Keyed merges without a table format (A9, B2, E10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_upsert(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows (unique by key) plus the existing rows they do not replace."""
    return incoming.unionByName(unreplaced(existing, incoming, key))


def unreplaced(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows that no incoming row replaces.

    Never by a broadcast: files of sorted keys are small, the hash table of their rows is not.
    """
    return existing.join(incoming.select(*key).hint("merge"), key, "left_anti")


def first_per_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key; `order` decides and must be unique.

    A minimum over (order, rest) is combined map-side: copies of one key never meet in one
    task, as they would in a row_number window.
    """
    rest = [name for name in rows.columns if name not in {*key, *order}]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return rows.groupBy(*key).agg(first).select(*key, "_first.*").select(*rows.columns)


def insert_if_absent(
    existing: DataFrame, batch: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """Rows of the batch to append: first per key, and the key not stored yet."""
    return first_per_key(batch, key, order).join(existing.select(*key), key, "left_anti")
