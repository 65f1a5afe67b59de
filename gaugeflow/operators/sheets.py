"""Sheet rows to long readings (A2, A4..A8).

A sheet row is (source_file, row_idx, cells): one row of the grid, its cells as text.
Row-level work (time parsing, repeated rows) is done before the cells are unpivoted, so
it runs and shuffles once per row and not once per cell.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import cells as cell
from gaugeflow.operators.slices import DEFAULT_POLICY, SlicedRows, SlicePolicy, lag_in_slices
from gaugeflow.schemas import READING_COLUMNS

HEADER_ROW, FIRST_DATA_ROW = 1, 3
SHEET_POSITION = ["source_file", "row_idx", "col_idx"]


def rows_from_cells(cells: DataFrame) -> DataFrame:
    """Cell table (source_file, row_idx, col_idx, cell) to sheet rows; absent cells are NULL.

    A group is one grid row, which the sheet format bounds to its column limit.
    """
    in_order = F.sort_array(F.collect_list(F.struct("col_idx", "cell")))
    complete = F.size("_row") == F.col("_last") + 1
    filled = F.transform(
        F.sequence(F.lit(0), "_last"),
        lambda i: F.try_element_at(F.map_from_entries("_row"), i),
    )
    return (
        cells.groupBy("source_file", "row_idx")
        .agg(F.max("col_idx").alias("_last"), in_order.alias("_row"))
        .select(
            "source_file", "row_idx",
            F.when(complete, F.col("_row.cell")).otherwise(filled).alias("cells"),
        )
    )


def parse_filenames(files: DataFrame) -> DataFrame:
    """Add tower_letter, tower_name, utility_type and reject_reason (NULL if usable)."""
    words, letter = F.col("_words"), F.col("tower_letter")
    problem = (
        F.when((F.size(words) < 3) | (F.get(words, F.lit(0)) != "T"), "unexpected file name")
        .when(F.col("tower_name").isNull(), "unknown tower")
        .when(F.col("utility_type").isNull(), "unknown utility")
    )
    return (
        files.withColumn("_words", cell.name_words(F.col("source_file")))
        .withColumns(
            {"tower_letter": cell.tower_letter(words), "utility_type": cell.utility_type(words)}
        )
        .withColumn("tower_name", cell.tower_name(letter))
        .withColumn("reject_reason", problem)
        .drop("_words")
    )


def _header_flats(flat_id: Column) -> Column:
    """Header cells to (col_idx, flat_id, given_flat_id) for the columns that name a flat."""
    named = F.transform(
        "cells",
        lambda header, i: F.struct(
            i.alias("col_idx"), cell.present(header).alias("header")
        ),
    )
    return F.transform(
        F.filter(named, lambda c: (c["col_idx"] > 0) & c["header"].isNotNull()),
        lambda c: F.struct(
            c["col_idx"].alias("col_idx"),
            flat_id(c["header"]).alias("flat_id"),
            F.concat(F.col("tower_name"), flat_id(c["header"])).alias("given_flat_id"),
        ),
    )


def sheet_columns(sheet_rows: DataFrame, strip_tower_letter: bool = True) -> DataFrame:
    """One row per file with a usable name: its tower, utility and list of flat columns."""
    def flat_id(header: Column) -> Column:
        if strip_tower_letter:
            return cell.normalize_flat_id(header, F.col("tower_letter"))
        return cell.raw_flat_id(header)

    headers = sheet_rows.filter(F.col("row_idx") == HEADER_ROW)
    return (
        parse_filenames(headers)
        .filter(F.col("reject_reason").isNull())
        .select(
            "source_file", "tower_name", "utility_type", _header_flats(flat_id).alias("flats")
        )
    )


TIME_CELL = "time_cell"


def with_time_cell(sheet_rows: DataFrame) -> DataFrame:
    """With the first cell as a column of its own, which is stored apart from the wide rows."""
    return sheet_rows.withColumn(TIME_CELL, cell.present(F.get("cells", F.lit(0))))


def _time_cell(sheet_rows: DataFrame) -> Column:
    return F.col(TIME_CELL) if TIME_CELL in sheet_rows.columns else cell.present(F.get("cells", F.lit(0)))


def timed_rows(sheet_rows: DataFrame, parse=cell.parse_reading_time, with_cells: bool = True) -> DataFrame:
    """Data rows whose first cell is a time."""
    return (
        sheet_rows.filter(F.col("row_idx") >= FIRST_DATA_ROW)
        .withColumn("recorded_at", parse(_time_cell(sheet_rows)))
        .filter(F.col("recorded_at").isNotNull())
        .select("source_file", "row_idx", "recorded_at", *(["cells"] if with_cells else []))
    )


def drop_repeated_times(
    sheet_rows: DataFrame, parse=cell.parse_reading_time, policy: SlicePolicy = DEFAULT_POLICY,
    with_cells: bool = True,
) -> SlicedRows:
    """Timed rows without those that repeat the time of the row before them in the file.

    Without cells only row numbers and times are shuffled.
    """
    lagged = lag_in_slices(
        timed_rows(sheet_rows, parse, with_cells),
        ["source_file"],
        "row_idx",
        {"prev_time": "recorded_at"},
        policy,
        measured=sheet_rows,
    )
    repeated = F.coalesce(F.col("recorded_at") == F.col("prev_time"), F.lit(False))
    return SlicedRows(lagged.rows.filter(~repeated).drop("prev_time"), lagged.keys, lagged.hot)


class Sheets:
    """Parsed sheets: kept rows with their columns, file verdicts and long records."""

    def __init__(self, sheet_rows: DataFrame, policy: SlicePolicy = DEFAULT_POLICY):
        self.sheet_rows = sheet_rows
        self.policy = policy

    @cached_property
    def kept(self) -> SlicedRows:
        return drop_repeated_times(self.sheet_rows, policy=self.policy)

    @cached_property
    def columns(self) -> DataFrame:
        return sheet_columns(self.sheet_rows)

    def cells(self) -> DataFrame:
        """Long cells of all files with usable names, still as text; stored, they serve all that follows."""
        return self.kept.join(self.columns).select(
            "utility_type", "tower_name", "recorded_at", "source_file", "row_idx", F.inline(flat_cells(cell="cells"))
        )

    def contents(self) -> DataFrame:
        """Per file with usable name: number of records and whether a cell is no number."""
        bad = F.exists(
            "flats", lambda flat: cell.is_bad_number(cell.present(F.get("cells", flat["col_idx"])))
        )
        return (
            self.kept.join(self.columns)
            .groupBy("source_file")
            .agg(
                F.sum(F.size("flats").cast("bigint")).alias("records"),
                F.max(bad).alias("has_bad_cell"),
            )
        )

    def dropped_rows(self) -> DataFrame:
        """Per file: data rows whose first cell is no time, and rows that repeat a time."""
        first = _time_cell(self.sheet_rows)
        data = self.sheet_rows.filter((F.col("row_idx") >= FIRST_DATA_ROW) & first.isNotNull())
        timed = F.count(cell.parse_reading_time(first))
        narrow = drop_repeated_times(self.sheet_rows, policy=self.policy, with_cells=False)
        kept = narrow.rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("kept"))
        return (
            data.groupBy("source_file")
            .agg((F.count(F.lit(1)) - timed).alias("untimed_rows"), timed.alias("timed"))
            .join(kept, "source_file", "left")
            .select(
                "source_file", "untimed_rows",
                (F.col("timed") - F.coalesce("kept", F.lit(0))).alias("repeated_rows"),
            )
        )

    def records(self, files: DataFrame | None = None) -> DataFrame:
        """Long readings with their sheet position, of the given files (source_file) or all."""
        cells = self.cells()
        if files is not None:
            cells = cells.join(files.select("source_file"), "source_file", "left_semi")
        return records_of(cells)


def contents_of(cells: DataFrame) -> DataFrame:
    """Per file: number of records and whether a cell is no number."""
    bad = cell.is_bad_number(cell.present(F.col("cell")))
    return cells.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"), F.max(bad).alias("has_bad_cell"))


def records_of(cells: DataFrame) -> DataFrame:
    """Long cells as readings with their sheet position."""
    value = cell.reading_value(cell.present(F.col("cell")))
    return cells.withColumn("reading_value", value).select(*READING_COLUMNS, "row_idx", "col_idx")


def flat_cells(**rows: str) -> Column:
    """The flats of a file with their cells of the given rows, ready to be exploded.

    Cells are picked before the explosion: a row per flat then carries its own cells only
    and not the whole grid row.
    """
    return F.transform(
        "flats",
        lambda flat: F.struct(
            flat["col_idx"].alias("col_idx"),
            flat["flat_id"].alias("flat_id"),
            flat["given_flat_id"].alias("given_flat_id"),
            *[F.get(cells, flat["col_idx"]).alias(name) for name, cells in rows.items()],
        ),
    )
