"""Small hand-made inputs."""

from __future__ import annotations

from datetime import datetime

READINGS = (
    "utility_type string, tower_name string, flat_id string, given_flat_id string, "
    "recorded_at timestamp_ntz, reading_value double, source_file string"
)
SUMMARY = (
    "utility_type string, given_flat_id string, year_month string, opening_reading double, "
    "closing_reading double, monthly_reading double, opening_timestamp timestamp_ntz, "
    "closing_timestamp timestamp_ntz"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def readings(spark, rows, flat="G001", utility="Gas", source="T C Gas readings.xls"):
    """rows: (time text, value) of one meter, or (flat, time text, value)."""
    full = []
    for row in rows:
        name, time, value = row if len(row) == 3 else (flat, *row)
        full.append((utility, "Aurum", name, f"Aurum{name}", at(time), value, source))
    return spark.createDataFrame(full, READINGS)


def summary(spark, rows):
    """rows: (utility, flat, month, opening, closing)."""
    return spark.createDataFrame(
        [
            (u, f, m, float(o), float(c), float(c) - float(o), at(f"{m}-01"), at(f"{m}-28"))
            for u, f, m, o, c in rows
        ],
        SUMMARY,
    )


def sheet(spark, files: dict[str, list[list]]):
    """Files as lists of grid rows."""
    rows = [
        (name, index, [None if c is None else str(c) for c in cells])
        for name, grid in files.items()
        for index, cells in enumerate(grid)
    ]
    return spark.createDataFrame(rows, "source_file string, row_idx int, cells array<string>")


def grid(flats: list, rows: list[list]) -> list[list]:
    """Title, header, empty row and data rows."""
    return [["Meter data"], ["Recorded Date/Time", *flats], [], *rows]


def values(df, *columns):
    """Rows as sorted tuples of the named columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
