"""Table schemas and the two fixed dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tower letters (I and O are not used) and utility keywords.
TOWERS = {
    "A": "Platinum",
    "B": "Titanium",
    "C": "Aurum",
    "D": "Argentum",
    "E": "Pearl",
    "F": "Crystal",
    "G": "Jade",
    "H": "Turquoise",
    "J": "Amethyst",
    "K": "Aquamarine",
    "L": "Opal",
    "M": "Sapphire",
    "N": "Ruby",
    "P": "Lakeside",
}
UTILITIES = {"Eb": "Electricity", "Dg": "Diesel", "Water": "Water", "Gas": "Gas"}

READINGS_DDL = (
    "utility_type STRING NOT NULL, tower_name STRING NOT NULL, flat_id STRING NOT NULL, "
    "given_flat_id STRING NOT NULL, recorded_at TIMESTAMP_NTZ NOT NULL, reading_value DOUBLE, "
    "source_file STRING NOT NULL"
)
MONTHLY_SUMMARY_DDL = (
    "utility_type STRING NOT NULL, given_flat_id STRING NOT NULL, "
    "opening_reading DOUBLE, closing_reading DOUBLE, monthly_reading DOUBLE, "
    "opening_timestamp TIMESTAMP_NTZ, closing_timestamp TIMESTAMP_NTZ, computed_at TIMESTAMP_NTZ"
)
MONTHLY_DISCREPANCY_DDL = (
    "utility_type STRING NOT NULL, given_flat_id STRING NOT NULL, check_name STRING NOT NULL, "
    "severity STRING NOT NULL, remark STRING, detail_json STRING, detected_at TIMESTAMP_NTZ"
)
INGESTION_LOG_DDL = (
    "source_file STRING NOT NULL, file_hash STRING NOT NULL, "
    "ingested_at TIMESTAMP_NTZ, record_count INT"
)

READING_COLUMNS = [
    "utility_type", "tower_name", "flat_id", "given_flat_id",
    "recorded_at", "reading_value", "source_file",
]
METER = ["utility_type", "given_flat_id"]
# Key order of windows: a sort compares the first bytes of its first column cheaply, and flat
# ids differ there far more often than the few utilities do.
METER_WINDOW = ["given_flat_id", "utility_type"]
READING_KEY = [*METER, "recorded_at"]
SUMMARY_KEY = [*METER, "year_month"]
FINDING_KEY = [*SUMMARY_KEY, "check_name"]


def lookup(entries: dict[str, str], key: Column) -> Column:
    """Dimension lookup as a literal map: no join, NULL for an unknown key."""
    pairs = [F.lit(part) for entry in entries.items() for part in entry]
    return F.try_element_at(F.create_map(*pairs), key)
