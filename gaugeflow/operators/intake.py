"""Which files of a run are ingested, and why the others are not (A1, A3, A8, A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.cells import SHEET_NAME
from gaugeflow.operators.sheets import parse_filenames

INGESTED, SEEN, EMPTY = "ingested", "content already ingested", "no records"
LOG_CONFLICT = "ingested, but the log already has this name"
BAD_CELL = "cell is not a number"


def discover_files(paths: DataFrame) -> DataFrame:
    """Distinct paths whose base name is a reading sheet."""
    name = F.substring_index("path", "/", -1)
    return (
        paths.select("path", name.alias("source_file"))
        .filter(F.col("source_file").rlike(SHEET_NAME))
        .distinct()
    )


def file_outcomes(files: DataFrame, contents: DataFrame, log: DataFrame) -> DataFrame:
    """Outcome of every file of a run, as if the files were taken one by one in name order.

    files: (source_file, file_hash) and, where files were read as text, damage (NULL if none);
    contents: (source_file, records, has_bad_cell).
    A file is skipped when its content is in the log or when an earlier file of the run
    with the same content gets a log entry. Files that fail, hold no records or whose name
    is already in the log get none, so they do not stop a later copy.
    """
    known_hash = log.select("file_hash").distinct().withColumn("_seen", F.lit(True))
    known_name = log.select("source_file").distinct().withColumn("_logged", F.lit(True))
    checked = (
        parse_filenames(files)
        .join(contents, "source_file", "left")
        .join(known_hash, "file_hash", "left")
        .join(known_name, "source_file", "left")
        .withColumn("records", F.coalesce("records", F.lit(0).cast("bigint")))
    )
    damage = F.col("damage") if "damage" in files.columns else F.lit(None).cast("string")
    problem = (
        F.when(F.col("_seen"), SEEN)
        .when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(damage.isNotNull(), damage)
        .when(F.col("has_bad_cell"), BAD_CELL)
        .when(F.col("records") == 0, EMPTY)
    )
    judged = checked.withColumn("_problem", problem)
    gets_log_entry = F.col("_problem").isNull() & F.col("_logged").isNull()
    first_logged = judged.groupBy("file_hash").agg(
        F.min(F.when(gets_log_entry, F.col("source_file"))).alias("_first")
    )
    outcome = (
        F.when(F.col("_problem") == SEEN, SEEN)
        .when(F.col("source_file") > F.col("_first"), SEEN)
        .when(F.col("_problem").isNotNull(), F.col("_problem"))
        .when(F.col("_logged"), LOG_CONFLICT)
        .otherwise(INGESTED)
    )
    return judged.join(first_logged, "file_hash").select(
        "source_file", "file_hash", "records", outcome.alias("outcome")
    )


def ingested_files(outcomes: DataFrame) -> DataFrame:
    """Files whose rows are inserted (a log conflict is only noticed after the insert)."""
    return outcomes.filter(F.col("outcome").isin(INGESTED, LOG_CONFLICT))


def log_entries(outcomes: DataFrame, inserted: DataFrame) -> DataFrame:
    """Log rows for ingested files with the number of rows really inserted."""
    return (
        outcomes.filter(F.col("outcome") == INGESTED)
        .join(inserted, "source_file", "left")
        .select(
            "source_file", "file_hash",
            F.localtimestamp().alias("ingested_at"),
            F.coalesce("inserted", F.lit(0)).cast("int").alias("record_count"),
        )
    )
