"""Sheets on disk: listing, content hashes and delimited text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.cells import present
from gaugeflow.sources.records import DelimitedFiles

# '{,x}' also finds xlsx; sheets exported as delimited text keep their name under csv.
SHEET_GLOB = "T * * [rR]eadings.xls{,x}"
CSV_GLOB = "T * * [rR]eadings.csv"


def _decoded(name: Column) -> Column:
    """File names in the metadata column are URL-encoded, except for '+'."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, directory: str, name_glob: str = SHEET_GLOB) -> DataFrame:
    """Path and base name of the sheets in a directory; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(directory)
    return files.select("path", F.substring_index("path", "/", -1).alias("source_file"))


def _lines(spark: SparkSession, directory: str, name_glob: str) -> DataFrame:
    """Lines by line feed as bytes, with the split they stand in; a file of any size has many splits."""
    text = spark.read.option("pathGlobFilter", name_glob).option("lineSep", "\n").text(directory)
    return text.select(
        _decoded(F.col("_metadata.file_name")).alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("line"),
    )


def _scanned(
    spark: SparkSession, directory: str, name_glob: str, delimiter: str | None
) -> DelimitedFiles:
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(directory)
    listed = files.select(F.substring_index("path", "/", -1).alias("source_file"), F.col("length").alias("size"))
    return DelimitedFiles(_lines(spark, directory, name_glob), listed, delimiter)


def file_hashes(spark: SparkSession, directory: str, name_glob: str = SHEET_GLOB) -> DataFrame:
    """Content hash of every sheet file, whatever its format; files are read in splits."""
    return _scanned(spark, directory, name_glob, None).files.select("source_file", "file_hash")


def delimited_files(
    spark: SparkSession, directory: str, name_glob: str = CSV_GLOB, delimiter: str = ","
) -> DelimitedFiles:
    """Sheets exported as delimited text, read once for rows, hashes and verdicts."""
    return _scanned(spark, directory, name_glob, delimiter)


def delimited_sheet_rows(
    spark: SparkSession, directory: str, name_glob: str = CSV_GLOB, delimiter: str = ","
) -> DataFrame:
    """(source_file, row_idx, cells) of the sheets that can be read; cells that mean 'missing' are NULL."""
    return sheet_rows(delimited_files(spark, directory, name_glob, delimiter))


def sheet_rows(read: DelimitedFiles) -> DataFrame:
    return read.rows().withColumn("cells", F.transform("cells", present))
