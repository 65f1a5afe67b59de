"""From raw documents to packed sequences, stage by stage.

Each stage takes the documents that its predecessor kept, as reread from Parquet. All but the
last keep the columns of documents; clean documents pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import decontamination, language_id, packing, simhash, substrings
from gaugeflow.llm.queries import BENCHMARK_WINDOW, WINDOW, table, tokenizer_path
from gaugeflow.llm.words import text_key
from gaugeflow.sources.workspace import new_folder

LEAST_LANGUAGE_SCORE = 0.5
CONTAMINATED_SHARE = 20  # one hit word in so many


KEY = "gaugeflow_key"


def _keyed(documents: DataFrame) -> DataFrame:
    """With a column that names a row by its doc_id and text; ids may be null or repeated. A null id
    is the largest."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *text_key(F.col("text").cast("string")))
    return documents.withColumn(KEY, key)


def keep_identified(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and a clear language.

    Null and empty texts and those without letters go. If no document is labelled, no language can
    be told and all documents with a letter stay. Repeated rows are judged alike; ties between two
    languages score a half and stay.
    """
    return language_id.keep_identified(documents, language_id.train(documents), LEAST_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of linked fingerprints.

    Copies under one id are one document, of which one row stays; different texts under one id, or
    under none, are documents of their own. Null ids are the largest. Texts without words have one
    fingerprint in common and are one group.
    """
    keyed = _keyed(documents)
    folder = new_folder(spark, "kept")
    simhash.near_duplicates(keyed, doc_id=KEY).filter("doc_id = component_id").select(
        F.col("doc_id").alias("gaugeflow_kept")).write.parquet(folder)
    kept = spark.read.parquet(folder).groupBy("gaugeflow_kept").count()
    found = keyed.join(kept, F.col(KEY) == F.col("gaugeflow_kept"), "left_semi")
    repeated = kept.filter("count > 1")
    if repeated.isEmpty():
        return found.drop(KEY)
    same = F.col(KEY) == F.col("gaugeflow_kept")
    return found.join(repeated, same, "left_anti").unionByName(
        found.join(repeated, same, "left_semi").dropDuplicates([KEY])).drop(KEY)


def cut_repeats(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; one that has no word left goes.

    Null and empty texts have no words: they hold nothing that repeats, and stay. Passages are
    judged on the stage's input, and all of their occurrences go, also within one document.
    """
    keyed = _keyed(documents)
    found = substrings.remove_repeats(keyed, WINDOW, doc_id=KEY).filter("n_removed > 0").select(
        F.col("doc_id").alias("gaugeflow_cut"), F.col("kept").alias("gaugeflow_kept")).dropDuplicates(["gaugeflow_cut"])
    joined = keyed.join(found, F.col(KEY) == F.col("gaugeflow_cut"), "left")
    text = F.coalesce("gaugeflow_kept", "text")
    changed = {"text": text} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in documents.columns else {})
    return joined.withColumns(changed).filter("gaugeflow_kept is null or gaugeflow_kept != ''").select(*documents.columns)


def drop_contaminated(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than a twentieth of benchmark words.

    Null texts and those without words have none and stay; an empty benchmark leaves all.
    """
    keyed = _keyed(documents)
    overlaps = decontamination.find_overlaps(
        keyed, table(spark, sf_dir, "benchmark"), BENCHMARK_WINDOW, doc_id=KEY)
    folder = new_folder(spark, "contaminated")
    overlaps.filter((F.col("n_hit") > 0) & (CONTAMINATED_SHARE * F.col("n_hit") >= F.col("n_words"))).select(
        F.col("doc_id").alias("gaugeflow_bad")).write.parquet(folder)
    bad = spark.read.parquet(folder)
    return keyed.join(bad, F.col(KEY) == F.col("gaugeflow_bad"), "left_anti").drop(KEY)


def pack(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. A null or empty text is its end token alone; every row is packed."""
    return packing.pack(documents, tokenizer_path(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_identified),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Tokens are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, rows, sf_dir).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
    return rows
