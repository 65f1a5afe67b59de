"""Ranked search of every item in all documents, by norm buckets of impact vectors.

A document's impact on a term is the term's weight times a saturated frequency, a whole number; its
score for an item is the sum over the item's terms. Items are taken in blocks of bounded size. For
a block, one pass over the texts keeps, per document, its length and the frequencies of the block's
terms, as Parquet in the shared folder; document counts follow from that. Then every task

* orders its impact vectors by length (Euclidean norm) and cuts them into buckets,
* skips a bucket, and with it all later ones, for an item whose norm times the bucket's largest
  norm stays below the item's threshold (Cauchy-Schwarz),
* bounds each vector of a remaining bucket by its own product on the item's heaviest coordinates
  plus the product of the norms on all others, and drops those below the threshold,
* scores the survivors exactly, in 64-bit integers, and keeps the best.

The threshold is the score of the last kept place: at first among some thousands of documents drawn
by hash, scored in the same way, then among the task's own. It only saves work; no document that
could be among the best is left out, ties included. Tasks hand on their best, which are put together
in two steps, so that no item is gathered into one task. The driver holds one block of items.

Cases: null texts and texts without terms have none and do not count as documents; an item without
terms, or an empty table, gives no rows; very long texts are read whole; repeated documents and
items are ranked as often as they occur; equal scores go by ascending doc_id, a null one last;
further columns are ignored, whatever their names. Terms are told apart by 128-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.words import Texts, Words, map_slices, table
from gaugeflow.sources.workspace import new_folder

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IN_TERM = table(outside=bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BEST = 50
BLOCK_TERMS = 1 << 17  # terms of all items of a block
SET_NUMBERS = 1 << 20  # coordinates of the vectors that a task orders at a time
BUCKET = 512
FOCUS = 6  # coordinates whose product is formed for the bound
SEEDS = 8192  # documents that give the first thresholds
MERGE_PARTS = 64
ROUNDING = 1e-12  # share of a squared norm that sums of squares in doubles may lack
UNSCALED = 1_000_000_000


# -- items -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """Some term lists: their numbers, and their terms as places in the sorted vocabulary."""

    queries: list[int]
    terms: list[np.ndarray]
    vocabulary: list[str]

    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted first hashes of the vocabulary, the second ones and the terms they belong to."""
        words = Words(Texts(pa.array(self.vocabulary, pa.string())), IN_TERM)
        first = words.hashes(0)
        order = np.argsort(first)
        return first[order], words.hashes(1)[order], order


def _term_lists(items: DataFrame, item_id: str, text: str) -> DataFrame:
    lower = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), CAPITALS, SMALL)
    terms = F.array_sort(F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), 0)))
    return items.select(F.col(item_id).alias("item_id"), terms.alias("terms")).filter(F.size("terms") > 0)


def _blocks(lists: DataFrame, most_terms: int) -> Iterator[Block]:
    """The distinct term lists in blocks; a list beyond the bound is a block of its own."""
    held: list[tuple[int, list[str]]] = []
    size = 0
    for row in lists.toLocalIterator():
        if held and size + len(row.terms) > most_terms:
            yield _block(held)
            held, size = [], 0
        held.append((row.query, row.terms))
        size += len(row.terms)
    if held:
        yield _block(held)


def _block(held: list[tuple[int, list[str]]]) -> Block:
    vocabulary = sorted({term for _, terms in held for term in terms})
    place = {term: i for i, term in enumerate(vocabulary)}
    return Block([q for q, _ in held], [np.array(sorted(place[t] for t in terms)) for _, terms in held], vocabulary)


# -- documents -------------------------------------------------------------------------


def _frequencies(documents: DataFrame, block: Block, doc_id: str, text: str) -> DataFrame:
    """Per document with a term: its number of terms, and the block's terms it holds with their counts."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(block.hashes())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        first, second, term = shared.value
        words = Words(Texts(batch.column(1)), IN_TERM, lower=True)
        some = np.flatnonzero(words.counts)
        if not len(some):
            return None
        h = words.hashes(0)
        at = np.minimum(np.searchsorted(first, h), len(first) - 1)
        same = (first[at] == h) & (second[at] == words.hashes(1))
        key = words.text_of_words()[same] * len(first) + term[at[same]]
        key, count = np.unique(key, return_counts=True)
        ends = np.searchsorted(key // len(first), some, "right")
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(some)), pa.array(words.counts[some]),
             pa.ListArray.from_arrays(offsets, pa.array((key % len(first)).astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int64)))],
            ["doc_id", "length", "terms", "counts"])

    id_type = dict(rows.dtypes)["doc_id"]
    return map_slices(rows, "text", work, f"doc_id {id_type}, length long, terms array<int>, counts array<long>")


@dataclass(frozen=True)
class Collection:
    """What the scores need to know of all documents: their number, terms and term weights."""

    documents: int
    terms: int
    weights: np.ndarray


def _collection(vectors: DataFrame, block: Block) -> Collection:
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("terms")).first()
    holders = np.zeros(len(block.vocabulary), np.int64)
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    for row in held.collect():  # one row per term of the block
        holders[row.term] = row["count"]
    n = total.n
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in holders.tolist()]
    return Collection(n, total.terms or 0, np.array(weights, np.int64))


# -- search ----------------------------------------------------------------------------


class ImpactSet:
    """Impact vectors of some documents, by falling norm."""

    def __init__(self, batch: pa.RecordBatch, collection: Collection):
        lengths = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.diff(offsets)
        m = 100 - 50 + (50 * lengths * collection.documents) // collection.terms
        impacts = collection.weights[terms] * ((UNSCALED * counts) // (1000 * counts + 20 * np.repeat(m, sizes)))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        norms = np.sqrt(np.bincount(owner, impacts.astype(float) ** 2, len(sizes)))
        self.order = np.argsort(-norms, kind="stable")
        self.norms = norms[self.order]
        place = np.empty(len(sizes), np.int64)
        place[self.order] = np.arange(len(sizes))
        by_place = np.argsort(place[owner], kind="stable")
        self.terms, self.impacts = terms[by_place], impacts[by_place]
        self.offsets = np.concatenate([[0], np.cumsum(sizes[self.order])])

    def __len__(self) -> int:
        return len(self.norms)

    def bucket(self, start: int) -> Bucket:
        return Bucket(self, start, min(start + BUCKET, len(self)))


class Bucket:
    """Vectors of similar norm, with the coordinates of each term in a row."""

    def __init__(self, whole: ImpactSet, start: int, stop: int):
        self.start, self.norms = start, whole.norms[start:stop]
        first, last = whole.offsets[start], whole.offsets[stop]
        self.offsets = whole.offsets[start : stop + 1] - first
        self.terms, self.impacts = whole.terms[first:last], whole.impacts[first:last]
        owner = np.repeat(np.arange(stop - start), np.diff(self.offsets))
        by_term = np.argsort(self.terms, kind="stable")
        self.sorted_terms = self.terms[by_term]
        self.owners, self.values = owner[by_term], self.impacts[by_term].astype(float)

    def possible(self, focus: np.ndarray, others: int, threshold: float) -> np.ndarray:
        """Vectors whose bound reaches the threshold: exact on the focus, norms on the other coordinates."""
        first, last = np.searchsorted(self.sorted_terms, focus), np.searchsorted(self.sorted_terms, focus, "right")
        product, squares = np.zeros(len(self.norms)), np.zeros(len(self.norms))
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            if a < b:  # a vector has a coordinate once
                product[self.owners[a:b]] += self.values[a:b]
                squares[self.owners[a:b]] += self.values[a:b] ** 2
        rest = np.maximum(self.norms**2 - squares, 0) + self.norms**2 * ROUNDING
        return np.flatnonzero(product + np.sqrt(others * rest) >= threshold)

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of some vectors; wanted: 1 for the item's terms, else 0, over the vocabulary."""
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        ends = np.cumsum(sizes)
        at = np.repeat(self.offsets[rows] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        gained = np.concatenate([[0], np.cumsum(wanted[self.terms[at]] * self.impacts[at])])
        return gained[ends] - gained[ends - sizes]


FOUND = ["query", "score", "doc_id"]
RANKING = [("query", "ascending"), ("score", "descending"), ("doc_id", "ascending")]


def _kept(found: pa.Table, best: int) -> pa.Table:
    """The best rows of each query, ranked."""
    found = found.take(pc.sort_indices(found, RANKING, null_placement="at_end"))
    query = found.column("query").to_numpy()
    first = np.searchsorted(query, query)
    return found.filter(pa.array(np.arange(len(query)) - first < best))


class Search:
    """The best documents so far of every query of a block, within a task."""

    def __init__(self, block: Block, collection: Collection, thresholds: np.ndarray, best: int, id_type: pa.DataType):
        self.block, self.collection, self.best = block, collection, best
        self.thresholds = thresholds.astype(float)
        self.sizes = [math.sqrt(len(terms)) for terms in block.terms]
        self.focus = []
        for terms in block.terms:
            heavy = np.argsort(-collection.weights[terms], kind="stable")[:FOCUS]
            self.focus.append(terms[heavy])
        self.wanted = np.zeros(len(block.vocabulary), np.int64)
        schema = pa.schema([("query", pa.int64()), ("score", pa.int64()), ("doc_id", id_type)])
        self.found, self.waiting, self.n_waiting = schema.empty_table(), [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        vectors = ImpactSet(batch, self.collection)
        active = range(len(self.block.queries))
        for start in range(0, len(vectors), BUCKET):
            largest = vectors.norms[start] * (1 + 1e-9)
            active = [q for q in active
                      if largest > 0 and self.sizes[q] * largest >= self.thresholds[q]]
            if not active:
                return
            bucket = vectors.bucket(start)
            for q in active:
                self._compare(q, bucket, vectors, batch.column(0))
            if self.n_waiting > SET_NUMBERS // 4:
                self.settle()

    def _compare(self, q: int, bucket: Bucket, vectors: ImpactSet, ids: pa.Array) -> None:
        terms = self.block.terms[q]
        rows = bucket.possible(self.focus[q], len(terms) - len(self.focus[q]), self.thresholds[q])
        if not len(rows):
            return
        self.wanted[terms] = 1
        scores = bucket.scores(rows, self.wanted)
        self.wanted[terms] = 0
        good = np.flatnonzero((scores > 0) & (scores >= self.thresholds[q]))
        if len(good):
            number = np.full(len(good), self.block.queries[q], np.int64)
            doc_ids = ids.take(pa.array(vectors.order[bucket.start + rows[good]]))
            self.waiting.append(pa.Table.from_arrays([pa.array(number), pa.array(scores[good]), doc_ids], FOUND))
            self.n_waiting += len(good)

    def settle(self) -> pa.Table:
        """Keep the best of what was found and raise the thresholds."""
        self.found = _kept(pa.concat_tables([self.found, *self.waiting]).combine_chunks(), self.best)
        self.waiting, self.n_waiting = [], 0
        query, score = (self.found.column(c).to_numpy() for c in ("query", "score"))
        numbers = np.array(self.block.queries, np.int64)
        last = np.searchsorted(query, numbers) + self.best - 1
        full = np.flatnonzero(last < np.searchsorted(query, numbers, "right"))
        self.thresholds[full] = np.maximum(self.thresholds[full], score[last[full]])
        return self.found


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to a bounded number of coordinates; a row is never cut."""
    for batch in batches:
        ends = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False) + 1)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + SET_NUMBERS, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _best(
    vectors: DataFrame, block: Block, collection: Collection, thresholds: np.ndarray, best: int
) -> DataFrame:
    """query, score, doc_id, rank of the best documents of every query of the block."""
    id_type = vectors.schema["doc_id"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast((block, collection, thresholds))

    def run(batches):
        search = None
        for part in _sets(batches):
            if search is None:
                search = Search(*shared.value, best, part.column(0).type)
            search.add(part)
        if search is not None:
            yield from search.settle().to_batches()

    found = vectors.mapInArrow(run, f"query long, score long, doc_id {id_type}")
    return _ranked(_ranked(found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))), best, "part"), best)


def _ranked(found: DataFrame, best: int, *part: str) -> DataFrame:
    place = Window.partitionBy("query", *part).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= best).select(*FOUND, "rank")


def _thresholds(vectors: DataFrame, block: Block, collection: Collection, best: int) -> np.ndarray:
    """Scores that the best documents reach at least, from some documents drawn by hash."""
    share = max(1, collection.documents // SEEDS)
    drawn = vectors.filter(F.pmod(F.xxhash64("doc_id", "length", F.hash("counts")), F.lit(share)) == 0)
    start = np.zeros(len(block.queries), np.int64)
    place = {query: i for i, query in enumerate(block.queries)}
    for row in _best(drawn, block, collection, start, best).filter(F.col("rank") == best).collect():
        start[place[row.query]] = row.score
    return start


def search(
    documents: DataFrame, items: DataFrame, best: int = BEST, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of every item."""
    spark = documents.sparkSession
    wanted = _stored(spark, _term_lists(items, item_id, item_text), "items")
    lists = _stored(
        spark, wanted.select("terms").distinct().withColumn("query", F.monotonically_increasing_id()), "term-lists")
    found = []
    for block in _blocks(lists, block_terms):
        vectors = _stored(spark, _frequencies(documents, block, doc_id, text), "impacts")
        collection = _collection(vectors, block)
        if collection.documents:
            thresholds = _thresholds(vectors, block, collection, best)
            found.append(_stored(spark, _best(vectors, block, collection, thresholds, best), "ranked"))
    id_types = {name: dict(rows.dtypes)[column] for name, rows, column in (
        ("item_id", items, item_id), ("doc_id", documents, doc_id))}
    if not found:
        return spark.createDataFrame(
            [], f"item_id {id_types['item_id']}, rank int, doc_id {id_types['doc_id']}, score long")
    ranked = reduce(DataFrame.unionByName, found)
    return wanted.join(lists, "terms").join(ranked, "query").select("item_id", _int("rank"), "doc_id", "score")


def _int(name: str) -> Column:
    return F.col(name).cast("int").alias(name)


def _stored(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written to the shared folder and read back."""
    folder = new_folder(spark, purpose)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
