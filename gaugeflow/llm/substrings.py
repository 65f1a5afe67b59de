"""Removal of long repeated passages with prefix-partitioned suffix trees.

The tree of all suffixes, cut off at the window length, is grown in two levels. A suffix's
window is filed under a prefix of eight words, the one with the least hash among those that
begin in it; equal windows have equal prefixes at the same place, and neighbouring windows
share one, so few prefixes stand for all suffixes. Prefixes that occur once are leaves and are
dropped. Only the others are grown to full depth: their windows, named by 96-bit hashes, are
the deep nodes, and a node with two or more leaves is a repeat. Node counts are keyed
aggregations combined before the shuffle, so a hot subtree is never gathered in one task. Of
texts that are equal as a whole, one is grown.

The prefixes that go on, the repeated windows, the texts with copies and those with removals
reach the tasks as filters of fixed size (`filter_bits`). A filter only saves work; results come from the exact keys.

Cases: null texts have no words and keep the empty text; texts shorter than the window lose
nothing; repeated rows and copies lose every word that a repeated window covers, which is all
of them in a text of at least one window; an empty table gives an empty one; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.words import WINDOW_BASES, Texts, Words, map_slices, text_key, windows
from gaugeflow.sources.workspace import new_folder

PREFIX = 8
PREFIX_BASE = np.uint64(0x8CB92BA72F3D8DD7)


class Suffixes:
    """Windows of the words of a slice of texts and the prefix each is filed under."""

    def __init__(self, column: pa.Array, size: int):
        self.words = Words(Texts(column))
        self.h = self.words.hashes()
        width = min(PREFIX, size)
        prefix = windows(self.h, width, PREFIX_BASE)
        n = len(self.h) - size + 1
        text = self.words.text_of_words()
        if n <= 0:
            self.at = np.zeros(0, np.int64)
            self.value = np.zeros(0, np.uint64)
            self.text = self.place = self.at
            return
        reach = size - width + 1
        value, place, span = prefix, np.arange(len(prefix)), 1
        while span * 2 <= reach:
            value, place = self._least(value, place, span)
            span *= 2
        if span < reach:
            value, place = self._least(value, place, reach - span)
        inside = text[:n] == text[size - 1 :]
        self.at = np.flatnonzero(inside)
        self.value, self.place, self.text = value[inside], place[inside], text[:n][inside]

    @staticmethod
    def _least(value: np.ndarray, place: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        later = value[step:] < value[:-step]
        return np.where(later, value[step:], value[:-step]), np.where(later, place[step:], place[:-step])


class BitFilter:
    """A set of 64-bit values that may also hold others; 2**bits bits at any number of values."""

    def __init__(self, rows: DataFrame, value: str, bits: int):
        index = F.shiftrightunsigned(F.col(value), 64 - bits)
        cells = (
            rows.select(F.shiftright(index, 6).alias("cell"), (index.bitwiseAND(F.lit(63))).cast("int").alias("bit"))
            .groupBy("cell").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("flags")).toArrow()
        )
        self.bits = np.uint64(64 - bits)
        self.cells = np.zeros(1 << (bits - 6), np.uint64)
        self.cells[cells.column("cell").to_numpy()] = cells.column("flags").to_numpy().view(np.uint64)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        index = values >> self.bits
        return (self.cells[(index >> np.uint64(6)).astype(np.int64)] >> (index & np.uint64(63))) & np.uint64(1) == 1


def _lone(batch: pa.RecordBatch, copied: BitFilter) -> pa.RecordBatch:
    """The rows whose texts surely have no copy."""
    return batch.filter(pa.array(~copied.may_hold(batch.column("k1").to_numpy().view(np.uint64))))


class DistinctTexts:
    """Every text once: those without a copy as they are scanned, one of each of the others."""

    def __init__(self, rows: DataFrame, filter_bits: int):
        spark = rows.sparkSession
        self.rows = rows.select("k1", "k2", "text")
        self.copies = rows.groupBy("k1", "k2").count().filter("count > 1").select("k1", "k2").checkpoint()
        self.copied = spark.sparkContext.broadcast(BitFilter(self.copies, "k1", min(filter_bits, 24)))
        copied, folder = self.copied, new_folder(spark, "copied")

        def held(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array(copied.value.may_hold(batch.column("k1").to_numpy().view(np.uint64))))

        map_slices(self.rows, "text", held, "k1 long, k2 long, text string").dropDuplicates(
            ["k1", "k2"]).write.parquet(folder)
        self.others = spark.read.parquet(folder)

    def map(self, work, schema: str) -> DataFrame:
        copied = self.copied
        return map_slices(self.rows, "text", lambda batch: work(_lone(batch, copied.value)), schema).unionByName(
            map_slices(self.others, "text", work, schema))


def _prefixes(texts: DistinctTexts, size: int) -> DataFrame:
    """value, places: the prefixes of each text and at how many places it has each."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        s = Suffixes(batch.column("text"), size)
        if not len(s.at):
            return None
        fresh = np.ones(len(s.at), bool)
        fresh[1:] = s.place[1:] != s.place[:-1]
        value, places = np.unique(s.value[fresh], return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(value.view(np.int64)), pa.array(places.astype(np.int32))], ["value", "places"])

    return texts.map(work, "value long, places int")


def _windows(texts: DistinctTexts, size: int, grown, nodes=None) -> DataFrame:
    """w1, w2 of the windows under prefixes that go on; with a filter of repeated windows only
    those that it may hold, and with k1, k2, start."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        s = Suffixes(batch.column("text"), size)
        on = grown.value.may_hold(s.value)
        if not on.any():
            return None
        at, text = s.at[on], s.text[on]
        first, last = int(at[0]), int(at[-1]) + size
        h = s.h[first:last]
        one = windows(h, size, WINDOW_BASES[0])[at - first]
        two = (windows(h, size, WINDOW_BASES[1])[at - first] >> np.uint64(33)).astype(np.int32)
        if nodes is None:
            return pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two)], ["w1", "w2"])
        again = nodes.value.may_hold(one)
        at, text, one, two = at[again], text[again], one[again], two[again]
        owner = pa.array(text)
        return pa.RecordBatch.from_arrays(
            [pa.array(one.view(np.int64)), pa.array(two), batch.column("k1").take(owner),
             batch.column("k2").take(owner), pa.array((at - s.words.offsets[text]).astype(np.int32))],
            ["w1", "w2", "k1", "k2", "start"])

    return texts.map(work, "w1 long, w2 int" + (", k1 long, k2 long, start int" if nodes is not None else ""))


def repeated_windows(documents: DataFrame, size: int = 35, text: str = "text", filter_bits: int = 27) -> DataFrame:
    """k1, k2 (text key), whole, starts: of each text with a repeated window whether all its
    windows are repeated (it has a copy) and else the first words of those that are."""
    context = documents.sparkSession.sparkContext
    rows = documents.select(*text_key(F.col(text)), F.col(text).cast("string").alias("text"))
    texts = DistinctTexts(rows, filter_bits)
    growing = _prefixes(texts, size).groupBy("value").agg(F.sum("places").alias("n")).filter("n > 1")
    grown = context.broadcast(BitFilter(growing, "value", filter_bits))
    counted = _windows(texts, size, grown).groupBy("w1", "w2").count().filter("count > 1").select("w1", "w2").checkpoint()
    nodes = context.broadcast(BitFilter(counted, "w1", filter_bits))
    starts = (
        _windows(texts, size, grown, nodes).join(counted, ["w1", "w2"], "left_semi")
        .groupBy("k1", "k2").agg(F.collect_set("start").alias("starts"))
    )
    return texts.copies.withColumn("whole", F.lit(True)).join(starts, ["k1", "k2"], "full")


def remove_repeats(
    documents: DataFrame, size: int = 35, doc_id: str = "doc_id", text: str = "text", filter_bits: int = 27,
    with_text: bool = True,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words (one blank between) of every
    document; kept is null if the text lost nothing or `with_text` is off."""
    spark = documents.sparkSession
    marks = repeated_windows(documents, size, text, filter_bits).checkpoint()
    marked = spark.sparkContext.broadcast(BitFilter(marks.select("k1"), "k1", min(filter_bits, 24)))
    rows = documents.select(F.col(doc_id).alias("doc_id"), *text_key(F.col(text)), F.col(text).cast("string").alias("text"))
    id_type = dict(rows.dtypes)["doc_id"]

    def unmarked(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Results of texts that are surely unmarked; the others are handed on."""
        texts = Texts(batch.column("text"))
        later = marked.value.may_hold(batch.column("k1").to_numpy().view(np.uint64))
        split = [texts.raw(i).split() for i in range(batch.num_rows)]
        digest = [None if l else hashlib.sha256(b" ".join(w)).hexdigest() for w, l in zip(split, later, strict=True)]
        body = [texts.raw(i).decode() if l else None for i, l in enumerate(later)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(body, pa.string()),
             pa.array([len(w) for w in split], pa.int64()), pa.array(digest, pa.string())],
            ["doc_id", "k1", "k2", "text", "n_words", "kept_sha256"])

    first = map_slices(rows, "text", unmarked,
                       f"doc_id {id_type}, k1 long, k2 long, text string, n_words long, kept_sha256 string")
    joined = first.join(marks, ["k1", "k2"], "left")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(batch.column("text"))
        removed = np.zeros(batch.num_rows, np.int64)
        digests, kept = batch.column("kept_sha256").to_pylist(), [None] * batch.num_rows
        whole, starts = batch.column("whole").to_pylist(), batch.column("starts").to_pylist()
        for i, done in enumerate(digests):
            if done is not None:
                continue
            words = texts.raw(i).split()
            keep = np.ones(len(words), bool)
            if whole[i] and len(words) >= size:
                keep[:] = False
            elif starts[i]:
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.array(starts[i])
                edge[at] += 1
                edge[at + size] -= 1
                keep = np.cumsum(edge[:-1]) == 0
            removed[i] = len(words) - int(keep.sum())
            left = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
            digests[i] = hashlib.sha256(left).hexdigest()
            if with_text and removed[i]:
                kept[i] = left.decode()
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(removed), pa.array(digests, pa.string()),
             pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return map_slices(joined, "text", cut,
                      f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, kept string")
