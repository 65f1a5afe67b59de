"""Benchmark decontamination with one FM-index per shard of training text.

Only words of benchmark windows can be part of a match, so a shard keeps the runs of such words
that are long enough and drops the rest; this loses no match. Over the kept words the shard
builds a suffix array, its Burrows-Wheeler transform as a wavelet matrix and every eighth
suffix position. All windows are searched backwards at once, their occurrences located by
walking to the nearest sampled position, and the covered words merged into removal spans.

The benchmark is brought to the tasks in blocks of a bounded number of bytes; several blocks
are taken one after the other with the spans so far in a checkpoint.

Cases: null texts and texts without words have no hits and are not contaminated; null item_ids
hit but are not listed; repeated items count once, repeated rows each get their own result; an
empty benchmark or table gives no hits or no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.words import Texts, Words, slices, table
from gaugeflow.sources.workspace import checkpoint_dir

LETTERS = table(inside=bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
SAMPLE_RATE = 8
SHARD_WORDS = 150_000
SHARD_ROWS, SHARD_BYTES = 2000, 32 << 20  # a shard's documents wait for its index with their texts
BLOCK_BYTES = 4 << 20


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if n == 0 or new[order[-1]] == n - 1:
            return order
        rank, width = new, width * 2


class WaveletMatrix:
    """Rank of a symbol before a position and access to a symbol, in one pass over the bits."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = []
        symbols = symbols.astype(np.int64)
        for bit in reversed(range(max(1, int(size - 1).bit_length()))):
            ones = (symbols >> bit) & 1
            before = np.concatenate([[0], np.cumsum(ones)])
            zeros = len(symbols) - int(before[-1])
            self.levels.append((bit, before, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low, high = np.zeros_like(position), position
        for bit, before, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            low = np.where(one, zeros + before[low], low - before[low])
            high = np.where(one, zeros + before[high], high - before[high])
        return high - low

    def access(self, position: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(position)
        for _, before, zeros in self.levels:
            one = before[position + 1] - before[position]
            symbol = symbol * 2 + one
            position = np.where(one == 1, zeros + before[position], position - before[position])
        return symbol


class FmIndex:
    """Backward search over a sequence of symbols 0 .. size-1.

    Inside, symbols are one higher and a single 0 ends the sequence.
    """

    def __init__(self, symbols: np.ndarray, size: int, rate: int = SAMPLE_RATE):
        closed, size = np.append(symbols + 1, 0), size + 1
        order = suffix_array(closed)
        self.transform = WaveletMatrix(closed[order - 1], size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(closed, minlength=size))])
        self.n = len(closed)
        sampled = order % rate == 0
        self.sampled_before = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = order[sampled]

    def step(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.transform.rank(symbol, position)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of each pattern (rows of equal length)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        for column in reversed(range(patterns.shape[1])):
            symbol = patterns[:, column] + 1
            low, high = self.step(symbol, low), self.step(symbol, high)
            high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: steps to the next sampled suffix and its position."""
        found = np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        rows, steps = rows.copy(), 0
        while len(open_):
            hit = self.sampled_before[rows + 1] > self.sampled_before[rows]
            found[open_[hit]] = self.samples[self.sampled_before[rows[hit]]] + steps
            open_, rows = open_[~hit], rows[~hit]
            rows = self.step(self.transform.access(rows), rows)
            steps += 1
        return found % self.n


@dataclass(frozen=True)
class Windows:
    """The windows of a block of items, as rows of word numbers for each window length."""

    vocabulary: dict[bytes, int]
    hashes: np.ndarray  # sorted, of the vocabulary
    items: list[str | None]
    patterns: dict[int, np.ndarray]
    owners: dict[int, list[np.ndarray]]  # the items of each window

    @property
    def shortest(self) -> int:
        return min(self.patterns)


def windows_of(items: list[tuple[str | None, str | None]], size: int) -> Windows | None:
    """Distinct windows of the items; None if no item has a word."""
    words = Words(Texts(pa.array([t for _, t in items], pa.string())), LETTERS, lower=True)
    names = sorted({n for n, _ in items if n is not None})
    place = {n: i for i, n in enumerate(names)}
    place[None] = len(names)
    vocabulary: dict[bytes, int] = {}
    found: dict[int, dict[tuple[int, ...], set[int]]] = {}
    for i, (name, _) in enumerate(items):
        ids = [vocabulary.setdefault(words.word(j), len(vocabulary) + 1)
               for j in range(words.offsets[i], words.offsets[i + 1])]
        width = min(size, len(ids))
        for at in range(len(ids) - width + 1 if ids else 0):
            found.setdefault(width, {}).setdefault(tuple(ids[at : at + width]), set()).add(place[name])
    if not found:
        return None
    return Windows(
        vocabulary, np.sort(np.unique(words.hashes())), [*names, None],
        {w: np.array(list(f), np.int64) for w, f in found.items()},
        {w: [np.array(sorted(o)) for o in f.values()] for w, f in found.items()},
    )


def kept_words(words: Words, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and symbols of the words in long enough runs of benchmark words."""
    h = words.hashes()
    near = np.minimum(np.searchsorted(windows.hashes, h), len(windows.hashes) - 1)
    known = windows.hashes[near] == h
    text = words.text_of_words()
    fresh = np.ones(len(h), bool)
    fresh[1:] = ~known[1:] | ~known[:-1] | (text[1:] != text[:-1])
    run = np.cumsum(fresh) - 1
    long = np.bincount(run)[run] >= windows.shortest if len(h) else known
    at = np.flatnonzero(known & long)
    get = windows.vocabulary.get
    return at, np.fromiter((get(words.word(i), 0) for i in at), np.int64, len(at))


class Shard:
    """Documents whose kept words share one index."""

    def __init__(self):
        self.parts: list[tuple[pa.RecordBatch, np.ndarray]] = []
        self.symbols: list[np.ndarray] = []
        self.document: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        self.rows = self.size = self.bytes = 0

    def add(self, batch: pa.RecordBatch, words: Words, windows: Windows) -> None:
        at, symbols = kept_words(words, windows)
        text = words.text_of_words()[at]
        place = at - words.offsets[text]
        gap = np.flatnonzero((np.diff(at) != 1) | (np.diff(text) != 0)) + 1
        gap = np.append(gap, len(at)) if len(at) else gap
        self.parts.append((batch, words.counts))
        self.symbols.append(np.insert(symbols, gap, 0))
        self.document.append(np.insert(text + self.rows, gap, -1))
        self.place.append(np.insert(place, gap, -1))
        self.rows += batch.num_rows
        self.size += len(at)
        self.bytes += len(words.texts.data)

    def full(self) -> bool:
        return self.size >= SHARD_WORDS or self.rows >= SHARD_ROWS or self.bytes >= SHARD_BYTES

    def hits(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Document and word number of each hit word, and the items of each document."""
        symbols, document, place = (np.concatenate(x) for x in (self.symbols, self.document, self.place))
        items: list[np.ndarray] = [np.zeros(0, np.int64)] * self.rows
        covered = np.zeros(len(symbols) + 1, np.int64)
        pairs = []
        if len(symbols):
            index = FmIndex(symbols, len(windows.vocabulary) + 1)
            for width, patterns in windows.patterns.items():
                low, high = index.search(patterns)
                count = high - low
                which = np.repeat(np.arange(len(patterns)), count)
                rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + low[which]
                at = index.locate(rows)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + width, -1)
                seen = np.unique(np.stack([document[at], which]), axis=1)
                for doc, window in seen.T:
                    pairs.append((doc, windows.owners[width][window]))
        for doc, owners in pairs:
            items[doc] = np.union1d(items[doc], owners)
        hit = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
        return document[hit], place[hit], items


def spans_of(places: np.ndarray) -> list[dict]:
    """Ascending word numbers as half-open spans."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1) + 1
    return [{"start": int(p[0]), "stop": int(p[-1]) + 1} for p in np.split(places, cut)]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _search(batches: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    def flush(shard: Shard) -> Iterator[pa.RecordBatch]:
        document, place, items = shard.hits(windows)
        bounds = np.searchsorted(document, np.arange(shard.rows + 1))
        row = 0
        for batch, counts in shard.parts:
            spans, names = [], []
            for old_spans, old_items in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(),
                                            strict=True):
                places = place[bounds[row] : bounds[row + 1]]
                for s in old_spans:
                    places = np.union1d(places, np.arange(s["start"], s["stop"]))
                spans.append(spans_of(places))
                own = [windows.items[i] for i in items[row]]
                names.append(sorted({*old_items, *(n for n in own if n is not None)}))
                row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(counts.astype(np.int64)),
                 pa.array(spans, SPANS), pa.array(names, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "spans", "items"])

    shard = Shard()
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(Texts(part.column("text")), LETTERS, lower=True)
            shard.add(part, words, windows)
            if shard.full():
                yield from flush(shard)
                shard = Shard()
    if shard.rows:
        yield from flush(shard)


def find_overlaps(
    documents: DataFrame, benchmark: DataFrame, size: int = 13, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: n_words, spans (removal spans, in words) and items (their ids, sorted)."""
    spark = documents.sparkSession
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"))
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("body"))
    size_of_all = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = int(size_of_all // block_bytes) + 1
    schema = (f"doc_id {dict(rows.dtypes)['doc_id']}, text string, n_words long, "
              "spans array<struct<start:bigint,stop:bigint>>, items array<string>")
    for block in range(blocks):
        drawn = items.filter(F.pmod(F.xxhash64("id", "body"), F.lit(blocks)) == block)
        windows = windows_of([(r.id, r.body) for r in drawn.distinct().collect()], size)
        if windows is None:
            # still counts the words
            windows = Windows({}, np.zeros(1, np.uint64), [None], {size: np.zeros((0, size), np.int64)}, {size: []})
        shared = spark.sparkContext.broadcast(windows)
        rows = rows.mapInArrow(lambda batches, shared=shared: _search(batches, shared.value), schema)
        if block < blocks - 1:
            checkpoint_dir(spark)
            rows = rows.checkpoint()
    return rows.select(
        "doc_id", "n_words", "spans", "items",
        F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)"), F.lit(0).cast("long")).alias("n_hit"))
