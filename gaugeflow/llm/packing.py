"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Documents become token ids; whole windows are cut off long ones and the rest is cut into
pieces. Pieces are gathered until they nearly fill a number of windows, and the differencing
method spreads them: it keeps partial partitions in order of imbalance and merges the two
most imbalanced, the fullest windows of one with the emptiest of the other. The windows come
out nearly equal; if one exceeds the capacity, their number rises and the pieces are spread again.

Everything happens in the task that reads the documents: no shuffle, and memory for one group.

Cases: a null or empty text is the single end token; each row is packed on its own, also a
repeated one; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.words import NOT_SPACE, Texts, Words, slices

# The pre-tokenizer's pattern of the public byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# UTF-8 of the white space beyond ASCII, and the token that the vocabulary file adds.
WIDE_BLANKS = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
ADDED = b"<|endoftext|>"
LONG_CHUNK = 1 << 14  # bytes; the quick encoder's patterns recurse over long white space
LONG_TEXT = 1 << 17
KNOWN_CHUNKS = 300_000
LONGEST_KNOWN = 64


def byte_letters() -> dict[str, int]:
    """The printable letter that the vocabulary file writes for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def chunk_starts(texts: Texts) -> np.ndarray:
    """Where a text can be cut without changing its tokens: at white space, of which the last
    blank goes with the word behind it and the rest stays together."""
    data = texts.data
    blank = ~NOT_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[texts.bounds] = True
    before = np.zeros(len(data), bool)
    before[1:] = blank[:-1]
    behind = np.zeros(len(data), bool)
    behind[:-1] = ~blank[1:] & ~first[1:-1]
    space_before = np.zeros(len(data), bool)
    space_before[1:] = data[:-1] == 32
    return np.flatnonzero(
        first[:-1] | (blank & ~before) | (blank & before & behind) | (~blank & before & ~space_before))


class Encoder:
    """Token ids of whole texts, by a byte-level vocabulary file of the tokenizers library.

    Texts are cut into chunks that are encoded on their own; a bounded number of chunks is
    remembered by hash. A text with blanks beyond ASCII is encoded whole. Long chunks, long texts
    with such blanks, and texts that spell out the added token are left to the library itself.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items()
                 if all(c in letters for c in token)}
        self.bpe = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks={t: r for t, r in ranks.items() if t != b"<|endoftext|>"},
            special_tokens={})
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """One array of ids per text."""
        texts = Texts(column)
        if not len(texts.data):
            return [np.zeros(0, np.uint32)] * len(column)
        starts = chunk_starts(texts)
        chunks = Words.__new__(Words)
        chunks.data, chunks.texts, chunks.inside = texts.data, texts, slice(None)
        chunks.starts, chunks.ends = starts, np.append(starts[1:], len(texts.data))
        keys, index, inverse = np.unique(chunks.hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        ids = [self._chunk(chunks.word(i)) for i in index[~known]]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        fresh = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        pool = np.concatenate([self.pool, fresh])
        first, count = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        first[known], count[known] = self.first[at[known]], self.count[at[known]]
        first[~known] = len(self.pool) + np.cumsum(sizes) - sizes
        count[~known] = sizes
        if len(self.keys) < KNOWN_CHUNKS:
            self._remember(keys, first, count, pool, ~known, chunks.ends[index] - starts[index])
        first, count = first[inverse], count[inverse]
        place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - first, count)
        out = pool[place]
        bounds = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, texts.bounds)]
        result = [out[bounds[i] : bounds[i + 1]] for i in range(len(column))]
        added = ADDED in texts.data.tobytes()
        if added or WIDE_BLANKS.search(texts.data):
            for i in range(len(column)):
                whole = texts.raw(i)
                wide = WIDE_BLANKS.search(whole)
                if ADDED in whole or (wide and len(whole) > LONG_TEXT):
                    result[i] = np.array(self.library.encode(whole.decode(), add_special_tokens=False).ids, np.uint32)
                elif wide:
                    result[i] = np.array(self.bpe.encode_ordinary(whole.decode()), np.uint32)
        return result

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _chunk(self, chunk: bytes) -> list[int]:
        if len(chunk) > LONG_CHUNK:
            return self.library.encode(chunk.decode(), add_special_tokens=False).ids
        return self.bpe.encode_ordinary(chunk.decode())

    def _remember(self, keys, first, count, pool, new, sizes) -> None:
        new = np.flatnonzero(new & (sizes <= LONGEST_KNOWN))[: KNOWN_CHUNKS - len(self.keys)]
        own = count[new]
        place = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own - first[new], own)
        all_keys = np.concatenate([self.keys, keys[new]])
        order = np.argsort(all_keys)
        self.keys = all_keys[order]
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(own) - own])[order]
        self.count = np.concatenate([self.count, own])[order]
        self.pool = np.concatenate([self.pool, pool[place]])


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder; it is kept for the tasks that follow."""
    return Encoder(path)


def spread(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: the pieces (by position) of each of `ways` nearly equal windows."""
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [(size, (i,))]))
    heapq.heapify(heap)
    # a partition lists only its windows in use, fullest first; the others are empty
    while len(heap) > 1:
        _, tie, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = a[:]
        free = ways - len(a)
        rest = b[:]
        # b's fullest windows join a's emptiest: first a's unused ones, then its smallest
        merged += rest[:free]
        for k, (size, own) in enumerate(rest[free:]):
            at = len(a) - 1 - k
            merged[at] = (merged[at][0] + size, merged[at][1] + own)
        merged.sort(reverse=True, key=lambda w: w[0])
        low = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (low - merged[0][0], tie, merged))
    windows = [list(own) for _, own in heap[0][2]] if heap else []
    return windows


def pack_group(sizes: list[int], capacity: int) -> list[list[int]]:
    """Fewest windows, from the least number that could hold all, in which the spread fits."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = spread(sizes, ways)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return windows
        ways += 1


def _pieces(total: int, capacity: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Whole windows first; the rest by halves, so that small pieces can even out windows."""
    start = 0
    while total - start >= capacity:
        yield start, capacity
        start += capacity
    while total - start > 2 * shortest:
        length = (total - start) // 2
        yield start, length
        start += length
    if total > start:
        yield start, total - start


def pack(
    documents: DataFrame, tokenizer_path: str, capacity: int = 1024, doc_id: str = "doc_id", text: str = "text",
    end_id: int = 0, shortest_piece: int = 4, group_windows: int = 64, slack: int = 8, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it comes from, its sequence and offset there, its ids.

    A group of pieces is packed once it holds `group_windows` windows less `slack` tokens
    each. Sequence ids are unique; they carry the partition's number.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    ids_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {ids_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + ", token_ids array<int>" * with_ids)
    end = np.array([end_id], "<u4").tobytes()
    documents.sparkSession.sparkContext.addFile(tokenizer_path)
    file_name = os.path.basename(tokenizer_path)

    def run(batches):
        tokens = encoder(SparkFiles.get(file_name))
        sequence = TaskContext.get().partitionId() << 40
        group: list[tuple] = []  # id, start, length, total, bytes
        held = 0
        target = group_windows * (capacity - slack)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(columns[0], id_arrow), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(b, "<i4") for b in columns[7]], pa.list_(pa.int32())))
                names.append("token_ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        def row(piece: tuple, offset: int) -> tuple:
            name, start, length, total, ids = piece
            return name, start, length, zlib.crc32(ids), total, sequence, offset, ids

        def flush() -> list[tuple]:
            nonlocal sequence, group, held
            out = []
            for window in pack_group([p[2] for p in group], capacity):
                offset = 0
                for i in window:
                    out.append(row(group[i], offset))
                    offset += group[i][2]
                sequence += 1
            group, held = [], 0
            return out

        id_arrow = None
        for whole in batches:
            id_arrow = whole.schema.field(0).type
            for part in slices(whole, "text"):
                out: list[tuple] = []
                names = part.column(0).to_pylist()
                for name, own in zip(names, tokens.encode(part.column(1)), strict=True):
                    ids = own.astype("<u4").tobytes() + end
                    total = len(ids) // 4
                    for start, length in _pieces(total, capacity, shortest_piece):
                        piece = ids[4 * start : 4 * (start + length)]
                        if length == capacity:
                            out.append(row((name, start, length, total, piece), 0))
                            sequence += 1
                            continue
                        while held + length >= target:  # cut where the group is full
                            room = target - held
                            if room:
                                group.append((name, start, room, total, piece[: 4 * room]))
                                start, length, piece = start + room, length - room, piece[4 * room :]
                            out += flush()
                        if length:
                            group.append((name, start, length, total, piece))
                            held += length
                if out:
                    yield batch_of(out)
        if group:
            yield batch_of(flush())

    return rows.mapInArrow(run, schema)
