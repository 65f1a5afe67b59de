"""Words of whole Arrow text columns as numpy arrays.

A task takes a record batch in slices of a few megabytes (a longer text is a slice of its
own), finds all words of a slice at once and works on arrays of word starts and hashes, so
memory follows the slice and not the partition. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20
SPACES = b" \t\n\x0b\x0c\r"

U = np.uint64
_RANDOM = np.random.default_rng(20240101)
_BYTE_CODES = [_RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | U(1) for _ in range(2)]
_BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
WINDOW_BASES = (U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), U(base))
    out[0] = U(1)
    return np.cumprod(out, dtype=np.uint64)


class Texts:
    """The bytes of a text column and where each text begins and ends."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
        _, offsets, data = column.buffers()
        n = len(column)
        ends = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
        size = int(ends[-1] - ends[0])
        self.bounds = ends - ends[0]
        self.data = np.frombuffer(data, np.uint8, size, int(ends[0])) if size else np.zeros(0, np.uint8)

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def table(*, outside: bytes = b"", inside: bytes | None = None) -> np.ndarray:
    """Which of the 256 byte values belong to a word."""
    out = np.ones(256, bool) if inside is None else np.zeros(256, bool)
    if inside is not None:
        out[list(inside)] = True
    out[list(outside)] = False
    return out


NOT_SPACE = table(outside=SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Starts and ends of the words of texts; words of text i are offsets[i] to offsets[i+1]."""

    def __init__(self, texts: Texts, in_word: np.ndarray = NOT_SPACE, lower: bool = False):
        data = LOWER[texts.data] if lower else texts.data
        self.data, self.texts = data, texts
        inside = in_word[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[texts.bounds] = True
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0], after[-1] = True, True
            before[1:] = ~inside[:-1] | cut[1:-1]
            after[:-1] = ~inside[1:] | cut[1:-1]
        self.inside = inside
        self.starts = np.flatnonzero(inside & before)
        self.ends = np.flatnonzero(inside & after) + 1
        self.offsets = np.searchsorted(self.starts, texts.bounds)
        self.counts = np.diff(self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """64-bit hash of each word; the two choices are independent."""
        if not len(self):
            return np.zeros(0, np.uint64)
        sizes = self.ends - self.starts
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        codes = _BYTE_CODES[which][self.data[self.inside]]
        codes *= powers(_BASES[which], int(sizes.max()) + 1)[place]
        return mix(np.add.reduceat(codes, first) + sizes.astype(np.uint64))

    def text_of_words(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def windows(h: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of `size` consecutive word hashes, built by doubling."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, block, span, weight = None, 0, h, 1, np.array([base])  # an array wraps around silently
    while True:
        if size & span:
            part = block[done : done + n]
            out = part.copy() if out is None else out * weight + part
            done += span
        if done == size:
            return mix(out)
        block = block[: len(block) - span] * weight + block[span:]
        weight = weight * weight
        span *= 2


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `limit` bytes of the column, or one row."""
    if not batch.num_rows:
        return
    bounds = Texts(batch.column(column)).bounds
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
        stop = max(start + 1, min(stop, batch.num_rows))
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    rows: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply `work` to slices of the batches."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, column):
                out = work(part)
                if out is not None:
                    yield out

    return rows.mapInArrow(run, schema)


def text_key(text: Column) -> list[Column]:
    """A text's 128-bit key in two columns; a null text has the key of an empty one."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit("second"), whole).alias("k2")]


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor
