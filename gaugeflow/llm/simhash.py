"""SimHash near-duplicates by tiled exact comparison.

Word shingles are hashed with XXH64 and each fingerprint bit is the majority of theirs. Two
fingerprints that differ in at most three bits agree on one of four 16-bit blocks, so distinct
fingerprints are dealt out by block value; a bucket beyond `bucket_rows` is cut again by the
blocks of the remaining bits. A task lays its buckets out in order of bit counts and compares them
tile by tile with exclusive-or and bit counts, small buckets many to a tile; tile pairs whose bit
counts are further apart than the radius are skipped. A bucket hands on a forest of links, and the
components are joined up over all buckets.

Cases: null texts and texts without words have fingerprint zero and are linked like any other;
a text of fewer words than a shingle is one shingle; repeated rows each get a result, copies
are one fingerprint in all comparisons; a null doc_id counts only where a group has no other;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.components import components, join_per_key
from gaugeflow.llm.words import Texts, Words, map_slices
from gaugeflow.sources.workspace import new_folder, stored

SEED = 42
RADIUS = 3
TILE = 512


def fingerprint_column(column: pa.Array, shingle: int) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text."""
    words = Words(Texts(column), lower=True)
    n = len(words.counts)
    out = np.zeros(n, np.uint64)
    if not len(words):
        return out
    sizes = words.ends - words.starts
    stops = np.cumsum(sizes + 1)
    begins = stops - sizes - 1
    joined = np.full(int(stops[-1]), 32, np.uint8)
    joined[np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))] = (
        words.data[words.inside])
    counts = np.where(words.counts > 0, np.maximum(words.counts - shingle + 1, 1), 0)
    width = np.minimum(words.counts, shingle)
    first = np.repeat(words.offsets[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    last = first + np.repeat(width, counts) - 1
    data, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(begins[first].tolist(), (stops[last] - 1).tolist(), strict=True)),
        np.uint64, len(first))
    full = np.flatnonzero(counts)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.add.reduceat(bits, (np.cumsum(counts) - counts)[full], axis=0, dtype=np.int32)
    out[full] = np.packbits(2 * sums > counts[full, None], axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def fingerprints(
    documents: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and fingerprint (a long that holds the 64 bits) of every document."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = fingerprint_column(batch.column(1), shingle).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "bits"])

    return map_slices(rows, "text", work, f"doc_id {dict(rows.dtypes)['doc_id']}, bits long")


def _forest(pairs: np.ndarray) -> np.ndarray:
    """The pairs that join two components so far."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    kept = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def _merged(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Roots after classes were linked: the least root of each new class."""
    up = np.arange(len(root))
    while True:
        low = up[pairs].min(1)
        after = up.copy()
        np.minimum.at(after, pairs[:, 0], low)
        np.minimum.at(after, pairs[:, 1], low)
        after = after[after]
        if (after == up).all():
            return up[root]
        up = after


def tile_links(keys: np.ndarray, codes: np.ndarray, radius: int) -> np.ndarray:
    """Pairs of positions that connect all codes of a bucket within the radius, for whole buckets.

    Rows must lie in order of bucket and bit count. A tile meets itself and the tiles behind it that
    begin in its last bucket, until their bit counts are beyond the radius.
    """
    weight = np.bitwise_count(codes).astype(np.int64)
    root, found = np.arange(len(codes)), [np.zeros((0, 2), np.int64)]
    for i in range(0, len(codes), TILE):
        a = slice(i, min(i + TILE, len(codes)))
        for j in range(i, len(codes), TILE):
            b = slice(j, min(j + TILE, len(codes)))
            if i != j and (keys[b][0] != keys[a][-1] or weight[b][0] - weight[a][-1] > radius):
                break
            near = np.bitwise_count(codes[a, None] ^ codes[None, b]) <= radius
            near &= keys[a, None] == keys[None, b]
            left, right = np.nonzero(np.triu(near, 1) if i == j else near)
            pairs = np.stack([root[i + left], root[j + right]], 1)
            pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
            if len(pairs):
                found.append(_forest(pairs))
                root = _merged(root, found[-1])
    return np.concatenate(found)


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    def links(keys: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((np.bitwise_count(codes), keys))
        codes = codes[order]
        u, v = codes[tile_links(keys[order], codes, radius)].view(np.int64).reshape(-1, 2).T
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u.copy()), pa.array(v.copy())], ["u", "v"])

    keys, codes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        codes = np.concatenate([codes, batch.column(1).to_numpy().view(np.uint64)])
        earlier = np.flatnonzero(keys != keys[-1]) if len(keys) else []
        if len(earlier):
            whole = int(earlier[-1]) + 1  # the last bucket may go on in the next batch
            yield from links(keys[:whole], codes[:whole])
            keys, codes = keys[whole:], codes[whole:]
    if len(keys):
        yield from links(keys, codes)


def _cut(first_bit: int, bits: int, code: str = "code") -> str:
    return f"shiftrightunsigned({code}, {first_bit}) & {(1 << bits) - 1}"


def links(codes: DataFrame, radius: int = RADIUS, bucket_rows: int = 4096) -> DataFrame:
    """u, v: links that connect all distinct codes (long column `code`) within the radius.

    By the pigeonhole, radius + 1 blocks; a bucket beyond `bucket_rows` is cut by the blocks
    of its other bits, twice at most (then codes agree in 37 of 64 bits at radius three).
    """
    parts = radius + 1

    def split(ranges: list[int]) -> list[list[int]]:
        cuts = [len(ranges) * i // parts for i in range(parts + 1)]
        return [ranges[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def runs(bits: list[int]) -> list[tuple[int, int]]:
        out: list[list[int]] = []
        for bit in bits:
            if out and out[-1][0] + out[-1][1] == bit:
                out[-1][1] += 1
            else:
                out.append([bit, 1])
        return [tuple(x) for x in out]

    ready, open_ = None, [(codes.select("code", F.lit(0).cast("long").alias("key")), list(range(64)))]
    for depth in range(3):
        following = []
        for rows, bits in open_:
            for i, block in enumerate(split(bits)):
                key = F.xxhash64(F.col("key"), F.lit(i), *(F.expr(_cut(*part)) for part in runs(block)))
                own = rows.select("code", key.alias("key"))
                following.append((own, [b for b in bits if b not in block]))
        if depth == 2:
            buckets = [rows for rows, _ in following]
        else:
            all_rows = following[0][0]
            for rows, _ in following[1:]:
                all_rows = all_rows.unionByName(rows)
            hot = all_rows.groupBy("key").count().filter(F.col("count") > bucket_rows).select("key").checkpoint()
            if hot.isEmpty():
                buckets, following = [rows for rows, _ in following], []
            else:
                buckets = [rows.join(hot, "key", "left_anti").select("code", "key") for rows, _ in following]
                following = [(rows.join(hot, "key", "left_semi").select("code", "key"), bits)
                             for rows, bits in following]
        for rows in buckets:
            ready = rows if ready is None else ready.unionByName(rows)
        open_ = following
        if not open_:
            break
    dealt = ready.select("key", "code").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(lambda batches: _bucket_links(batches, radius), "u long, v long")


def near_duplicates(
    documents: DataFrame, shingle: int = 3, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text",
    bucket_rows: int = 4096,
) -> DataFrame:
    """doc_id, bits and component_id (the smallest doc_id reachable) of every document."""
    spark = documents.sparkSession
    folder = new_folder(spark, "fingerprints")
    fingerprints(documents, shingle, doc_id, text).write.parquet(folder)
    rows = spark.read.parquet(folder)
    distinct = stored(
        rows.groupBy(F.col("bits").alias("code")).agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")),
        "codes")
    total = rows.count()
    found = components(links(distinct.select("code"), radius, bucket_rows))
    reached = found.join(distinct, found["node"] == distinct["code"]).select("code", "root", "least_id")
    least = reached.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    moved = join_per_key(reached.drop("least_id"), least, "root", total).select("code", "component_id")
    ids = distinct.join(moved, "code", "left").select(
        F.col("code").alias("bits"), F.coalesce("component_id", "least_id").alias("component_id"), "n")
    return join_per_key(rows, ids, "bits", total, distinct.withColumnRenamed("code", "bits")).select("doc_id", "bits", "component_id")


def hex_digits(bits: str = "bits") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(bits)), 16, "0"))
