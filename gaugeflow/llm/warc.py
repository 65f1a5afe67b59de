"""WARC archives: written with an index, read back by coalesced byte ranges.

Payloads are named by their SHA-256 and counted first. Rows whose payload surely occurs once are
written as they are scanned. Of the others only those that may be responses carry their payload
through the shuffle, the rest a digest. Two filters of fixed size tell them apart; they only save
work. Payloads of more than 1/256 of all rows are looked up in a broadcast list and dealt over
tasks.

Each task writes its records to an archive of its own in the shared folder, one gzip member per
record, and returns index rows (archive, offset, length, url, digest). The stored index decides
which archives count: one left by a lost task is named by no row. The reader sorts the selected
index rows by archive and offset, joins neighbouring ranges to one read and parses the records.

Cases: a null payload is empty; a null url is left out; all rows with the smallest page_id of
equal payloads are responses, so that a revisit always has one to refer to; a payload whose
rows have no page_id has responses only; an empty table gives an empty index and result;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.substrings import BitFilter
from gaugeflow.llm.words import map_slices
from gaugeflow.sources.workspace import new_folder, stored

INDEX = (
    "archive string, offset long, length long, page_id long, url string, digest string, record_type string, "
    "refers_to long"
)
ARCHIVE_BYTES = 1 << 30
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
FILTER_BITS = 26
#: A payload of more than this part of all rows (and this many rows) is hot.
HOT_SHARE = 256
HOT_ROWS = 1000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder URI and the path in it."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without a block."""
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        head += [("X-Refers-To-Page-Id", str(refers_to)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    block = HTTP_HEAD + payload if refers_to is None else b""
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else b""


def _compress(data: bytes) -> bytes:
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def plan_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0
) -> DataFrame:
    """page_id, url, payload, digest and refers_to (the response that the row repeats, or null).

    Either payload or digest may be missing: a response has its payload, of a revisit one of the
    two is enough.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("content", F.unhex(F.sha2("payload", 256)))
    groups = stored(
        rows.filter(F.octet_length("payload") >= least_bytes).groupBy("content")
        .agg(F.min("page_id").alias("least"), F.count("*").alias("n")), "payloads")
    again = groups.filter("n > 1")
    total = groups.agg(F.sum("n")).first()[0] or 0
    copied = spark.sparkContext.broadcast(BitFilter(again.select(F.xxhash64("content").alias("key")), "key", FILTER_BITS))
    first = spark.sparkContext.broadcast(
        BitFilter(groups.select(F.xxhash64("content", "least").alias("key")), "key", FILTER_BITS))
    keyed = rows.select(
        "*", F.xxhash64("content").alias("key"), F.xxhash64("content", "page_id").alias("own"),
        (F.octet_length("payload") < least_bytes).alias("small"))
    id_and_url = "page_id long, url string, payload string"

    def alone(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = batch.filter(pa.array(~copied.value.may_hold(_keys(batch, "key"))))
        return out.select(["page_id", "url", "payload"])

    def together(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = batch.filter(pa.array(copied.value.may_hold(_keys(batch, "key"))))
        carried = first.value.may_hold(_keys(out, "own")) | out.column("small").to_numpy(zero_copy_only=False)
        payloads = out.column("payload").to_pylist()
        digests = pa.array([None if c else digest_of(p.encode()) for c, p in zip(carried, payloads, strict=True)], pa.string())
        bodies = pa.array([p if c else None for c, p in zip(carried, payloads, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays(
            [out.column("page_id"), out.column("url"), bodies, out.column("content"), digests],
            ["page_id", "url", "payload", "content", "digest"])

    lone = map_slices(keyed.drop("content", "own", "small"), "payload", alone, id_and_url).withColumns(
        {"digest": F.lit(None).cast("string"), "refers_to": F.lit(None).cast("long")})
    rest = map_slices(keyed, "payload", together, id_and_url + ", content binary, digest string")
    hot = F.col("n") > max(total / HOT_SHARE, HOT_ROWS)
    spread = F.pmod(F.xxhash64("page_id", "url"), F.lit(HOT_SHARE)).cast("int")
    dealt = rest.join(F.broadcast(again.filter(hot).select("content", F.col("least").alias("hot_least"), F.lit(True).alias("hot"))),
                      "content", "left").withColumn("salt", F.when(F.col("hot"), spread).otherwise(0))
    cold = again.filter(~hot).select("content", "least", F.lit(0).alias("salt"))
    least = F.coalesce("hot_least", "least")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != least), least)
    joined = dealt.join(cold, ["content", "salt"], "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))
    return lone.unionByName(joined)


def _keys(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().view(np.uint64)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the archives into the folder and return the stored index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(f"{root}/archives", recursive=True)
        stream, name, offset = None, "", 0
        try:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    if stream is None or offset >= ARCHIVE_BYTES:
                        if stream is not None:
                            stream.close()
                        name, offset = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                        stream = system.open_output_stream(f"{root}/{name}", compression=None)
                    payload = None if row["payload"] is None else row["payload"].encode()
                    digest = digest_of(payload) if row["digest"] is None else row["digest"]
                    data = _compress(record(row["page_id"], row["url"], payload, digest, row["refers_to"]))
                    stream.write(data)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    out.append((name, offset, len(data), row["page_id"], row["url"], digest, kind,
                                row["refers_to"]))
                    offset += len(data)
                if out:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                             pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                        [f.split()[0] for f in INDEX.split(", ")])
        finally:
            if stream is not None:
                stream.close()

    records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return records.sparkSession.read.parquet(f"{folder}/index")


def ranges(offsets: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last+1 of the sorted records that one read fetches."""
    first = 0
    for i in range(1, len(offsets) + 1):
        if i == len(offsets) or (
            offsets[i] - offsets[i - 1] - lengths[i - 1] > GAP_BYTES
            or offsets[i] + lengths[i] - offsets[first] > RANGE_BYTES
        ):
            yield first, i
            first = i


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """page_id, url, record_type, refers_to, digest (of the header) and payload of index rows.

    The archives are dealt out in stretches of a fixed size, as many tasks as there are such
    amounts to read (index rows say nothing about that), and read in order.
    """
    amount = selected.agg(F.sum("length")).first()[0] or 0
    rows = (
        selected.select("archive", "offset", "length", F.expr(f"offset div {RANGE_BYTES}").alias("stretch"))
        .repartition(int(amount // RANGE_BYTES) + 1, "archive", "stretch").sortWithinPartitions("archive", "offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            offsets, lengths = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1), len(names)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                with system.open_input_file(f"{root}/{names[a]}") as archive:
                    for i, j in ranges(offsets[a:b], lengths[a:b]):
                        start = int(offsets[a + i])
                        stop = int(offsets[a + j - 1] + lengths[a + j - 1])
                        data = archive.read_at(stop - start, start)
                        out = []
                        for k in range(a + i, a + j):
                            at = int(offsets[k]) - start
                            fields, payload = parse(zlib.decompress(data[at : at + int(lengths[k])], 31))
                            page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
                            out.append((page and int(page), fields.get("WARC-Target-URI"), fields["WARC-Type"],
                                        refers and int(refers), fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                        payload))
                        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                            ["page_id", "url", "record_type", "refers_to", "digest", "payload"])

    return rows.mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, digest string, payload binary")


def round_trip(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Archive all pages, read all records back: page_id, payload_bytes, payload_digest,
    record_type and refers_to, a revisit with the size of the response that it refers to."""
    folder = new_folder(pages.sparkSession, "warc")
    index = write_archives(plan_records(pages, page_id, url, payload, least_bytes), folder)
    read = read_records(index, folder).select(
        "page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("bytes"))
    stored = new_folder(pages.sparkSession, "records")
    read.write.parquet(stored)
    read = pages.sparkSession.read.parquet(stored)
    responses = (
        read.filter("record_type = 'response' and page_id is not null")
        .join(read.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id"), "digest").distinct(),
              ["page_id", "digest"], "left_semi")
        .groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.min("bytes").alias("full"))
    )
    whole = F.when(F.col("record_type") == "response", F.col("bytes")).otherwise(F.col("full"))
    return read.join(responses, ["refers_to", "digest"], "left").select(
        "page_id", whole.alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
