"""Delimited records of files that are read in splits, and content hashes of the files.

Quotes are read as spreadsheets write them: a quote is special at the beginning of a cell only,
within quotes a doubled quote is one, and delimiters and line breaks belong to the cell. Behind a
closing quote only a delimiter or the end of the record may follow. A file that breaks these rules
anywhere, or leaves a quote open, is damaged as a whole: its readings could belong to any flat.

A split does not know whether it begins within a quoted cell. Its task therefore reads it as if it
did not, and next to that, up to the first line after which both agree, as if it did. Per split one
row of facts is left: record counts and open ends under both assumptions, and the hash of its
lines. Facts are folded per file, in order; that tells which reading of a split holds, how many
records lie before it and which record spans two splits. No file is read twice or by one task.

The content hash is a polynomial over the digests of the lines (by line feed), modulo a prime:
hashes of neighbouring splits combine, so that it depends neither on where the splits lie nor on
their number. With it goes the size, which tells a last line feed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.sources.shipping import ship_package
from gaugeflow.sources.workspace import stored

PRIME = 2**127 - 1
BASE = 0x5BD1E995_9E3779B9_85EBCA6B_C2B2AE35 % PRIME
CELL_CHARACTERS = 32_767  # the most a spreadsheet cell can hold
CELL_BYTES = 4 * CELL_CHARACTERS
BATCH_BYTES = 1 << 22
BAD_QUOTES = "quotes are not balanced"

LINE, PARSED, FACTS = 0, 1, 2  # kinds of staged rows; PARSED: as if the split began within quotes

_CELLS = "array<binary>"
_FACTS = (
    f"struct<lines:long, hash:string, records:long, open:{_CELLS}, broken:boolean, inner_records:long, "
    f"inner_first:{_CELLS}, inner_open:{_CELLS}, inner_broken:boolean, meets:long, shift:long>"
)
STAGED = f"source_file string, split long, kind int, n long, line binary, cells {_CELLS}, facts {_FACTS}"
_FOLDED = (
    f"source_file string, split long, offset long, inner boolean, meets long, shift long, cells {_CELLS}, "
    "damage string, file_hash string"
)


class Broken(ValueError):
    """Quotes that cannot be read."""


class Reader:
    """Records of lines one after another; `quoted` holds the open quoted cell's parts."""

    def __init__(self, delimiter: bytes, inside: bool = False):
        self.delimiter = delimiter
        self.cells: list[bytes] = []
        self.quoted: list[bytes] | None = [] if inside else None
        self.held = 0

    @property
    def open(self) -> list[bytes] | None:
        """Cells of the unfinished record, the last one open; None between records."""
        return None if self.quoted is None else [*self.cells, b"".join(self.quoted)]

    def feed(self, line: bytes) -> list[bytes | list[bytes]]:
        """Records that end in the line: plain lines as they are, others as cells."""
        if self.quoted is None and b'"' not in line and b"\r" not in line:
            return [line]
        records: list[bytes | list[bytes]] = []
        at, size = 0, len(line)
        while True:
            if self.quoted is None and line.startswith(b'"', at):
                self.quoted, self.held, at = [], 0, at + 1
            if self.quoted is None:
                stop = self._plain_end(line, at)
                self.cells.append(line[at:stop])
            else:
                stop = self._quoted_end(line, at)
                if stop is None:
                    return records
            if stop < size and line[stop] != 13:  # a delimiter: another cell
                at = stop + len(self.delimiter)
                continue
            records.append(self.cells)
            self.cells = []
            at = stop + 1  # behind a carriage return: another record, or the end of the line
            if at >= size:
                return records

    def _plain_end(self, line: bytes, at: int) -> int:
        stop = line.find(self.delimiter, at)
        stop = len(line) if stop < 0 else stop
        back = line.find(b"\r", at, stop)
        return stop if back < 0 else back

    def _quoted_end(self, line: bytes, at: int) -> int | None:
        """The place behind the closing quote, or None if the cell goes on in the next line."""
        while True:
            quote = line.find(b'"', at)
            stop = len(line) if quote < 0 else quote
            self.quoted.append(line[at:stop])
            self.held += stop - at
            if self.held > CELL_BYTES:
                raise Broken
            if quote < 0:
                self.quoted.append(b"\n")
                return None
            if line[quote + 1 : quote + 2] != b'"':
                break
            self.quoted.append(b'"')
            at = quote + 2
        self.cells.append(b"".join(self.quoted))
        self.quoted = None
        if quote + 1 < len(line) and line[quote + 1] != 13 and not line.startswith(self.delimiter, quote + 1):
            raise Broken
        return quote + 1


class LineHash:
    """Polynomial over digests of lines."""

    def __init__(self, value: int = 0, lines: int = 0):
        self.value, self.lines = value, lines

    def add(self, line: bytes) -> None:
        digest = int.from_bytes(hashlib.blake2b(line, digest_size=16).digest(), "big")
        self.value = (self.value * BASE + digest + 1) % PRIME
        self.lines += 1

    def followed_by(self, other: LineHash) -> LineHash:
        value = (self.value * pow(BASE, other.lines, PRIME) + other.value) % PRIME
        return LineHash(value, self.lines + other.lines)


class SplitScan:
    """One split read under both assumptions."""

    def __init__(self, source_file: str, split: int, delimiter: bytes | None):
        self.source_file, self.split = source_file, split
        self.hash = LineHash()
        self.outer = None if delimiter is None else Reader(delimiter)
        self.inner = Reader(delimiter, inside=True) if delimiter is not None and split else None
        self.facts = {"records": 0, "open": None, "broken": False, "inner_records": 0, "inner_first": None,
                      "inner_open": None, "inner_broken": not split, "meets": None, "shift": None}

    def feed(self, line: bytes) -> list[tuple[int, int, bytes | list[bytes]]]:
        """Rows (kind, number, record) that the line completes."""
        self.hash.add(line)
        facts, rows = self.facts, []
        if self.outer is not None:
            try:
                for record in self.outer.feed(line):
                    rows.append((LINE, facts["records"], record))
                    facts["records"] += 1
            except Broken:
                facts["broken"], self.outer = True, None
        if self.inner is not None:
            try:
                for record in self.inner.feed(line):
                    if not facts["inner_records"]:
                        facts["inner_first"] = record
                    else:
                        rows.append((PARSED, facts["inner_records"], record))
                    facts["inner_records"] += 1
            except Broken:
                facts["inner_broken"], self.inner = True, None
            if self.outer is not None and self.inner is not None and self.outer.quoted is None and self.inner.quoted is None:
                facts["meets"], facts["shift"] = facts["records"], facts["inner_records"] - facts["records"]
                self.inner = None
        return rows

    def end(self) -> dict:
        ends = {"open": self.outer and self.outer.open, "inner_open": self.inner and self.inner.open}
        return {**self.facts, **ends, "lines": self.hash.lines, "hash": f"{self.hash.value:032x}"}


def _rows(found: list[tuple]) -> pa.RecordBatch:
    types = pa.schema([
        ("source_file", pa.string()), ("split", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()),
        ("line", pa.binary()), ("cells", pa.list_(pa.binary())), ("facts", _FACTS_TYPE)])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), field.type) for column, field in zip(zip(*found, strict=True), types, strict=True)],
        schema=types)


_CELLS_TYPE = pa.list_(pa.binary())
_FACTS_TYPE = pa.struct([
    ("lines", pa.int64()), ("hash", pa.string()), ("records", pa.int64()), ("open", _CELLS_TYPE), ("broken", pa.bool_()),
    ("inner_records", pa.int64()), ("inner_first", _CELLS_TYPE), ("inner_open", _CELLS_TYPE), ("inner_broken", pa.bool_()),
    ("meets", pa.int64()), ("shift", pa.int64())])


def _scan(delimiter: bytes | None):
    """Lines of a partition, split after split, to staged rows; without delimiter only facts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, found, size = None, [], 0
        for batch in batches:
            names, splits = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, split, line in zip(names, splits, batch.column(2), strict=True):
                if scan is None or (scan.source_file, scan.split) != (name, split):
                    if scan is not None:
                        found.append((scan.source_file, scan.split, FACTS, None, None, None, scan.end()))
                    scan = SplitScan(name, split, delimiter)
                line = line.as_py()
                for kind, n, record in scan.feed(line):
                    plain = isinstance(record, bytes)
                    found.append((name, split, kind, n, record if plain else None, None if plain else record, None))
                size += len(line)
                if size > BATCH_BYTES:
                    if found:
                        yield _rows(found)
                    found, size = [], 0
        if scan is not None:
            found.append((scan.source_file, scan.split, FACTS, None, None, None, scan.end()))
        if found:
            yield _rows(found)

    return run


def _joined(before: list[bytes], after: list[bytes]) -> list[bytes]:
    """Cells of a record that goes on in the next split."""
    return [*before[:-1], before[-1] + after[0], *after[1:]]


def fold_splits(facts: list[tuple[int, dict]], size: int) -> list[dict]:
    """What holds for every split of a file, in order, and a last row with the file's verdict."""
    rows, total, offset = [], LineHash(), 0
    carried: list[bytes] | None = None
    damaged = False
    for split, fact in facts:
        total = total.followed_by(LineHash(int(fact["hash"], 16), fact["lines"]))
        row = {"split": split, "offset": offset, "inner": carried is not None, "meets": None, "shift": None, "cells": None}
        if carried is None:
            damaged |= fact["broken"]
            offset, carried = offset + fact["records"], fact["open"]
        elif not fact["inner_records"]:
            damaged |= fact["inner_broken"] or fact["inner_open"] is None
            carried = None if damaged else _joined(carried, fact["inner_open"])
            damaged |= carried is not None and len(carried[-1]) > CELL_BYTES
        else:
            row["cells"] = _joined(carried, fact["inner_first"])
            damaged |= fact["inner_broken"] or len(row["cells"][len(carried) - 1]) > CELL_BYTES
            if fact["meets"] is None:
                offset, carried = offset + fact["inner_records"], fact["inner_open"]
            else:
                damaged |= fact["broken"]
                row["meets"], row["shift"] = fact["meets"], fact["shift"]
                offset, carried = offset + fact["records"] + fact["shift"], fact["open"]
        rows.append(row)
        if damaged:
            carried = None
    damaged |= carried is not None
    verdict = {"damage": BAD_QUOTES if damaged else None, "file_hash": f"{total.value:032x}{size:x}"}
    return [{**row, "damage": verdict["damage"]} for row in rows] + [verdict]


def _fold(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    facts = sorted((row["split"], row["facts"]) for row in rows if row["split"] is not None)
    name, size = rows[0]["source_file"], max(row["size"] for row in rows)
    types = pa.schema([
        ("source_file", pa.string()), ("split", pa.int64()), ("offset", pa.int64()), ("inner", pa.bool_()),
        ("meets", pa.int64()), ("shift", pa.int64()), ("cells", _CELLS_TYPE), ("damage", pa.string()), ("file_hash", pa.string())])
    return pa.Table.from_pylist([{"source_file": name, **row} for row in fold_splits(facts, size)], schema=types)


class DelimitedFiles:
    """Delimited text files, scanned once: their records, hashes and verdicts.

    `listed` has source_file and size of every file; files of no bytes are not listed. Without a
    delimiter only hashes are found, of files of any kind.
    """

    def __init__(self, lines: DataFrame, listed: DataFrame, delimiter: str | None):
        self.delimiter = delimiter
        ship_package(lines.sparkSession)
        scan = _scan(None if delimiter is None else delimiter.encode())
        self.staged = stored(lines.mapInArrow(scan, STAGED), "lines")
        facts = self.staged.filter(F.col("kind") == FACTS).select("source_file", "split", "facts")
        folded = listed.join(facts, "source_file", "left").groupBy("source_file").applyInArrow(_fold, _FOLDED)
        self.folded = stored(folded, "splits")

    @property
    def files(self) -> DataFrame:
        """source_file, file_hash and damage (NULL for files that can be read)."""
        return self.folded.filter(F.col("split").isNull()).select("source_file", "file_hash", "damage")

    def rows(self) -> DataFrame:
        """(source_file, row_idx, cells as text) of the files that are not damaged."""
        splits = self.folded.filter(F.col("split").isNotNull() & F.col("damage").isNull())
        outer = F.col("kind") == LINE
        holds = F.when(~F.col("inner"), outer).otherwise(~outer | (F.col("n") >= F.col("meets")))
        shift = F.when(outer & F.col("inner"), F.col("shift")).otherwise(F.lit(0))
        lines = (
            self.staged.filter(F.col("kind") != FACTS).drop("facts")
            .join(splits.drop("cells"), ["source_file", "split"])
            .filter(holds)
            .select("source_file", (F.col("offset") + F.col("n") + shift).alias("row_idx"), "line", "cells")
        )
        spanning = splits.filter(F.col("cells").isNotNull()).select(
            "source_file", F.col("offset").alias("row_idx"), F.lit(None).cast("binary").alias("line"), "cells")
        return lines.unionByName(spanning).select("source_file", "row_idx", self._text().alias("cells"))

    def _text(self) -> Column:
        quoted = F.transform("cells", lambda cell: cell.cast("string"))
        mark = self.delimiter if self.delimiter.isalnum() or len(self.delimiter) > 1 else "\\" + self.delimiter
        pattern = mark if len(self.delimiter) == 1 else f"\\Q{mark}\\E"
        return F.coalesce(quoted, F.split(F.col("line").cast("string"), pattern, -1))
