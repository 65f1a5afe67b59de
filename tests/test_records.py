"""Quoted cells, line breaks in cells and content hashes, over files read in one and in many splits."""

import csv
import io
import random

import pytest

from gaugeflow.plans import jobs
from gaugeflow.sources.files import delimited_files, delimited_sheet_rows, file_hashes
from gaugeflow.sources.records import BAD_QUOTES, Broken, LineHash, Reader, SplitScan, fold_splits
from tests.helpers import values

NAME = "T C Eb readings.csv"


@pytest.fixture(params=[None, "700"])
def splits(spark, request):
    """Files as a whole, or in splits of 700 bytes."""
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(text: bytes, delimiter: bytes = b","):
    reader, found = Reader(delimiter), []
    for line in text.split(b"\n"):
        found += [r.split(delimiter) if isinstance(r, bytes) else r for r in reader.feed(line)]
    return found, reader.open


@pytest.mark.parametrize("text, wanted", [
    (b'a,"b",c', [[b"a", b"b", b"c"]]),
    (b'5",7",8', [[b'5"', b'7"', b"8"]]),  # quotes within a cell are characters
    (b'say "x",y', [[b'say "x"', b"y"]]),
    (b'"say ""x""","",""""', [[b'say "x"', b"", b'"']]),
    (b'"a,b\nc""\n",d\r\ne,f\r', [[b'a,b\nc"\n', b"d"], [b"e", b"f"]]),
    (b'a,b\rc,"d"\re', [[b"a", b"b"], [b"c", b"d"], [b"e"]]),
    (b',"",\n\n"x",', [[b"", b"", b""], [b""], [b"x", b""]]),
    (b'"a\rb",c', [[b"a\rb", b"c"]]),
])
def test_records(text, wanted):
    assert records(text) == (wanted, None)


def test_long_delimiters():
    assert records(b'a||"b||c"||5"|d', b"||")[0] == [[b"a", b"b||c", b'5"|d']]


@pytest.mark.parametrize("text", [b'"5,5,6,7\n"8",9', b'"5"6,7', b'"' + b"x" * 200_000])
def test_broken_quotes(text):
    with pytest.raises(Broken):
        records(text)


def random_sheet(r: random.Random, rows: int) -> tuple[bytes, list[list[str]]]:
    cells = ["1.5", "", "a,b", 'say "x"', "line\nbreak", '"', ",\n,\n", "x" * 90, "é漢", '","', "\n\n"]
    table = [[r.choice(cells) for _ in range(r.randint(1, 5))] for _ in range(rows)]
    out = io.StringIO()
    csv.writer(out, lineterminator=r.choice(["\n", "\r\n"]), quoting=r.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL])).writerows(table)
    return out.getvalue().encode(), table


def cut(text: bytes, r: random.Random) -> list[tuple[int, list[bytes]]]:
    """Lines dealt to splits at random places, as a reader of byte ranges does."""
    lines = text.split(b"\n")
    if not lines[-1]:
        lines.pop()
    starts = sorted({0, *(r.randrange(len(lines)) for _ in range(r.randint(0, 8)))})
    ends = [*starts[1:], len(lines)]
    return [(start, lines[start:end]) for start, end in zip(starts, ends, strict=True)]


def read_in_splits(parts, size):
    facts, staged = [], []
    for split, lines in parts:
        scan = SplitScan("f", split, b",")
        staged += [(split, *row) for line in lines for row in scan.feed(line)]
        facts.append((split, scan.end()))
    *folded, verdict = fold_splits(facts, size)
    found = {}
    for row in folded:
        if row["cells"] is not None:
            found[row["offset"]] = row["cells"]
        for split, kind, n, record in staged:
            holds = kind == 0 if not row["inner"] else kind == 1 or (row["meets"] is not None and n >= row["meets"])
            if split == row["split"] and holds:
                index = row["offset"] + n + (row["shift"] if row["inner"] and kind == 0 else 0)
                assert index not in found
                found[index] = record.split(b",") if isinstance(record, bytes) else record
    return [found[i] for i in sorted(found)], sorted(found), verdict


def test_any_splits_give_the_same_records_and_hash():
    r = random.Random(1)
    for _ in range(300):
        text, table = random_sheet(r, r.randint(1, 25))
        verdicts = set()
        for _ in range(4):
            found, places, verdict = read_in_splits(cut(text, r), len(text))
            assert [[c.decode() for c in row] for row in found] == table
            assert places == list(range(len(table))) and verdict["damage"] is None
            verdicts.add(verdict["file_hash"])
        assert len(verdicts) == 1


def test_open_quotes_are_damage_in_any_splits():
    r = random.Random(2)
    text = b"t,1\n" * 20 + b'"5,5,6,7\n' + b"t,2\n" * 20
    for _ in range(50):
        assert read_in_splits(cut(text, r), len(text))[2]["damage"] == BAD_QUOTES
    for _ in range(50):
        assert read_in_splits(cut(text + b'"7",8\n' + text, r), 1)[2]["damage"] == BAD_QUOTES


def test_hashes_combine_in_order():
    lines = [b"a", b"b", b"", b"a"]

    def of(*given):
        found = LineHash()
        for line in given:
            found.add(line)
        return found

    whole = of(*lines)
    for i in range(5):
        assert of(*lines[:i]).followed_by(of(*lines[i:])).value == whole.value
    assert len({of(*given).value for given in ([], [b""], [b"", b""], [b"a", b"b"], [b"b", b"a"], lines)}) == 6


def test_quoted_sheet_of_the_greatest_width(spark, tmp_path, splits):
    header = ",".join(f'"C {i}, ""{i}"""' for i in range(16_384))
    (tmp_path / NAME).write_text(f'title\n{header}\n5",7",8\n"two\nlines",3\n')
    rows = delimited_sheet_rows(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [r.row_idx for r in rows] == [0, 1, 2, 3]
    assert rows[1].cells == [f'C {i}, "{i}"' for i in range(16_384)]
    assert rows[2].cells == ['5"', '7"', "8"] and rows[3].cells == ["two\nlines", "3"]


def test_records_of_large_quoted_files(spark, tmp_path, splits):
    r = random.Random(7)
    wanted = {}
    for letter in "ABCD":
        text, table = random_sheet(r, 400)
        (tmp_path / f"T {letter} Eb readings.csv").write_bytes(text)
        wanted[f"T {letter} Eb readings.csv"] = table
    found = delimited_files(spark, str(tmp_path))
    assert values(found.files, "damage") == [(None,)] * 4
    rows = sorted(map(tuple, found.rows().collect()))
    assert rows == sorted((name, i, cells) for name, table in wanted.items() for i, cells in enumerate(table))
    plan = found.rows()._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "content" not in plan


def test_hash_of_a_file_does_not_depend_on_its_splits(spark, tmp_path):
    text = bytes(random.Random(3).randrange(256) for _ in range(20_000))
    (tmp_path / "T A Eb readings.xls").write_bytes(text)
    (tmp_path / "T B Eb readings.xls").write_bytes(text)
    (tmp_path / "T C Eb readings.xls").write_bytes(text + b"\n")
    (tmp_path / "T D Eb readings.xls").write_bytes(text[:-1] + bytes([text[-1] ^ 1]))

    def found():
        return {r.source_file: r.file_hash for r in file_hashes(spark, str(tmp_path)).collect()}

    whole = found()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        assert found() == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(set(whole.values())) == 3 and whole["T A Eb readings.xls"] == whole["T B Eb readings.xls"]


def test_damaged_sheets_are_left_out_as_a_whole(tables, tmp_path):
    good = 'x\n,"C G001",102\nx\n12-01-2025 00:00,"1.5",7\n'
    (tmp_path / NAME).write_text(good)
    (tmp_path / "T C Gas readings.csv").write_text(good + '12-01-2025 00:15,"5,5,6,7\n12-01-2025 00:30,6,7\n')
    (tmp_path / "T D Gas readings.csv").write_text(good + '12-01-2025 00:15,"5"5,6\n')
    outcome = jobs.ingest_directory(tables, str(tmp_path))
    assert values(outcome, "source_file", "outcome", "inserted") == [
        (NAME, "ingested", 2), ("T C Gas readings.csv", BAD_QUOTES, 0), ("T D Gas readings.csv", BAD_QUOTES, 0)
    ]
    left_out = jobs.write_daily_records(tables.spark, str(tmp_path), f"{tmp_path}/out")
    assert values(left_out, "source_file", "reject_reason") == [
        ("T C Gas readings.csv", BAD_QUOTES), ("T D Gas readings.csv", BAD_QUOTES)
    ]
    assert tables.spark.read.csv(f"{tmp_path}/out", header=True).count() == 2
