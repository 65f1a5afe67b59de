"""Secrets in texts, found through a trigram index.

Every rule is a regular expression on ASCII bytes. From its parse tree follows a Boolean query
on trigrams that every match must contain: literals in a row give a conjunction, alternatives
a disjunction. A task takes its texts in slices and builds an inverted index of each slice: all
trigrams of the lower-cased bytes with the texts that hold them. The rule's query intersects and
unites postings, and the rule itself is run on the texts that are left. A rule without a
mandatory trigram is run on every text. Nothing is shuffled; memory follows the slice or one text.

Cases: a null or empty text has no spans; texts are read whole, a very long one is a slice of its
own; repeated rows, tied spans and null or repeated ids each keep their row and spans (ordered by
start, then by the order of the rules); an empty table gives an empty result; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import product
from re import _constants as node
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.words import LOWER, Texts, map_slices

MOST_STRINGS = 64  # alternatives that are spelled out before a run of literals is cut
MOST_CHOICES = 16  # characters of a class that count as alternatives
CHUNK = 1 << 20  # bytes whose trigrams are sorted at a time

#: A trigram query: None asks for nothing, a string is a trigram, else ("and" or "or", parts).
Query = None | str | tuple[str, tuple]


@dataclass(frozen=True)
class Rule:
    """Matches of the pattern, leftmost and not overlapping, whose group has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern[bytes]:
        return re.compile(self.pattern.encode(), re.IGNORECASE if self.any_case else 0)


# Three patterns of the contract, and public formats of credentials. Runs of one
# class are written with their least length where that leaves the same matches.
BASE_RULES = (
    Rule("assign",
         r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"://[A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%!+-]+@"),
)
RULES = BASE_RULES + MORE_RULES


def _all_of(parts: Iterable[Query]) -> Query:
    kept = tuple(dict.fromkeys(p for p in parts if p is not None))
    return None if not kept else kept[0] if len(kept) == 1 else ("and", kept)


def _any_of(parts: Iterable[Query]) -> Query:
    kept = tuple(dict.fromkeys(parts))
    return None if not kept or None in kept else kept[0] if len(kept) == 1 else ("or", kept)


def _query_of(strings: frozenset[str]) -> Query:
    """What a text must hold if it holds one of the strings."""
    return _any_of(_all_of(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _class_members(items: list) -> frozenset[str] | None:
    """Lower-cased characters of a class, if they are few."""
    found: set[str] = set()
    for op, value in items:
        if op is node.LITERAL:
            found.add(chr(value).lower())
        elif op is node.RANGE and value[1] - value[0] < 4 * MOST_CHOICES:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= MOST_CHOICES else None


def _part(op, value) -> tuple[frozenset[str] | None, Query]:
    """The strings that a node stands for, if they are few, else None and its query."""
    if op is node.LITERAL:
        return frozenset({chr(value).lower()}), None
    if op is node.IN:
        return _class_members(value), None
    if op is node.SUBPATTERN:
        return _sequence(value[-1])
    if op is node.AT:
        return frozenset({""}), None
    if op is node.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in parts):
            joined = frozenset().union(*(strings for strings, _ in parts))
            if len(joined) <= MOST_STRINGS:
                return joined, None
        return None, _any_of(query if strings is None else _query_of(strings) for strings, query in parts)
    if op in (node.MAX_REPEAT, node.MIN_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if strings is not None and most <= 4 and len(strings) ** most <= MOST_STRINGS:
            repeated = (map("".join, product(sorted(strings), repeat=n)) for n in range(least, most + 1))
            return frozenset(s for group in repeated for s in group), None
        if least == 0:
            return None, None
        return None, query if strings is None else _query_of(strings)
    return None, None  # any other node asks for nothing


def _sequence(nodes) -> tuple[frozenset[str] | None, Query]:
    """Nodes one after another: literals are joined for as long as the strings stay few."""
    whole, run, queries = True, frozenset({""}), []
    for op, value in nodes:
        strings, query = _part(op, value)
        if strings is not None and len(strings) * len(run) <= MOST_STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            continue
        whole = False
        queries += [_query_of(run), query]
        run = frozenset({""}) if strings is None else strings
    if whole:
        return run, None
    return None, _all_of([*queries, _query_of(run)])


def trigram_query(rule: Rule) -> Query:
    """Boolean query on lower-case trigrams that every match of the rule answers."""
    strings, query = _sequence(parser.parse(rule.pattern))
    return query if strings is None else _query_of(strings)


class TrigramIndex:
    """Postings of all trigrams of some texts: sorted codes, and the texts of each in order."""

    def __init__(self, texts: Texts):
        self.n = len(texts.bounds) - 1
        bits = max(self.n - 1, 1).bit_length()
        chunks = [self._chunk(texts, start, bits) for start in range(0, len(texts.data) - 2, CHUNK)]
        postings = np.unique(np.concatenate([np.zeros(0, np.int64), *chunks]))
        self.codes, self.rows = postings >> bits, postings & ((1 << bits) - 1)

    def _chunk(self, texts: Texts, start: int, bits: int) -> np.ndarray:
        """(trigram, text) as one number each, of the trigrams that begin in a chunk."""
        stop = min(start + CHUNK + 2, len(texts.data))
        data = LOWER[texts.data[start:stop]].astype(np.int64)
        owner = np.repeat(np.arange(self.n), np.diff(np.clip(texts.bounds, start, stop)))
        codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        return np.unique(((codes << bits) | owner[:-2])[owner[:-2] == owner[2:]])

    def rows_with(self, trigram: str) -> np.ndarray:
        a, b, c = trigram.encode("latin-1")
        code = (a << 16) | (b << 8) | c
        first, last = np.searchsorted(self.codes, [code, code + 1])
        return self.rows[first:last]

    def answer(self, query: Query) -> np.ndarray:
        """Texts that may hold a match, in order."""
        if query is None:
            return np.arange(self.n)
        if isinstance(query, str):
            return self.rows_with(query)
        found = None
        for part in query[1]:
            rows = self.answer(part)
            if found is None:
                found = rows
            elif query[0] == "or":
                found = np.union1d(found, rows)
            elif len(found):
                found = np.intersect1d(found, rows, assume_unique=True)
        return found


def _places(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets of (start, rule, end) as code points."""
    if text.isascii():
        return spans
    leads = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    points = np.unique([0, *(p for a, _, b in spans for p in (a, b))])
    counts = np.add.reduceat(leads, points[points < len(text)], dtype=np.int64)
    before = dict(zip(points.tolist(), [0, *np.cumsum(counts).tolist()], strict=False))
    return [(before[a], k, before[b]) for a, k, b in spans]


def _scanner(rules: tuple[Rule, ...]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    queries = [trigram_query(rule) for rule in rules]
    kinds = [rule.kind for rule in rules]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(batch.column(1))
        index = TrigramIndex(texts)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
            pattern = rule.compiled()
            for i in index.answer(query).tolist():
                spans = [(m.start(), k, m.end()) for m in pattern.finditer(texts.raw(i))
                         if m.end(rule.group) - m.start(rule.group) >= rule.least]
                if spans:
                    found.setdefault(i, []).extend(spans)
        rows = [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in sorted(_places(texts.raw(i), found[i]))]
                if i in found else [] for i in range(index.n)]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"])

    return work


def scan(
    documents: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, end exclusive) of every document."""
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, spans array<struct<kind:string, start:long, end:long>>"
    return map_slices(rows, "text", _scanner(rules), schema)
