"""Quality rules as a short-circuit cascade.

Each rule is a test on one text. Its cost and its selectivity are measured on a bounded
sample; the cascade asks the rules in the order of rejections per cost and stops at the first
rejection. The order only decides how much work is done: a text is kept if no rule rejects it.

Cases: a null or empty text has no words and fails the base rule; each row, also a repeated
one, gets its own result; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.words import SPACES, WINDOW_BASES, Texts, Words, map_slices, windows

SYMBOLS = b"#*$%&|<>"
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_UPPER = bytes(range(65, 91))
_STOPS = b".!?"


def _share(text: bytes, of: bytes, total: int) -> float:
    return (len(text) - len(text.translate(None, of))) / max(total, 1)


def _symbols(text: bytes) -> bool:
    """More than a third as many symbols as words."""
    return _share(text, SYMBOLS, len(text.split())) > 1 / 3


def _capitals(text: bytes) -> bool:
    """More than six in ten letters are capitals."""
    return _share(text, _UPPER, len(text) - len(text.translate(None, _LETTERS))) > 0.6


def _letters(text: bytes) -> bool:
    """Fewer than three in ten visible bytes are letters."""
    visible = text.translate(None, SPACES)
    return _share(visible, _LETTERS, len(visible)) < 0.3


def _shouting(text: bytes) -> bool:
    """More than one exclamation mark for two words."""
    return _share(text, b"!", len(text.split())) > 0.5


def _word_length(text: bytes) -> bool:
    """Words of less than two or more than twenty bytes on average."""
    words = text.split()
    mean = sum(map(len, words)) / max(len(words), 1)
    return not 2 <= mean <= 20


def _repeated_lines(text: bytes) -> bool:
    """More than half of the lines with a word equal an earlier one."""
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines)) > 0.5 * len(lines)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[bytes], bool]


RULES = (
    Rule("symbols", _symbols), Rule("capitals", _capitals), Rule("letters", _letters),
    Rule("shouting", _shouting), Rule("word_length", _word_length),
    Rule("repeated_lines", _repeated_lines),
)


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """Word, symbol, repeated-line and repeated-window counts of each text."""
    texts = Texts(column)
    words = Words(texts)
    n = len(column)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[texts.bounds[1:]] - sums[texts.bounds[:-1]]

    first_bytes = (words.data & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    repeated = np.zeros(n, np.int64)
    h = words.hashes()
    grams = windows(h, 3, WINDOW_BASES[0])
    owner = words.text_of_words()
    if len(grams):
        at = np.flatnonzero(owner[: len(grams)] == owner[2:])
        order = at[np.lexsort((grams[at], owner[at]))]
        same = (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        covered = np.zeros(len(words) + 3, bool)
        for shift in range(3):
            covered[order[twice] + shift] = True
        repeated = np.bincount(owner, covered[: len(words)], n).astype(np.int64)
    lines = np.zeros(n, np.int64)
    for i in np.flatnonzero(per_text(words.data == 10) > 0):
        worded = [line for line in texts.raw(i).split(b"\n") if line.split()]
        lines[i] = len(worded) - len(set(worded))
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_text(words.inside & first_bytes).astype(np.int64),
        "n_symbols": per_text(symbol[words.data]).astype(np.int64),
        "n_dup_lines": lines,
        "n_repeat_words": repeated,
    }


def measure_rules(
    documents: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 2000,
    doc_id: str = "doc_id",
) -> list[tuple[Rule, float, float]]:
    """Each rule with its cost (seconds a text) and share of rejected texts, on about
    `sample_rows` rows drawn by hash of id and text; a rule without figures costs 1 and rejects nothing."""
    total = documents.count()
    share = min(1.0, sample_rows / max(total, 1))
    key = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(1 << 32))
    sample = documents.select(text).filter(key < F.lit(int(share * (1 << 32))))

    def run(batches):
        cost, hits, rows = np.zeros(len(rules)), np.zeros(len(rules)), 0
        for batch in batches:
            texts = [x or b"" for x in batch.column(0).cast(pa.binary()).to_pylist()]
            rows += len(texts)
            for k, rule in enumerate(rules):
                began = time.thread_time()
                hits[k] += sum(map(rule.rejects, texts))
                cost[k] += time.thread_time() - began
        yield pa.RecordBatch.from_pydict({
            "rule": list(range(len(rules))), "cost": cost, "hits": hits, "rows": [float(rows)] * len(rules),
        })

    sums = (
        sample.mapInArrow(run, "rule long, cost double, hits double, rows double")
        .groupBy("rule").agg(F.sum("cost").alias("cost"), F.sum("hits").alias("hits"), F.sum("rows").alias("rows"))
        .collect()
    )
    found = {r.rule: (r.cost / r.rows, r.hits / r.rows) for r in sums if r.rows}
    return [(rule, *found.get(k, (1.0, 0.0))) for k, rule in enumerate(rules)]


def cascade(measured: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejections per cost, ties in the given order."""
    return [m[0] for m in sorted(measured, key=lambda m: -m[2] / max(m[1], 1e-9))]


def apply_rules(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000,
) -> DataFrame:
    """Base counts, base verdict, the rule that rejected first (null if none was asked or
    none rejected) and the verdict of every document."""
    ordered = cascade(measure_rules(documents, rules, text, sample_rows))
    id_type = dict(documents.select(doc_id).dtypes)[doc_id]
    schema = (
        f"doc_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, rejected_by string, kept boolean"
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = base_counts(batch.column(1))
        texts = Texts(batch.column(1))
        failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
        rejected: list[str | None] = [None] * batch.num_rows
        for i in np.flatnonzero(~failed):
            whole = texts.raw(i)
            rejected[i] = next((rule.name for rule in ordered if rule.rejects(whole)), None)
        kept = ~failed & np.array([r is None for r in rejected], bool)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(v) for v in counts.values()), pa.array(failed),
             pa.array(rejected, pa.string()), pa.array(kept)],
            ["doc_id", *counts, "base_failed", "rejected_by", "kept"],
        )

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_slices(rows, "text", work, schema)
