"""Language identification by word-first backoff.

A word that the model knows scores by its log frequency in each language. Another word falls
back to its longest known character n-grams: five letters, then four, down to one, with the
mean of their log frequencies. The sums over a text, taken as log-likelihoods, give the
language and its probability.

Cases: a null text or one without letters is `und` with score 0; letters of which nothing is
known give the first language with score 1/n; without labelled rows everything is `und` (and the filter keeps all texts with a letter); ties
go to the first language in text order; every row gets its own result; an empty table gives an
empty one; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.words import map_slices

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
ORDERS = (5, 4, 3, 2, 1)
FEW_ROWS = 50


@dataclass(frozen=True)
class LanguageModel:
    """Rows of log frequencies, one column per language, and the row of each word and n-gram."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    rows: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        found = WORD.findall(text.lower()) if text else []
        if not found or not self.languages:
            return UNKNOWN, 0.0
        at, weights = [], []
        word_row, gram_row = self.words.get, self.grams.get
        for word, n in Counter(found).items():
            row = word_row(word)
            if row is not None:
                at.append(row)
                weights.append(n)
                continue
            padded = f" {word} "
            for size in ORDERS:
                known = [r for i in range(len(padded) - size + 1)
                         if (r := gram_row(padded[i : i + size])) is not None]
                if known:
                    at += known
                    weights += [n / len(known)] * len(known)
                    break
        if not at:
            return self.languages[0], 1.0 / len(self.languages)
        sums = np.array(weights) @ self.rows[at]
        best = int(np.argmax(sums))
        return self.languages[best], float(1.0 / np.exp(sums - sums[best]).sum())


def _log_frequencies(counts: dict[str, np.ndarray], width: int) -> np.ndarray:
    table = np.array(list(counts.values())).reshape(-1, width)
    table = (table + 0.5) / (table.sum(0) + 0.5 * max(len(table), 1))
    return np.log(table)


def train(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_rows: int = 6000, words_per_model: int = 60_000, most_numbers: int = 4_000_000,
) -> LanguageModel:
    """Fit on about `sample_rows` labelled rows, drawn by hash and evenly over the languages.

    Every label is learned, from one row at least. The model is bounded: the most frequent words
    of each language, `words_per_model` in all, or as many as give `most_numbers` frequencies over
    all languages if that is less (but one word each), and the n-grams of these words. A
    classifier's bounded sample; scoring covers all rows.
    """
    labelled = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    totals = labelled.groupBy(F.col(lang).alias("lang")).count().collect()
    languages = sorted(r["lang"] for r in totals)
    if not languages:
        return LanguageModel([], {}, {}, np.zeros((0, 0)))
    share = {r["lang"]: min(1.0, sample_rows / len(totals) / r["count"]) for r in totals}
    wanted = F.create_map(*(x for k, v in share.items() for x in (F.lit(k), F.lit(int(v * (1 << 32))))))
    place = F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit("language")), F.lit(1 << 32))
    drawn = labelled.filter(place < wanted[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sample = drawn
    if len(totals) * FEW_ROWS > sample_rows:  # a label may lose all its rows to the draw: the first stands for it
        first = labelled.groupBy(F.col(lang).alias("lang")).agg(F.min_by(text, place).alias("text"))
        sample = drawn.unionByName(first)

    def count(batches):
        for batch in batches:
            sums: dict[str, Counter] = {}
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums.setdefault(name, Counter()).update(WORD.findall(body.lower()))
            for name, words in sums.items():
                yield pa.RecordBatch.from_pydict(
                    {"lang": [name] * len(words), "word": list(words), "n": list(words.values())})

    counted = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (
        counted.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= max(1, min(words_per_model, most_numbers // len(languages)) // len(languages)))
        .select("lang", "word", "n").collect()
    )
    column = {name: i for i, name in enumerate(languages)}
    words: dict[str, np.ndarray] = {}
    grams: dict[int, dict[str, np.ndarray]] = {size: {} for size in ORDERS}
    for row in sorted(top, key=lambda r: (r.lang, r.word)):
        words.setdefault(row.word, np.zeros(len(languages)))[column[row.lang]] += row.n
        padded = f" {row.word} "
        for size in ORDERS:
            for i in range(size == 1, len(padded) - size + (size > 1)):  # no blank on its own
                grams[size].setdefault(padded[i : i + size], np.zeros(len(languages)))[column[row.lang]] += row.n
    tables = [_log_frequencies(words, len(languages))]
    places, base = {}, len(words)
    for size in ORDERS:
        tables.append(_log_frequencies(grams[size], len(languages)))
        places |= {gram: base + i for i, gram in enumerate(grams[size])}
        base += len(grams[size])
    rows = np.concatenate(tables)
    rows -= rows.mean(1, keepdims=True)
    return LanguageModel(languages, {w: i for i, w in enumerate(words)}, places, rows.astype(np.float32))


def identify(documents: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Language and score of every text; other columns of the documents are kept in front."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            pairs = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p[0] for p in pairs], pa.string()),
                 pa.array([p[1] for p in pairs], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def keep_identified(
    documents: DataFrame, model: LanguageModel, least_score: float, text: str = "text"
) -> DataFrame:
    """The rows, with all their columns, whose language is clear; without any learned language,
    those that have a letter."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def clear(body: str | None) -> bool:
        if not shared.value.languages:
            return bool(body) and WORD.search(body) is not None
        language, score = shared.value.predict(body)
        return language != UNKNOWN and score >= least_score

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array([clear(t) for t in part.column(text).to_pylist()], pa.bool_()))

    return map_slices(documents, text, work, documents.schema)
