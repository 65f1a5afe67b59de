"""Log-bilinear language model, trained by noise-contrastive estimation.

The model has two levels. The upper one predicts one of the most frequent words or a class of
all others, by their ending: the score after two words is bilinear, with word vectors, a context
vector per place and a bias. Tasks train on all their training text with shared noise words and
their parameters are averaged. The lower one predicts the word within its class: every word of the
training text has a vector there, so that the vocabulary grows with the text. Its score is the
product with the features of the word before, on top of the word's count plus one; noise words
come from the same class of the same slice, so that what is learned is the ratio to the count.
Features are the main directions of the context vectors of the upper level. All training text is
read three times: for the counts, for the upper level and for the vectors, which are merged by word.

The upper normaliser of a pair of context words is a sum of products of two exponentials, so one
matrix product gives it for all pairs. The lower one is summed over all words for every class and
word before, by matrix products over blocks of the stored words, with one further share for all
unseen words. Each token's log-probability is exactly normalised.

Words are keyed by 128-bit hashes. Counts and vectors of frequent words reach the tasks as a table
of at most `known_words` entries; the others are joined.

Cases: a null text is the end token alone; without training rows all counts are zero; every
row gets a score, also repeated ones; an empty table gives an empty one; further columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.words import U, Texts, Words, slices, text_key
from gaugeflow.sources.workspace import stored

END_KEYS = (U(0x5851F42D4C957F2D), U(0x14057B7EF767814F))
CLASSES = 64
DIMENSIONS = 24
NOISE = 48
STEP_TOKENS = 4096
#: Step of the upper level; of 0.15, 0.3, 0.6 and 1 chosen below the best on the held-out texts of sf0.1.
RATE = 0.6
#: Little text is read more often for the upper level, until so many tokens are seen.
SEEN_TOKENS = 1 << 21
MOST_ROUNDS = 8
#: Features of a context in the lower level, the last one constant, and noise words per token.
FEATURES = 8
LOWER_NOISE = 3
#: Weight of the zero vector against what is learned from the words.
PRIOR = 30.0
#: No vector moves a score by more.
WIDEST_SCORE = 10.0
#: Words that a task keeps before it hands them on.
HELD_WORDS = 1 << 19
BLOCK_WORDS = 2048


class Tokens:
    """Tokens of a slice of texts: word keys with an end token after each text."""

    def __init__(self, column: pa.Array):
        words = Words(Texts(column), lower=True)
        n = len(words.counts)
        at = words.offsets[1:]
        self.k1 = np.insert(words.hashes(0), at, END_KEYS[0])
        self.k2 = np.insert(words.hashes(1), at, END_KEYS[1])
        # the ending: the last byte of the word, and for a longer one the byte before it too
        last = words.data[words.ends - 1].astype(np.int64) if len(words) else np.zeros(0, np.int64)
        before = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0) if len(words) else last
        self.ending = np.insert((last * 31 + before) % CLASSES, at, 0)
        self.counts = words.counts + 1
        self.bounds = np.concatenate([[0], np.cumsum(self.counts)])
        self.text = np.repeat(np.arange(n), self.counts)


VECTOR = [f"v{i}" for i in range(FEATURES)]


class Lower:
    """Counts and vectors of the words that a task has met, learned slice by slice.

    A word's vector is that of a logistic regression of its places against noise places, on fixed
    features; each slice is one step by curvature, so that words met seldom move little. Within a
    task words are told apart by half of their key.
    """

    def __init__(self, features: np.ndarray | None, seed: int = 5):
        self.features, self.draw = features, np.random.default_rng(seed)
        self.clear()

    def clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.k2, self.ending = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.c, self.curve = np.zeros(0, np.int64), np.zeros(0, np.float32)
        self.vectors = np.zeros((0, FEATURES), np.float32)

    def _slots(self, k1: np.ndarray, k2: np.ndarray, ending: np.ndarray) -> np.ndarray:
        """Slots of distinct sorted words; new ones get the next."""
        place = np.searchsorted(self.keys, k1)
        held = np.zeros(len(k1), bool)
        inside = place < len(self.keys)
        held[inside] = self.keys[place[inside]] == k1[inside]
        new = np.flatnonzero(~held)
        count = len(self.c)
        self.slot = np.insert(self.slot, place[new], np.arange(count, count + len(new)))
        self.keys = np.insert(self.keys, place[new], k1[new])
        self.k2, self.ending = np.append(self.k2, k2[new]), np.append(self.ending, ending[new].astype(np.int32))
        self.c, self.curve = np.append(self.c, np.zeros(len(new), np.int64)), np.append(self.curve, np.zeros(len(new), np.float32))
        self.vectors = np.concatenate([self.vectors, np.zeros((len(new), FEATURES), np.float32)])
        return self.slot[np.searchsorted(self.keys, k1)]

    def learn(self, t: Tokens, number: np.ndarray, near: np.ndarray) -> None:
        """Count all tokens; `number` and `near` are those of the upper level, whose frequent
        words are not learned."""
        distinct, first, word = np.unique(t.k1, return_index=True, return_inverse=True)
        slot = self._slots(distinct, t.k2[first], t.ending[first])
        self.c[slot] += np.bincount(word, minlength=len(distinct))
        if self.features is None:
            return
        inner = np.flatnonzero(number < CLASSES)
        inner = inner[np.argsort(number[inner].astype(np.int16), kind="stable")]
        of, sizes = number[inner], np.bincount(number[inner], minlength=CLASSES)
        begin, word = (np.cumsum(sizes) - sizes)[of], word[inner]
        context = self.features[near[inner]]
        columns = [context[:, i].astype(np.float64) for i in range(FEATURES)]
        square = np.einsum("nf,nf->n", context, context) / FEATURES
        vectors, n = self.vectors[slot], len(distinct)
        slope, curve = np.zeros((n, FEATURES)), np.zeros(n)
        for k in range(LOWER_NOISE + 1):
            who = word if not k else word[begin + (self.draw.random(len(inner), np.float32) * sizes[of]).astype(np.int64) % sizes[of]]
            likely = 1 / (1 + LOWER_NOISE * np.exp(-np.einsum("nf,nf->n", vectors[who], context)))
            curve += np.bincount(who, likely * (1 - likely) * square, n)
            pull = likely - 1 if not k else likely
            for i, column in enumerate(columns):
                slope[:, i] += np.bincount(who, pull * column, n)
        self.curve[slot] += curve.astype(np.float32)
        self.vectors[slot] = bounded(vectors - (slope / (PRIOR + self.curve[slot])[:, None]).astype(np.float32), self.features)

    def rows(self) -> pa.RecordBatch:
        """The words held, in the order of their keys; vectors weighed by their curvature."""
        s, at = self.slot, self.keys.view(np.int64)
        weighed = self.vectors[s] * (PRIOR + self.curve[s])[:, None]
        return pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(self.k2[s].view(np.int64)), pa.array(self.ending[s]), pa.array(self.c[s]),
             pa.array(self.curve[s]), *(pa.array(weighed[:, i]) for i in range(FEATURES))],
            ["k1", "k2", "ending", "c", "curve", *VECTOR])


def bounded(vectors: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Vectors cut to the widest score that any features can give."""
    reach = np.abs(vectors) @ np.abs(features).max(0)
    return vectors * np.minimum(1, WIDEST_SCORE / np.maximum(reach, 1e-9))[:, None].astype(np.float32)


def count_words(training: DataFrame, first=None, text: str = "text") -> DataFrame:
    """k1, k2, ending, c and v0 ..: every token of the training texts with its count and vector.

    `first` is a broadcast (table, features) of the upper level; without it vectors are zero.
    """
    columns = "k1 long, k2 long, ending int, c long"
    if first:
        columns += ", curve float, " + ", ".join(f"{v} float" for v in VECTOR)
    names = [column.split()[0] for column in columns.split(", ")]

    def run(batches):
        table, features = first.value if first else (None, None)
        lower = Lower(features)
        for batch in batches:
            for part in slices(batch, "text"):
                t = Tokens(part.column(0))
                if table is None:
                    lower.learn(t, t.ending, t.ending)
                else:
                    _, number = table.find(t)
                    lower.learn(t, number, contexts(number, t.bounds, end_number(table))[0])
                if len(lower.keys) >= HELD_WORDS:
                    yield lower.rows().select(names)
                    lower.clear()
        if len(lower.keys):
            yield lower.rows().select(names)

    counted = training.select(F.col(text).cast("string").alias("text")).mapInArrow(run, columns)
    by_word, sums = counted.groupBy("k1", "k2"), (F.first("ending").alias("ending"), F.sum("c").alias("c"))
    if not first:
        return by_word.agg(*sums).withColumns({v: F.lit(0.0).cast("float") for v in VECTOR})
    scale = F.sum("curve") + PRIOR
    return by_word.agg(*sums, *((F.sum(v) / scale).cast("float").alias(v) for v in VECTOR))


@dataclass(frozen=True)
class Table:
    """Frequent words, sorted by key, with counts and model numbers, and the class totals.

    Model numbers: classes 0 .. CLASSES-1, then the vocabulary in order of frequency.
    """

    k1: np.ndarray
    k2: np.ndarray
    c: np.ndarray
    number: np.ndarray
    total: int  # N
    distinct: int  # V
    class_tokens: np.ndarray
    size: int
    vectors: np.ndarray

    def frequent(self) -> Table:
        """The words of the upper level alone."""
        own = self.number >= CLASSES
        return replace(self, k1=self.k1[own], k2=self.k2[own], c=self.c[own], number=self.number[own],
                       vectors=self.vectors[own])

    def find(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token in the table (-1: not there) and its model number."""
        return self.find_keys(t.k1, t.k2, t.ending)

    def find_keys(self, k1: np.ndarray, k2: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.k1, k1), max(len(self.k1) - 1, 0))
        if not len(self.k1):
            return np.full(len(k1), -1), ending
        same = (self.k1[place] == k1) & (self.k2[place] == k2)
        return np.where(same, place, -1), np.where(same, self.number[place], ending)


def build_table(counts: DataFrame, vocabulary: int, known_words: int) -> Table:
    """Frequent words: all from a count upwards, chosen by a histogram of logarithmic steps so
    that they number `known_words` at most; no sort of the counts and no single task."""
    step = F.floor(F.log2("c") * 16).cast("int")
    least, n = 1 << 30, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        n += row["count"]
        if n > known_words:
            break
        least = row["step"]
    has_vectors = VECTOR[0] in counts.columns
    top = counts.filter(step >= least).select("k1", "k2", "ending", "c", *(VECTOR if has_vectors else [])).toArrow().sort_by(
        [("c", "descending"), ("k1", "ascending"), ("k2", "ascending")])
    sums = counts.groupBy("ending").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    k1, k2, ending, c = (top.column(i).to_numpy().copy() for i in range(4))
    vectors = np.zeros((len(c), FEATURES), np.float32)
    if has_vectors:
        vectors = np.stack([top.column(v).to_numpy() for v in VECTOR], 1)
    class_tokens = np.zeros(CLASSES, np.int64)
    for row in sums:
        class_tokens[row.ending] = row.n
    total, distinct = int(class_tokens.sum()), sum(row.v for row in sums)
    own = np.arange(len(c)) < vocabulary
    number = np.where(own, CLASSES + np.arange(len(c)), ending)
    np.subtract.at(class_tokens, ending[own], c[own])
    k1, k2 = k1.view(np.uint64), k2.view(np.uint64)
    order = np.argsort(k1, kind="stable")
    return Table(k1[order], k2[order], c[order], number[order], total, distinct, class_tokens,
                 CLASSES + min(vocabulary, len(c)), vectors[order])


@dataclass(frozen=True)
class Weights:
    """Word vectors, one vector set per context place, and biases."""

    target: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray


def start_weights(table: Table) -> tuple[Weights, np.ndarray]:
    """First weights and the noise distribution (the unigram of model numbers)."""
    unigram = np.ones(table.size)
    unigram[:CLASSES] += table.class_tokens
    frequent = table.number >= CLASSES
    unigram[table.number[frequent]] += table.c[frequent]
    unigram /= unigram.sum()
    draw = np.random.default_rng(7)
    vectors = [draw.normal(0, 0.1, (table.size, DIMENSIONS)).astype(np.float32) for _ in range(3)]
    return Weights(*vectors, np.log(unigram).astype(np.float32)), unigram


def context_features(weights: Weights, unigram: np.ndarray) -> np.ndarray:
    """Main directions of the vectors of the word before, of unit variance, and a constant."""
    centred = weights.near - unigram @ weights.near
    _, _, directions = np.linalg.svd(centred * np.sqrt(unigram)[:, None], full_matrices=False)
    along = centred @ directions[: FEATURES - 1].T
    along /= np.sqrt(unigram @ along**2) + 1e-9
    return np.concatenate([np.clip(along, -3, 3), np.ones((len(along), 1))], 1).astype(np.float32)


def contexts(number: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token and the one before that; the end token fills the front."""
    near, far = np.empty_like(number), np.empty_like(number)
    near[1:], far[2:] = number[:-1], number[:-2]
    first = bounds[:-1]
    near[first], far[first] = end, end
    second = first[np.diff(bounds) > 1] + 1
    far[second] = end
    return near, far


def _sum_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows.astype(np.int16) if rows.max() < 1 << 15 else rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[first], np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Mini-batches of noise-contrastive estimation with noise words shared by a batch."""

    def __init__(self, weights: Weights, unigram: np.ndarray, rate: float, seed: int):
        self.w = Weights(*(x.copy() for x in (weights.target, weights.near, weights.far, weights.bias)))
        self.slope = [np.full(len(unigram), 1e-2, np.float32) for _ in range(4)]
        self.cumulated, self.log_noise = np.cumsum(unigram), np.log(unigram * NOISE).astype(np.float32)
        self.rate, self.draw, self.tokens = rate, np.random.default_rng(seed), 0

    def _move(self, k: int, into: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        """Adaptive step: a row moves less the more it has moved."""
        distinct, own = _sum_rows(rows, gradient)
        self.slope[k][distinct] += (own**2).mean(1) if own.ndim > 1 else own**2
        scale = self.rate / np.sqrt(self.slope[k][distinct])
        into[distinct] -= own * (scale[:, None] if own.ndim > 1 else scale)

    def step(self, word: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        w = self.w
        noise = np.minimum(np.searchsorted(self.cumulated, self.draw.random(NOISE)), len(self.cumulated) - 1)
        context = w.near[near] + w.far[far]
        own = np.einsum("bd,bd->b", context, w.target[word]) + w.bias[word] - self.log_noise[word]
        other = context @ w.target[noise].T + w.bias[noise] - self.log_noise[noise]
        pull = (1 / (1 + np.exp(-own)) - 1).astype(np.float32) / len(word)
        push = (1 / (1 + np.exp(-other))).astype(np.float32) / len(word)
        d_context = pull[:, None] * w.target[word] + push @ w.target[noise]
        rows = np.concatenate([word, noise])
        self._move(0, w.target, rows, np.concatenate([pull[:, None] * context, push.T @ context]))
        self._move(3, w.bias, rows, np.concatenate([pull, push.sum(0)]))
        self._move(1, w.near, near, d_context)
        self._move(2, w.far, far, d_context)
        self.tokens += len(word)


def train_round(
    training: DataFrame, table, weights: Weights, unigram: np.ndarray, rate: float, text: str = "text"
) -> Weights:
    """Each task trains on all its text; rows of parameters are averaged by tokens seen."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast((weights, unigram))

    def run(batches):
        begun, noise = shared.value
        trainer = Trainer(begun, noise, rate, 11)
        words = table.value.frequent()
        end = end_number(words)
        for batch in batches:
            for part in slices(batch, "text"):
                t = Tokens(part.column(0))
                _, number = words.find(t)
                near, far = contexts(number, t.bounds, end)
                order = trainer.draw.permutation(len(number))
                for at in range(0, len(order), STEP_TOKENS):
                    pick = order[at : at + STEP_TOKENS]
                    trainer.step(number[pick], near[pick], far[pick])
        if trainer.tokens:
            w = trainer.w
            rows = np.concatenate([np.concatenate([w.target, w.near, w.far]),
                                   np.pad(w.bias[:, None], ((0, 0), (0, DIMENSIONS - 1)))])
            moved = np.concatenate([np.concatenate([begun.target, begun.near, begun.far]),
                                    np.pad(begun.bias[:, None], ((0, 0), (0, DIMENSIONS - 1)))])
            changed = np.flatnonzero((rows != moved).any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(changed), pa.array(np.full(len(changed), float(trainer.tokens))),
                 *(pa.array(((rows - moved)[changed, i]).astype(np.float64)) for i in range(DIMENSIONS))],
                ["row", "weight", *(f"d{i}" for i in range(DIMENSIONS))])

    schema = "row long, weight double, " + ", ".join(f"d{i} double" for i in range(DIMENSIONS))
    sums = (
        training.select(F.col(text).cast("string").alias("text")).mapInArrow(run, schema).groupBy("row")
        .agg(F.sum("weight").alias("weight"),
             *(F.sum(F.col(f"d{i}") * F.col("weight")).alias(f"d{i}") for i in range(DIMENSIONS)))
        .toArrow()
    )
    rows = sums.column("row").to_numpy()
    total = sums.column("weight").to_numpy()
    move = np.zeros((4 * len(unigram), DIMENSIONS), np.float32)
    for i in range(DIMENSIONS):
        move[rows, i] = sums.column(f"d{i}").to_numpy() / total
    target, near, far, bias = np.split(move, 4)
    return Weights(weights.target + target, weights.near + near, weights.far + far, weights.bias + bias[:, 0])


def end_number(table: Table) -> int:
    place = np.flatnonzero((table.k1 == END_KEYS[0]) & (table.k2 == END_KEYS[1]))
    return int(table.number[place[0]]) if len(place) else 0


@dataclass(frozen=True)
class Scorer:
    """Bilinear scores of word pairs and the log-normaliser of every context pair."""

    near: np.ndarray
    far: np.ndarray
    log_norm: np.ndarray

    @classmethod
    def of(cls, w: Weights) -> Scorer:
        near = w.near @ w.target.T + w.bias
        far = w.far @ w.target.T
        high_near, high_far = near.max(1, keepdims=True), far.max(1, keepdims=True)
        norm = np.exp(near - high_near) @ np.exp(far - high_far).T
        return cls(near, far, np.log(norm) + high_near + high_far.T)

    def log_probability(self, word: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(word | near, far)."""
        return self.near[near, word] + self.far[far, word] - self.log_norm[near, far]


def class_norms(counts: DataFrame, table, features) -> np.ndarray:
    """For every class and word before, the sum over the words of the class of count plus one times
    the exponential of the score, and one for all unseen words. Both arguments are broadcast."""
    def run(batches):
        words, places = table.value.frequent(), features.value
        sums = np.zeros((CLASSES, len(places)))
        for batch in batches:
            k1, k2, ending, c, *vectors = (batch.column(i).to_numpy() for i in range(4 + FEATURES))
            _, number = words.find_keys(k1.view(np.uint64), k2.view(np.uint64), ending)
            order = np.argsort(number, kind="stable")
            order = order[: np.searchsorted(number[order], CLASSES)]
            number, weight = number[order], (c[order] + 1).astype(np.float32)
            own = np.stack(vectors, 1)[order].astype(np.float32)
            cuts = np.searchsorted(number, np.arange(CLASSES + 1))
            for k, (start, stop) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                for at in range(start, stop, BLOCK_WORDS):
                    block = slice(at, min(at + BLOCK_WORDS, stop))
                    sums[k] += weight[block] @ np.exp(own[block] @ places.T)
        held = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(list(sums[held]), pa.list_(pa.float64()))], ["class", "sums"])

    def add(batches):
        totals = {}
        for batch in batches:
            for k, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                totals[k] = totals.get(k, 0) + sums.values.to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.list_(pa.float64()))], ["class", "sums"])

    schema = "class int, sums array<double>"
    parts = counts.select("k1", "k2", "ending", "c", *VECTOR).mapInArrow(run, schema)
    found = parts.repartition(CLASSES, "class").mapInArrow(add, schema).collect()
    norms = np.ones((CLASSES, len(features.value)))
    for row in found:
        norms[row["class"]] += row.sums
    return norms


def score_texts(
    documents: DataFrame, is_training: Column, doc_id: str = "doc_id", text: str = "text",
    vocabulary: int = 960, known_words: int = 100_000,
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every text.

    Counts, weights and vectors come from all training rows. `vocabulary` is the number of words
    of the upper level.
    """
    spark = documents.sparkSession
    share_context = spark.sparkContext.broadcast
    training = documents.filter(is_training).select(F.col(text).cast("string").alias("text"))
    upper = build_table(stored(count_words(training).drop(*VECTOR), "counts"), vocabulary, known_words).frequent()
    weights, unigram = start_weights(upper)
    frequent = share_context(upper)
    for _ in range(min(MOST_ROUNDS, -(-SEEN_TOKENS // upper.total)) if upper.total else 0):
        weights = train_round(training, frequent, weights, unigram, RATE)
    features = context_features(weights, unigram)
    counts = stored(count_words(training, share_context((upper, features))), "vectors")
    table = build_table(counts, vocabulary, known_words)
    shared, places = share_context(table), share_context(features)
    log_norms = np.log(class_norms(counts, shared, places))
    model = share_context((weights, log_norms))
    base_norm = float(np.log10(table.total + table.distinct + 1))
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), *text_key(F.col(text)), F.col(text).cast("string").alias("text"))
    rows_schema = f"doc_id {dict(rows.dtypes)['doc_id']}, k1 long, k2 long"

    def parts(batch: pa.RecordBatch, scorer: Scorer, log_norms: np.ndarray):
        known = shared.value
        t = Tokens(batch.column("text"))
        place, number = known.find(t)
        near, far = contexts(number, t.bounds, end_number(known))
        score = scorer.log_probability(number, near, far)
        found = place >= 0
        shares = np.where(found, np.log10(known.c[place] + 1.0), 0.0) if len(known.c) else np.zeros(len(place))
        inner = np.flatnonzero(number < CLASSES)
        score[inner] -= log_norms[number[inner], near[inner]]
        inner = inner[found[inner]]
        score[inner] += np.einsum("nf,nf->n", known.vectors[place[inner]], places.value[near[inner]])
        score /= np.log(10)
        score[inner] += shares[inner]
        n = batch.num_rows
        sums = (np.bincount(t.text, found, n).astype(np.int64), np.bincount(t.text, shares, n), np.bincount(t.text, score, n))
        return t, found, near, sums

    def work(batches):
        weights, log_norms = model.value
        scorer = Scorer.of(weights)
        for batch in batches:
            for part in slices(batch, "text"):
                t, found, near, (n_found, shares, score) = parts(part, scorer, log_norms)
                rare = np.flatnonzero(~found)
                cut = np.searchsorted(t.text[rare], np.arange(part.num_rows + 1)).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays(
                    [pa.array(t.k1[rare].view(np.int64)), pa.array(t.k2[rare].view(np.int64)),
                     pa.array(near[rare].astype(np.int32))],
                    ["w1", "w2", "near"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(t.counts.astype(np.int64)),
                     pa.array(n_found), pa.array(shares), pa.array(score), words],
                    ["doc_id", "k1", "k2", "n_tokens", "n_found", "shares", "model", "rare"])

    per_text = stored(
        rows.mapInArrow(work, rows_schema + ", n_tokens long, n_found long, shares double, model double, "
                        "rare array<struct<w1:bigint,w2:bigint,near:int>>"), "scores")
    rare = per_text.select("k1", "k2", F.explode("rare").alias("r")).select("k1", "k2", "r.*")
    named = counts.select(F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.log10(F.col("c") + 1).alias("share"), *VECTOR)
    # as many rows as the upper level has words and classes
    pulls = F.broadcast(spark.createDataFrame(
        [(i, *row) for i, row in enumerate(features.astype(float).tolist())],
        "near int, " + ", ".join(f"f{i} double" for i in range(FEATURES))))
    pull = sum((F.col(v) * F.col(f"f{i}") for i, v in enumerate(VECTOR)), F.lit(0.0))
    added = (
        rare.join(named, ["w1", "w2"]).join(pulls, "near").groupBy("k1", "k2")
        .agg(F.count("*").alias("n"), F.sum("share").alias("more"), F.sum(pull / F.lit(math.log(10))).alias("pull"))
    )
    # copies of a text have put their words in as often as there are copies
    copies = per_text.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    per_key = added.join(copies, ["k1", "k2"]).select(
        "k1", "k2", (F.col("n") / F.col("copies")).cast("long").alias("n"),
        *((F.col(name) / F.col("copies")).alias(name) for name in ("more", "pull")))
    more = F.coalesce("more", F.lit(0.0))
    return per_text.drop("rare").join(per_key, ["k1", "k2"], "left").select(
        "doc_id", "n_tokens", (F.col("n_found") + F.coalesce("n", F.lit(0))).alias("n_known"),
        F.lit(table.total).cast("long").alias("train_tokens"),
        (F.col("shares") + more - F.col("n_tokens") * F.lit(base_norm)).alias("base_score"),
        (F.col("model") + more + F.coalesce("pull", F.lit(0.0))).alias("score"))
