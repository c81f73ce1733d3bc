"""Operator 2: toxicity from subword-bag embeddings under a linear softmax.

A word is the bag of its character n-grams (3 to 6, with word boundaries)
and itself; each has an embedding, hashed into a fixed table. Every window of
8 words in a row averages the embeddings of its words and a linear softmax turns that
average into the probability of label 1. Embeddings and softmax are trained
jointly in numpy on a bounded sample of labelled rows. A document scores as
its most toxic window, so a few words count alike in short and long texts,
and a misspelling scores through the n-grams it shares with known words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WORD_CACHE, extended, held_out, mix, runs, strings, unit_hash, without

SAMPLE_ROWS = 1500  # expected labelled rows of each class that are learnt from
BUCKETS = 1 << 17
DIM = 8
WINDOW = 8
EPOCHS = 60
RATE = 0.05
SHRINK = 0.001  # taken off the length of every embedding after each step
EASE = 3.0  # rows of either class added to a subword's count
MARGIN = 1.0  # log-odds of evidence a subword needs to be learnt
REJECT = 0.7
WORDS_AT_ONCE = 20_000
PIECE_WORDS = 1 << 18  # words of whole texts whose windows training holds at a time
SEED = 7
SPLIT = re.compile(r"\S+").findall
EDGES = ".,;:!?\"'()[]{}<>«»„“”…-"


def words_of(text: str) -> list[str]:
    """Lower-case words without surrounding punctuation."""
    return [w for w in (x.strip(EDGES) for x in SPLIT(text.lower())) if w]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all words and the word each belongs to: a word has one row
    for itself and one for each run of 3 to 6 of its UTF-8 bytes, marked with
    < and > at its ends."""
    data = [b"<" + w.encode("utf-8", "replace") + b">" for w in words]
    sizes = np.array([len(d) for d in data], np.int64)
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # bytes from here to the word's end
    rows, owners = [], []
    roll = flat
    for n in range(2, 7):
        roll = roll[:-1] * np.uint64(0x100000001B3) + flat[n - 1 :]
        if n > 2:
            ok = left[: len(roll)] >= n
            rows.append(mix(roll[ok] + np.uint64(n)) % np.uint64(BUCKETS))
            owners.append(owner[: len(roll)][ok])
    whole = [xxhash.xxh64_intdigest(d) for d in data]
    rows.append(np.array(whole, np.uint64) % np.uint64(BUCKETS))
    owners.append(np.arange(len(words)))
    return np.concatenate(rows).astype(np.int64), np.concatenate(owners)


@dataclass
class Model:
    """Embedding table, softmax weights and offset."""

    table: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def words(self, words: list[str]) -> np.ndarray:
        """What each word adds to the log-odds of its window, times the window's length."""
        rows, owner = subwords(words)
        tilt = self.table @ (self.weight[1] - self.weight[0])
        return np.bincount(owner, tilt[rows], len(words)) / np.bincount(owner, minlength=len(words))

    @property
    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def _windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every window and the word after its last, and windows per
    text. A window begins at every word that ``WINDOW`` words follow, itself
    included; a shorter text is one window, a text without words has none."""
    per = np.where(counts > 0, np.maximum(counts - WINDOW + 1, 1), 0)
    first = np.cumsum(counts) - counts
    start = np.repeat(first, per) + np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    return start, start + np.repeat(np.minimum(counts, WINDOW), per), per


class Piece:
    """The windows of some whole texts, laid out once and scored in every epoch."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, y: np.ndarray, cost: np.ndarray):
        start, end, per = _windows(counts)
        self.ids, self.y, self.cost = ids, y, cost
        self.start, self.end = start.astype(np.int32), end.astype(np.int32)
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), per)
        self.first = np.cumsum(per) - per

    def slopes(self, score: np.ndarray, offset: float, heat: float) -> tuple[float, np.ndarray]:
        """Gradient of the loss on the offset and on the score of each word of the
        vocabulary. ``heat`` sets each window's share in its text's score: even at
        0, then ever more the top ones."""
        run = np.r_[0.0, np.cumsum(score[self.ids])]
        z = (run[self.end] - run[self.start]) / WINDOW + offset
        share = np.exp(np.minimum(heat * (z - np.maximum.reduceat(z, self.first)[self.doc]), 0))
        share /= np.add.reduceat(share, self.first)[self.doc]
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(share * z, self.first), -30, 30)))
        slope = (p - self.y) * self.cost
        each = slope[self.doc] * share
        step = np.zeros(len(self.ids) + 1)  # every window starts and ends at words of its own
        step[self.start] += each
        step[self.end] -= each
        return slope.sum(), np.bincount(self.ids, np.cumsum(step[:-1]), len(score)) / WINDOW


def train(texts: list[str], labels: np.ndarray) -> Model:
    """Fit embeddings and softmax together: full-batch Adam on the log loss of
    each document's most toxic window, after rounds on its average window.
    Classes weigh the same. Without both classes every text scores near the
    share of label 1."""
    rng = np.random.default_rng(SEED)
    model = Model(rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.5, (2, DIM)).astype(np.float32), np.zeros(2, np.float32))
    vocab: dict[str, int] = {}
    each, y_all = [], np.asarray(labels)
    for text in texts:  # one text's words at a time
        words = words_of(text)
        each.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in words), np.int32, len(words)))
    use = [i for i, d in enumerate(each) if len(d)]
    y = y_all[use].astype(np.float32)
    if not len(y) or y.min() == y.max():
        share = (float(y_all.sum()) + 0.5) / (len(labels) + 1) if len(labels) else 0.0
        model.table[:] = 0
        model.bias[1] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
        return model
    ids = np.concatenate([each[i] for i in use])
    counts = np.array([len(each[i]) for i in use], np.int64)
    # Subwords start at how much more documents of label 1 hold them than
    # others do; those without such evidence keep a zero vector.
    word_docs = np.zeros((2, len(vocab)))
    for i in use:
        word_docs[int(y_all[i]), np.unique(each[i])] += 1
    names = list(vocab)
    held, pieces = np.zeros((2, BUCKETS)), range(0, len(names), WORDS_AT_ONCE)
    for lo in pieces:
        rows, of = subwords(names[lo : lo + WORDS_AT_ONCE])
        for label in (0, 1):
            held[label] += np.bincount(rows, word_docs[label, lo : lo + WORDS_AT_ONCE][of], BUCKETS)
    n1, n0 = max(1.0, float(y.sum())), max(1.0, float(len(y) - y.sum()))
    ease = EASE / n1
    evidence = np.log((np.minimum(held[1] / n1, 1) + ease) / (np.minimum(held[0] / n0, 1) + ease)) - MARGIN
    flat_known, owner_known, sizes = [], [], []
    for lo in pieces:
        rows, of = subwords(names[lo : lo + WORDS_AT_ONCE])
        known = evidence[rows] > 0
        flat_known.append(rows[known])
        owner_known.append(of[known] + lo)
        sizes.append(np.bincount(of))
    toward = model.weight[1] - model.weight[0]
    toward /= np.sqrt((toward * toward).sum())
    model.weight = np.stack([-toward, toward]).astype(np.float32) / 2
    model.table = (np.maximum(evidence, 0)[:, None] * (toward + model.table)).astype(np.float32)
    used, slot = np.unique(np.concatenate(flat_known), return_inverse=True)
    owner = np.concatenate(owner_known)
    scale = (1.0 / np.concatenate(sizes))[owner].astype(np.float32)
    model.bias[0] = 2.0
    cost = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())).astype(np.float32)
    ends = np.cumsum(counts)
    cuts = [0, *(np.flatnonzero(np.diff((ends - counts) // PIECE_WORDS)) + 1), len(counts)]
    parts = [
        Piece(ids[ends[lo] - counts[lo] : ends[hi - 1]], counts[lo:hi], y[lo:hi], cost[lo:hi])
        for lo, hi in zip(cuts, cuts[1:])
    ]
    table = model.table[used]
    params = [table, model.weight, model.bias]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for epoch in range(1, EPOCHS + 1):
        tilt = model.weight[1] - model.weight[0]
        score = np.bincount(owner, (table @ tilt)[slot] * scale, len(vocab))
        heat = 12.0 * max(0.0, epoch / EPOCHS - 0.2)
        g_offset, g_word = 0.0, np.zeros(len(vocab))
        for part in parts:
            g_part, g_words = part.slopes(score, model.bias[1] - model.bias[0], heat)
            g_offset += g_part
            g_word += g_words
        g_row = np.bincount(slot, g_word[owner] * scale, len(used))
        g_tilt = g_row @ table
        grads = [
            g_row[:, None] * tilt[None, :],
            np.stack([-g_tilt, g_tilt]),
            np.array([-1.0, 1.0]) * g_offset,
        ]
        for x, g, a, b in zip(params, grads, m1, m2):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= (RATE * (a / (1 - 0.9**epoch)) / (np.sqrt(b / (1 - 0.99**epoch)) + 1e-8)).astype(x.dtype)
        length = np.sqrt((table * table).sum(1, keepdims=True))
        table *= np.maximum(0, 1 - SHRINK / np.maximum(length, 1e-9))
    model.table[used] = table
    return model


class Scorer:
    """Scores texts with a model; remembers the scores of words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Score in (0, 1) of each text: its most toxic window; without words, the offset's."""
        docs = [words_of(t) for t in texts]
        counts = np.array([len(d) for d in docs], np.int64)
        flat = [w for d in docs for w in d]
        new = list(set(flat).difference(self.known))
        if len(self.known) + len(new) > WORD_CACHE:
            self.known.clear()
            new = list(set(flat))
        if new:
            self.known.update(zip(new, self.model.words(new).tolist()))
        z = np.full(len(docs), self.model.offset)
        start, end, per = _windows(counts)
        if len(start):
            each = np.r_[np.fromiter(map(self.known.__getitem__, flat), np.float64, len(flat)), np.zeros(WINDOW)]
            full = np.flatnonzero(per)
            sums = np.zeros(len(start))
            for j in range(WINDOW):  # word by word, so a sum does not depend on other texts
                sums += np.where(start + j < end, each[start + j], 0.0)
            z[full] += np.maximum.reduceat(sums, (np.cumsum(per) - per)[full]) / WINDOW
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on about ``sample_rows`` labelled documents of each class, all if
    fewer: a label belongs to the sample if a hash of its id is below the share
    wanted. Label rows without an id or label are ignored; of labels that
    repeat for an id the largest counts. Of rows that share an id one is learnt
    from, so the sample stays bounded however often rows repeat."""
    marked = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    per = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = F.lit(0.0)
    for label, n in per.items():
        wanted = F.when(F.col("toxic") == label, F.lit(sample_rows / n)).otherwise(wanted)
    chosen = marked.filter(unit_hash("doc_id", F.lit(SEED)) < wanted)
    rows = (
        docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # about sample_rows of each class
        .groupBy("doc_id", "toxic")
        .agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))  # one text a label
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("text", "ascending")])
    )
    return train(strings(rows["text"]), rows["toxic"].to_numpy())


def toxicity(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``: the probability of label 1, from the whole
    text alone. Null, empty and wordless texts get the score of an empty text.
    All rows and columns stay; a column already named so is replaced."""
    docs = without(docs, score_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size
    at = docs.columns.index(text_col)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(shared.value)
        for run in runs(batches, text_col):
            scores = score(strings(run.column(at)))
            yield pa.RecordBatch.from_arrays([*run.columns, pa.array(scores)], [*run.schema.names, score_col])

    return docs.mapInArrow(run_all, extended(docs, **{score_col: "double"}))


def learnt_from(df: DataFrame) -> DataFrame:
    """Rows whose crc32 of the id leaves another remainder than 1 by 3."""
    return df.filter(~held_out("doc_id", 3, 1))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.7) of every row of ``docs``."""
    model = fit(docs, learnt_from(labels))
    scored = toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )
