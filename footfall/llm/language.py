"""Operator 6: language identification, word first.

A word that was seen in training scores by its log frequency in each
language. An unseen word backs off to the longest length (5 characters down
to 1) of which any of its character n-grams was seen, and scores by the mean
log frequency of those. A text takes the language of the largest sum.

Counts come from a bounded sample of labelled rows (``SAMPLE_ROWS`` expected
of each of the ``LANGUAGES`` most frequent labels) and are made by Spark; the
model keeps every entry of the sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WORD_CACHE, extended, held_out, mix, runs, strings, unit_hash, without

SAMPLE_ROWS = 500
LANGUAGES = 500  # labels that are learnt: a column of dirty labels does not grow the sample
LONGEST = 5
EASE = 0.5  # added to every count
SURE_WORDS = 20  # words after which more of them add no certainty to the score
SEED = 11
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+").findall


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in runs(batches, "text"):
        by: dict[str, Counter] = {}
        for lang, text in zip(run.column("lang").to_pylist(), strings(run.column("text"))):
            by.setdefault(lang, Counter()).update(LETTERS(text.lower()))
        langs, sizes, entries, counts = [], [], [], []
        for lang, words in by.items():
            for n in range(LONGEST + 1):  # 0: whole words
                of = words
                if n:
                    of = Counter()
                    for word, c in words.items():
                        for g in grams(word, n):
                            of[g] += c
                langs += [lang] * len(of)
                sizes += [n] * len(of)
                entries += of.keys()
                counts += of.values()
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(entries, pa.string()), pa.array(counts, pa.int64())],
            ["lang", "size", "entry", "n"],
        )


def _hashes(strings_: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of n characters within the strings, and its string."""
    data = [x.encode("utf-32-le", "replace") for x in strings_]
    sizes = np.array([len(d) // 4 for d in data], np.int64)
    flat = np.frombuffer(b"".join(data), np.uint32).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))
    roll = np.zeros(max(0, len(flat) - n + 1), np.uint64)
    for j in range(n):
        roll = roll * np.uint64(0x100000001B3) + flat[j : j + len(roll)]
    ok = left[: len(roll)] >= n
    return mix(roll[ok]), np.repeat(np.arange(len(sizes)), sizes)[: len(roll)][ok]


@dataclass
class Model:
    """Languages; row of each known word; log frequencies of words; sorted
    hashes and log frequencies of the n-grams of each length."""

    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray]]

    def vectors(self, words: list[str]) -> np.ndarray:
        """Log frequency of each word in each language: its own, or the mean of
        its longest known n-grams, or 0."""
        out = np.zeros((len(words), len(self.langs)))
        rows = np.array([self.words.get(w, -1) for w in words], np.int64)
        out[rows >= 0] = self.word_logs[rows[rows >= 0]]
        open_ = np.flatnonzero(rows < 0)
        for n in range(LONGEST, 0, -1):
            if not len(open_) or n not in self.grams:
                continue
            table, logs = self.grams[n]
            found, owner = _hashes([f"<{words[i]}>" if n > 1 else words[i] for i in open_], n)
            at = np.minimum(np.searchsorted(table, found), len(table) - 1)
            hit = table[at] == found
            at, owner = at[hit], owner[hit]
            times = np.bincount(owner, minlength=len(open_))
            known = times > 0
            for i in range(len(self.langs)):
                out[open_[known], i] = np.bincount(owner, logs[at, i], len(open_))[known] / times[known]
            open_ = open_[~known]
        return out


def build(rows: list[tuple[str, int, str, int]]) -> Model:
    """Model from (language, length, entry, count)."""
    langs = sorted({r[0] for r in rows})
    at = {lang: i for i, lang in enumerate(langs)}
    logs, names = {}, {}
    for n in range(LONGEST + 1):
        of = [r for r in rows if r[1] == n]
        names[n] = {entry: i for i, entry in enumerate(sorted({r[2] for r in of}))}
        counts = np.zeros((len(names[n]), len(langs)))
        for lang, _, entry, count in of:
            counts[names[n][entry], at[lang]] = count
        logs[n] = np.log((counts + EASE) / (counts.sum(0) + EASE * (len(counts) + 1)))
    grams = {}
    for n in range(1, LONGEST + 1):
        if names[n]:
            hashes, _ = _hashes(list(names[n]), n)
            order = np.argsort(hashes)
            grams[n] = (hashes[order], logs[n][order])
    return Model(langs, names[0], logs[0], grams)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, languages: int = LANGUAGES) -> Model:
    """Learn from ``text`` and non-null ``lang`` of about ``sample_rows`` rows of
    each language (a hash of the id and text below the share wanted), of the
    ``languages`` that have the most rows (of equals, those that sort first)."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("lang is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    per = {r.lang: r.n for r in counts.orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not per:
        return Model([], {}, np.empty((0, 0)), {})
    wanted = F.lit(0.0)
    for lang, n in sorted(per.items()):
        wanted = F.when(F.col("lang") == lang, F.lit(sample_rows / n)).otherwise(wanted)
    sample = rows.filter(unit_hash("doc_id", F.xxhash64("text"), F.lit(SEED)) < wanted).select("text", "lang")
    counts = (
        sample.mapInArrow(_count, "lang string, size int, entry string, n long")
        .groupBy("lang", "size", "entry")
        .agg(F.sum("n").alias("n"))
    )
    table = counts.toArrow().to_pydict()  # the entries of the sample
    return build(list(zip(table["lang"], table["size"], table["entry"], table["n"])))


class Identifier:
    """Languages of texts by a model; remembers the vectors of words."""

    def __init__(self, model: Model):
        self.model, self.at, self.vectors = model, {}, np.empty((0, len(model.langs)))

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        docs = [LETTERS(t.lower()) for t in texts]
        counts = np.array([len(d) for d in docs], np.int64)
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.model.langs or not counts.any():
            return langs, scores
        flat = [w for d in docs for w in d]
        if len(self.at) > WORD_CACHE:
            self.at, self.vectors = {}, self.vectors[:0]
        new = [w for w in dict.fromkeys(flat) if w not in self.at]
        if new:
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.vectors = np.concatenate([self.vectors, self.model.vectors(new)])
        at = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        full = np.flatnonzero(counts)
        start = (np.cumsum(counts) - counts)[full]
        sums = np.stack([np.add.reduceat(self.vectors[at, i], start) for i in range(len(self.model.langs))], 1)
        best = sums.argmax(1)
        sure = np.minimum(counts[full], SURE_WORDS) / counts[full]
        p = np.exp((sums - sums.max(1, keepdims=True)) * sure[:, None])
        p /= p.sum(1, keepdims=True)
        for i, b, s in zip(full.tolist(), best.tolist(), p.max(1).tolist()):
            langs[i], scores[i] = self.model.langs[b], s
        return langs, scores


def language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the whole text
    alone. Null texts, texts without a letter, and all texts where nothing was
    learnt get ``und`` and 0. Ties go to the language that sorts first. All
    rows stay; columns already named so are replaced."""
    docs = without(docs, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the entries of a bounded sample
    at = docs.columns.index(text_col)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = Identifier(shared.value)
        for run in runs(batches, text_col):
            langs, scores = name(strings(run.column(at)))
            yield pa.RecordBatch.from_arrays(
                [*run.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*run.schema.names, "lang_pred", "score"]
            )

    return docs.mapInArrow(run_all, extended(docs, lang_pred="string", score="double"))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learnt from rows whose
    crc32 of the id leaves another remainder than 2 by 4."""
    out = held_out("doc_id", 4, 2)
    model = fit(docs.filter(~out))
    return language(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
