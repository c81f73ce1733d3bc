"""Operator 5: benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; what is left of a text is
its template. Every window of eight template words of a benchmark item is a
join key. Documents send the windows whose key a bitmap of fixed size holds,
and a hash join on the key finds the items. On each alignment of a document
with an item (the distance of their positions) the same placeholder value of
the item must always meet the same one of the document (two of the item may
meet one of the document: a copy may say 9 apples and 9 pears),
so a question with other numbers, names or units is caught and a chance
agreement of templates is not. A document holds an item when the windows of
consistent alignments cover at least half of the item's.

An item is looked for in three forms, each counted by itself: its template as
it begins a sentence, its template as it stands within one (after a colon, a
quote or other words, where a capitalised first word is a name), and its exact
words without regard to case. The exact form has windows of eight words, or
all words of a shorter item, whatever they are, so a copy is also found where
a template has too few words or too few literals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WORD_CACHE, mix, runs, strings

WINDOW = 8
LEAST = 4  # template words of the shortest item whose template is looked for
COVERAGE = 0.5
FILTER_BITS = 24  # the bitmap has 2^24 places: two megabytes, whatever the benchmark's size
SEED = np.uint64(0x9E3779B97F4A7C15)

# Words and signs read as units after a number, and number words.
UNITS = set(
    """% $ € £ ° mm cm m km mi mile miles inch inches foot feet ft yard yards mg g kg t gram grams kilogram
    kilograms ton tons tonne tonnes lb lbs oz pound pounds ounce ounces ml cl l liter liters litre litres gallon
    gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years
    dollar dollars cent cents euro euros percent degrees degree kmh mph meter meters metre metres kilometer
    kilometers kilometre kilometres""".split()
)
NUMBERS = set(
    """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
    seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million""".split()
)

TOKENS = re.compile(r"\d+(?:[.,]\d+)*|\w+|[.!?\n%$€£°]").findall
LITERAL, MARK, NUMBER, UNIT, CAPITAL, NAME = range(6)
BEGIN, WITHIN, EXACT = range(3)  # forms of an item
HOLDERS = np.array([0, 0, 11, 13, 0, 17], np.uint64)


class _Kinds(dict):
    """token -> its hash with its kind in the three lowest bits."""

    def __missing__(self, token: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        low = token.lower()
        if token in ".!?\n":
            kind = MARK
        elif token[0].isdecimal() or low in NUMBERS:
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = CAPITAL if token[0].isupper() and len(token) > 1 else LITERAL
        value = self[token] = (xxhash.xxh64_intdigest(low.encode("utf-8", "replace")) & ~7) | kind
        return value


def coded(texts: list[str], kinds: _Kinds) -> tuple[np.ndarray, np.ndarray]:
    """Hashes with kinds of the tokens of all texts in order, and tokens per text."""
    flat: list[str] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        tokens = TOKENS(text)
        counts[i] = len(tokens)
        flat.extend(tokens)
    return np.fromiter(map(kinds.__getitem__, flat), np.uint64, len(flat)), counts


def exact_words(code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens but for marks, and how many each text has."""
    keep = (code & np.uint64(7)) != MARK
    return code[keep] >> np.uint64(3), np.bincount(np.repeat(np.arange(len(counts)), counts)[keep], minlength=len(counts))


def templates(code: np.ndarray, counts: np.ndarray, start: int = MARK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in order: the template words, the values behind them (for
    placeholders), whether each is a literal, and the template words per text.
    ``start`` is the kind of what stands before a text.

    A capitalised word that does not begin a sentence is a name; names in a
    row are one. A unit counts as such beside a number."""
    kind, value = (code & np.uint64(7)).astype(np.int8), code >> np.uint64(3)
    doc = np.repeat(np.arange(len(counts)), counts)
    same = np.r_[False, doc[1:] == doc[:-1]] if len(doc) else np.empty(0, bool)
    before = np.where(same, np.r_[MARK, kind[:-1]] if len(kind) else kind, start)
    after = np.where(np.r_[same[1:], False], np.r_[kind[1:], MARK], MARK) if len(kind) else kind
    kind = np.where((kind == CAPITAL) & (before != MARK), NAME, kind)
    kind = np.where((kind == UNIT) & (before != NUMBER) & (after != NUMBER), LITERAL, kind)
    kind = np.where(kind == CAPITAL, LITERAL, kind)
    run = (kind == NAME) & same & (np.r_[MARK, kind[:-1]] == NAME) if len(kind) else np.empty(0, bool)
    keep = (kind != MARK) & ~run
    if run.any():  # the value of a name is that of all its words
        heads = np.cumsum(keep) - 1
        value = value.copy()
        np.add.at(value, np.flatnonzero(keep)[heads[run]], value[run] * SEED)
    literal = kind[keep] == LITERAL
    words = np.where(literal, value[keep], HOLDERS[kind[keep]])
    return words, value[keep], literal, np.bincount(doc[keep], minlength=len(counts))


def windows(words: np.ndarray, counts: np.ndarray, size: int, literal: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the windows of ``size`` words, and where they start. Given
    ``literal``, of the windows that have half literals at least."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    key = np.full(n, size if literal is not None else -size, np.int64).view(np.uint64)
    for j in range(size):
        key = key * SEED + words[j : j + n]
    left = np.repeat(np.cumsum(counts), counts)[:n] - np.arange(n)
    ok = left >= size
    if literal is not None:
        plain = np.r_[0, np.cumsum(literal)]
        ok &= 2 * (plain[size:] - plain[:-size]) >= size
    return mix(key[ok]), np.flatnonzero(ok)


def _slots(values: np.ndarray, literal: np.ndarray, start: int, size: int) -> list[int]:
    cut = slice(start, start + size)
    return values[cut][~literal[cut]].astype(np.int64).tolist()


ITEMS = "item_id long, form int, windows int, size int, at int, key long, slots array<long>"
HITS = "doc_id long, text_hash long, at int, key long, slots array<long>"


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = _Kinds()
    for run in runs(batches, "text"):
        rows = []
        for item, text in zip(run.column("item_id").to_pylist(), strings(run.column("text"))):
            code, tokens = coded([text.lstrip(" \t\r\n.!?")], kinds)
            found = []
            for form, start in (BEGIN, MARK), (WITHIN, LITERAL):
                if form == WITHIN and not (len(code) and code[0] & np.uint64(7) == CAPITAL):
                    continue  # as at the beginning of a sentence
                words, values, literal, counts = templates(code, tokens, start)
                size = min(WINDOW, len(words))
                if size >= LEAST:
                    found.append((form, size, values, literal, *windows(words, counts, size, literal)))
            words, counts = exact_words(code, tokens)
            size = min(WINDOW, len(words))
            if size:
                found.append((EXACT, size, words, np.ones(len(words), bool), *windows(words, counts, size)))
            for form, size, values, literal, keys, at in found:
                for key, a in zip(keys.view(np.int64).tolist(), at.tolist()):
                    rows.append((item, form, len(keys), size, a, key, _slots(values, literal, a, size)))
        yield _table(
            rows, ["item_id", "form", "windows", "size", "at", "key", "slots"],
            [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())],
        )


def benchmark_overlap(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of a document and a benchmark item it holds: ``doc_id``,
    ``text_hash`` (xxhash64 of the text, which tells rows apart that share an
    id or have none), ``item_id``, ``matched`` and ``windows`` (of the item),
    ``coverage`` and ``slots`` (placeholders compared), in the form of the item
    that is covered best (of equal ones, templates first).

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other
    columns are not used. Null and empty texts hold nothing; items without
    words are not looked for. An item of a single word is held by every text
    that has the word. Items that repeat are found each; rows that repeat are
    one document."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = items.mapInArrow(_item_windows, ITEMS)
    # The bitmap is made on Spark, one row for 64 places that hold a key: what comes here is bounded.
    place = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    held_places = (
        items.select(place.alias("place"), (F.col("form") == EXACT).alias("exact"), "size")
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(bit).alias("bits"), F.collect_set(F.struct("exact", "size")).alias("sizes"))
    )
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.int64)
    filled = held_places.select("word", "bits", F.transform("sizes", lambda z: z["size"] * 2 + z["exact"].cast("int")).alias("sizes")).toArrow()
    bitmap[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    sizes = [(bool(z % 2), z // 2) for z in sorted(filled["sizes"].combine_chunks().flatten().unique().to_pylist())]
    shared = spark.sparkContext.broadcast((bitmap, sizes))

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, lengths = shared.value
        held, kinds = np.unpackbits(packed.astype("<i8").view(np.uint8), bitorder="little").astype(bool), _Kinds()
        for run in runs(batches, "text"):
            code, tokens = coded(strings(run.column("text")), kinds)
            words, values, literal, counts = templates(code, tokens)
            first = np.cumsum(counts) - counts
            plain, per = exact_words(code, tokens)
            ends = np.cumsum(per)
            ids, hashes = run.column("doc_id").to_pylist(), run.column("text_hash").to_pylist()
            rows = []
            for whole, size in lengths:
                keys, at = windows(plain, per, size) if whole else windows(words, counts, size, literal)
                hit = held[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                keys, at = keys[hit].view(np.int64), at[hit]
                if whole:  # without slots one place of a text is as good as another
                    for d, key in set(zip(np.searchsorted(ends, at, side="right").tolist(), keys.tolist())):
                        rows.append((ids[d], hashes[d], 0, key, []))
                    continue
                doc = np.searchsorted(first, at, side="right") - 1
                for key, a, d in zip(keys.tolist(), at.tolist(), doc.tolist()):
                    rows.append((ids[d], hashes[d], a - int(first[d]), key, _slots(values, literal, a, size)))
            yield _table(
                rows, ["doc_id", "text_hash", "at", "key", "slots"],
                [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())],
            )

    hits = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    ).mapInArrow(run_all, HITS)
    met = (
        hits.withColumnsRenamed({"at": "doc_at", "slots": "doc_slots"})
        .join(items.select("item_id", "form", "windows", F.col("at").alias("item_at"), "key", "slots"), "key")
        .withColumn("shift", F.when(F.col("form") == EXACT, 0).otherwise(F.col("doc_at") - F.col("item_at")))
        .distinct()
    )
    key = ["doc_id", "text_hash", "item_id", "form", "shift"]
    # One row per alignment; its windows are at most the item's.
    aligned = met.groupBy(*key).agg(
        F.max("windows").alias("windows"), F.collect_set("item_at").alias("at"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip(F.col("slots").alias("item"), F.col("doc_slots").alias("doc"))))).alias("slots"),
    )

    consistent = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["0"])))
    return (
        aligned.withColumn("slots", F.transform("slots", lambda s: F.struct(s["item"].alias("0"), s["doc"].alias("1"))))
        .filter(consistent)
        .groupBy("doc_id", "text_hash", "item_id", "form")
        .agg(
            F.max("windows").alias("windows"),
            F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("matched"),
            F.sum(F.size("slots")).alias("slots"),
        )
        .withColumn("coverage", F.col("matched") / F.col("windows"))
        .filter(F.col("coverage") >= coverage)
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max(F.struct("coverage", -F.col("form"), "matched", "windows", "slots")).alias("best"))
        .select("doc_id", "text_hash", "item_id", "best.matched", "best.windows", "best.coverage", "best.slots")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged."""
    held = benchmark_overlap(docs, benchmark).select(F.col("doc_id").alias("held_id"), F.col("text_hash").alias("held_hash")).distinct()
    same = docs.doc_id.cast("long").eqNullSafe(F.col("held_id")) & (F.xxhash64(docs.text.cast("string")) == F.col("held_hash"))
    return docs.join(held, same, "left_anti")
