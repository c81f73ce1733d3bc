"""Operator 12: Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (LZ78: each phrase is the shortest one
not yet in the dictionary). Texts that would compress each other well share
phrases, so the fingerprint is a minimum-hash signature of the phrase set: the
hashes fall into ``BINS`` bins by their leading bits, and each bin keeps 16 bits
of its smallest. Likeness is the share of equal bins among those that either
signature fills, an estimate of the Jaccard similarity of the phrase sets.

An edited text keeps the beginning of its document, so its parse goes on from
the document's own: the phrases found after the cut are taken back and the new
ending is read instead. The dictionary starts anew after ``PHRASES`` phrases,
which bounds a task's memory on very long texts; every part of a text is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import mix, runs, stored, strings

BINS = 128  # a power of two
PHRASES = 1 << 20  # in a dictionary
PIECE = 1 << 20  # code points hashed at a time
NONE = 0xFFFF  # of a bin without phrases
BASE = 0x9E3779B97F4A7C15  # odd; of the polynomial hash modulo 2^64
SHIFT = 21  # bits of a code point


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def _read(codes: np.ndarray, trie: dict[int, int], node: int, ends: list[int], at: int) -> tuple[int, bool]:
    """Parses ``codes``, which begin at place ``at`` of the text, within the open
    phrase ``node``: adds where phrases end, returns the phrase left open and
    whether the dictionary started anew."""
    get, add, anew = trie.get, ends.append, False
    for lo in range(0, len(codes), PIECE):
        for place, code in enumerate(codes[lo : lo + PIECE].tolist(), at + lo + 1):
            child = get(node | code)
            if child is not None:
                node = child
                continue
            if len(trie) < PHRASES:
                trie[node | code] = (len(trie) + 1) << SHIFT
            else:
                trie.clear()
                anew = True
            add(place)
            node = 0
    return node, anew


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 2 * len(_POWERS[0]))
        for i, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            values = np.full(size, b, np.uint64)
            values[0] = 1
            _POWERS[i] = np.cumprod(values, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def phrase_hashes(codes: np.ndarray, ends: list[int]) -> np.ndarray:
    """64-bit hash of every phrase of a parse: a polynomial of its code points."""
    end = np.array(ends, np.int64)
    start = np.append(0, end[:-1]) if len(end) else end
    out = np.empty(len(end), np.uint64)
    cut = np.flatnonzero(np.diff(end // PIECE)) + 1
    for some in np.split(np.arange(len(end)), cut) if len(end) else []:
        lo, hi = start[some[0]], end[some[-1]]
        up, down = _powers(int(hi - lo))
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((codes[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=total[1:])
        s, e = start[some] - lo, end[some] - lo
        out[some] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
    return mix(out)


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """16 bits of the smallest hash of each bin, ``NONE`` where it has none."""
    least = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    bits = np.uint64(64 - (bins.bit_length() - 1))
    at = (hashes >> bits).astype(np.int64)
    np.minimum.at(least, at, hashes)
    out = (mix(least) % np.uint64(NONE)).astype(np.uint16)
    out[np.bincount(at, minlength=bins) == 0] = NONE
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those filled in either signature, row by row
    (1 where both are empty)."""
    filled = ((a != NONE) | (b != NONE)).sum(axis=-1)
    equal = ((a == b) & (a != NONE)).sum(axis=-1)
    return np.where(filled == 0, 1.0, equal / np.maximum(filled, 1))


class Document:
    """A text's signature, and the dictionary of its beginning for its edited texts."""

    def __init__(self, text: str) -> None:
        self.text, self.codes = text, _codes(text)
        self.cut = len(self.codes) - len(self.codes) // 4
        self.trie: dict[int, int] = {}
        self.begun: list[int] = []
        self.node, _ = _read(self.codes[: self.cut], self.trie, 0, self.begun, 0)
        self.known, self.lost = len(self.trie), False
        self.mark = signature(phrase_hashes(self.codes, self._ends(self.codes[self.cut :])))

    def _ends(self, tail: np.ndarray) -> list[int]:
        """Where the phrases of the beginning with another ending end."""
        if self.lost:  # the dictionary of the beginning, within an earlier ending
            ends: list[int] = []
            node, _ = _read(self.codes[: self.cut], trie := {}, 0, ends, 0)
            _read(tail, trie, node, ends, self.cut)
            return ends
        ends = list(self.begun)
        _, self.lost = _read(tail, self.trie, self.node, ends, self.cut)
        for key in [] if self.lost else list(islice(self.trie, self.known, None)):
            del self.trie[key]
        return ends

    def edited(self, follower: str) -> tuple[str, np.ndarray]:
        """The text with its last quarter replaced by the beginning of another one, and its signature."""
        head = follower[: len(self.codes) - self.cut]
        tail = _codes(head)
        return self.text[: self.cut] + head, signature(phrase_hashes(np.concatenate([self.codes[: self.cut], tail]), self._ends(tail)))


ROW, FIRST, LAST = 0, 1, 2  # kinds of a task's rows: a document and its next; its first and its last document
FOUND = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("mark", pa.binary()), ("edited_mark", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string()),
])
FOUND_SQL = (
    "kind int, part int, doc_id long, n_chars long, edited_sha256 string, mark binary, edited_mark binary, "
    "near_edited double, near_next double, text string"
)


def _row(doc_id: int | None, doc: Document, then: Document) -> tuple:
    new, mark = doc.edited(then.text)
    return (
        ROW, None, doc_id, len(doc.codes), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(),
        doc.mark.tobytes(), mark.tobytes(), float(likeness(doc.mark, mark)), float(likeness(doc.mark, then.mark)), None,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FOUND)], schema=FOUND)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of a task with the next one, from rows in order; the
    first document for the task before, the last for the one after."""
    part = TaskContext.get().partitionId()
    doc, doc_id, before = None, None, None
    for batch in runs(batches, "text"):
        out = []
        for at, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text"))):
            same = doc is not None and doc.text == text
            then = doc if same else Document(text)
            if doc is None:
                out.append((FIRST, part, *[None] * (len(FOUND) - 3), text))
            elif same and before is not None and before[1]:  # one of many copies
                out.append((*before[0][:2], doc_id, *before[0][3:]))
            else:
                before = (_row(doc_id, doc, then), same)
                out.append(before[0])
            if not same:
                before = None
            doc, doc_id = then, at
        yield _batch(out)
    if doc is not None:
        yield _batch([(LAST, part, doc_id, *[None] * (len(FOUND) - 4), doc.text)])


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text, then in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strings(batch.column("then"))):
            yield _batch([_row(doc_id, Document(text), Document(then))])


def phrase_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint`` (hexadecimal), ``near_edited`` and
    ``near_next``; see the module for the method.

    The edited text has the last quarter of the code points replaced by as many
    of the next document, by ascending doc_id (null first), after the last the
    first. Rows that share an id go by a hash of their texts, so a row that
    repeats is followed by its like. Null texts are empty; an empty text has an
    empty phrase set, its likeness is 1 to another empty one and else 0. Alone
    in the table, a document follows itself. An empty table gives an empty
    result. Other columns are not used.

    The rows are dealt into ranges of this order, their texts moved once. Copies
    of one row are told apart by the row's place in its file, so that a large
    group of them is spread as well."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ranges = rows.repartitionByRange("doc_id", "text_hash", "place").sortWithinPartitions("doc_id", "text_hash")
    found = stored(ranges.select("doc_id", "text").mapInArrow(_in_order, FOUND_SQL), "phrase_rows")
    firsts = found.filter(F.col("kind") == FIRST).select(F.col("part").alias("after"), F.col("text").alias("then"))
    lasts = found.filter(F.col("kind") == LAST).select("part", "doc_id", "text")
    parts = [r.after for r in firsts.select("after").orderBy("after").collect()]  # tasks that have rows
    pairs = rows.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int")
    ends = lasts.join(pairs, "part").join(firsts, "after").select("doc_id", "text", "then").mapInArrow(_at_ends, FOUND_SQL)
    hexed = [F.lower(F.hex(c)).alias(name) for c, name in (("mark", "fingerprint"), ("edited_mark", "edited_fingerprint"))]
    return (
        found.filter(F.col("kind") == ROW).unionByName(ends)
        .select("doc_id", "n_chars", "edited_sha256", *hexed, "near_edited", "near_next")
    )
