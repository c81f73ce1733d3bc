"""Helpers shared by the training-data operators.

Arrow batches are cut into runs of whole rows of about ``TEXT_BYTES`` of text,
so a task holds the words of a few megabytes at a time however large a batch
is; a single longer text is a run of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from footfall.session import scratch_path

TEXT_BYTES = 2 << 20
WORD_CACHE = 200_000  # words remembered per task; the cache is emptied beyond that
WORDS = re.compile(r"\w+").findall


def held_out(id_col: str, divisor: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return crc % divisor == remainder


def unit_hash(*cols: str | Column) -> Column:
    """A number in [0, 1) that depends on the columns' values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: what
    follows does not depend on any executor, and reads only the columns it needs."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


HOT_SHARE = 1000  # a key is hot if it has more than 1 / this of all rows: so many keys at most
SPREAD = 64  # tasks over which the rows of a hot key are spread


def hot_keys(df: DataFrame, key: str, rows: str | None = None) -> DataFrame:
    """The hot keys of ``df``, whose rows stand for ``rows`` rows each (one, if not given)."""
    n = F.sum(rows) if rows else F.count(F.lit(1))
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(n.alias("_n"))
    return counts.filter(F.col("_n") * HOT_SHARE > counts.select(F.sum("_n")).scalar()).select(key)


def spread_join(facts: DataFrame, dim: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``key`` in which the rows of hot keys (``hot_keys``) are dealt over
    ``SPREAD`` tasks by a hash of the row, and their rows of ``dim`` repeated."""
    mark = F.broadcast(hot.select(key, F.lit(SPREAD).alias("_spread")))  # HOT_SHARE rows at most
    dealt = facts.withColumn("_row", F.xxhash64(*facts.columns)).join(mark, key, "left")
    dealt = dealt.withColumn("_salt", F.pmod("_row", F.coalesce("_spread", F.lit(1))).cast("int")).drop("_row", "_spread")
    again = dim.join(mark, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_spread", F.lit(1)) - 1))).drop("_spread")
    return dealt.join(again, [key, "_salt"], how).drop("_salt")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns of ``df`` whose names an operator is about to add."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


def extended(df: DataFrame, **types: str | DataType) -> StructType:
    """The schema of ``df`` with further columns."""
    schema = StructType(list(df.schema.fields))
    for name, kind in types.items():
        schema = schema.add(name, kind)
    return schema


def strings(col: pa.Array | pa.ChunkedArray) -> list[str]:
    """Column values as Python strings: null as empty, bytes that are not UTF-8 replaced."""
    try:
        return [v or "" for v in col.to_pylist()]
    except UnicodeDecodeError:
        return [(v or b"").decode("utf-8", "replace") for v in col.cast(pa.binary()).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Row runs of the batches with about ``TEXT_BYTES`` of ``text_col`` each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size.astype(np.int64)) - size) // TEXT_BYTES
        cut = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cut], [*cut, batch.num_rows]):
            yield batch.slice(lo, hi - lo)


class WordIds(dict):
    """word -> 64-bit hash, remembered for frequent words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


def word_ids(texts: list[str], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts, in order, and words per text."""
    flat: list[str] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = WORDS(text.lower())
        counts[i] = len(words)
        flat.extend(words)
    return np.fromiter(map(ids.__getitem__, flat), np.uint64, len(flat)), counts


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche finaliser on 64-bit values (the splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, in order, and shingles per
    text. A text of fewer than k words (but one) is a single shingle."""
    n = len(words)
    ends = np.cumsum(counts)
    starts = ends - counts
    roll = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        roll = roll * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(roll)]
    per = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.cumsum(per) - per
    at = np.arange(int(per.sum())) + np.repeat(starts - first, per)
    out = np.empty(len(at), np.uint64)
    long = np.repeat(counts >= k, per)
    out[long] = roll[at[long]]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        h = np.full(1, counts[i], np.uint64)
        for w in words[starts[i] : ends[i]]:
            h = h * np.uint64(0x9E3779B97F4A7C15) + w
        out[first[i]] = h[0]
    return mix(out), per


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """n multiply-add hash functions on 32 bits (odd multipliers)."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)

