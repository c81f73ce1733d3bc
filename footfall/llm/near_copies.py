"""Operator 1: n-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles. Documents with equal sets form one
class member (a *set*); the join runs on distinct sets.

1. One pass hashes every text to its set key and the hashes of 32 MinHash
   bands of 5 rows. A pair of similarity 0.8 shares a band with probability
   1 - (1 - 0.8^5)^32 = 1 - 3e-6.
2. Buckets are counted with map-side sums; those of one set go, and of
   buckets with the same members the one of the lowest band stays.
3. The members of a bucket are dealt into blocks of bounded rows and
   characters; one task group compares two blocks. There, a pair is treated
   in the first band it shares, so once. Its MinHash values are compared 32
   at a time, and it is dropped when the posterior probability of reaching
   the threshold falls below the tolerance. What is left is verified exactly.
4. A group returns, for each set, how many documents it links to and the
   root of its linked sets, never the pairs; components of these roots are
   the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WordIds, hash_family, hot_keys, mix, runs, shingles, spread_join, stored, strings, word_ids

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 5
STEP = 32  # MinHash values compared between two looks at the posterior
TOLERANCE = 1e-6
BLOCK_ROWS = 1024
BLOCK_CHARS = 4 << 20
SEED = 20_011
PAIRS_AT_ONCE = 1 << 17
CELLS_AT_ONCE = 1 << 22

MARKS = "doc_id long, text_hash long, set_key binary, chars long, bands array<long>"
LINKS = "set_key binary, links long, root binary"


@cache
def least_matches(steps: int, step: int, threshold: float, tolerance: float) -> tuple[int, ...]:
    """For n = step, 2 step, ...: the fewest equal MinHash values among n with
    which the posterior of similarity >= threshold (uniform prior) is not
    below the tolerance. That posterior is P(Binomial(n + 1, t) <= matches)."""
    least = []
    for n in range(step, steps * step + 1, step):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return tuple(least)


def signatures(texts: list[str], ids: WordIds) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, MinHash values and band hashes per text."""
    words, counts = word_ids(texts, ids)
    flat, per = shingles(words, counts, SHINGLE_WORDS)
    ends = np.cumsum(per)
    sets = [np.unique(flat[e - p : e]) for e, p in zip(ends, per)]
    values = np.full((len(texts), BANDS * ROWS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(per)
    if len(full):
        mul, add = hash_family(BANDS * ROWS, SEED)
        x = (flat >> np.uint64(32)).astype(np.uint32)
        starts = (ends - per)[full]
        height = max(1, CELLS_AT_ONCE // len(x))
        for lo in range(0, BANDS * ROWS, height):
            cut = slice(lo, lo + height)
            hashed = x[None, :] * mul[cut, None] + add[cut, None]
            values[full, cut] = np.minimum.reduceat(hashed, starts, axis=1).T
    parts = values.reshape(len(texts), BANDS, ROWS).astype(np.uint64)
    bands = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(texts), BANDS)).copy()
    for r in range(ROWS):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return sets, values, bands


def set_key(hashes: np.ndarray) -> bytes:
    """128-bit key of a shingle set; empty for the empty set."""
    return xxhash.xxh128_digest(hashes.tobytes()) if len(hashes) else b""


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = WordIds()
    for run in runs(batches, "text"):
        texts = strings(run.column("text"))
        sets, _, bands = signatures(texts, ids)
        bands = bands.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                run.column("doc_id"),
                run.column("text_hash"),
                pa.array([set_key(s) for s in sets], pa.binary()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.ListArray.from_arrays(
                    np.arange(0, bands.size + 1, BANDS, dtype=np.int32), pa.array(bands.ravel())
                ),
            ],
            ["doc_id", "text_hash", "set_key", "chars", "bands"],
        )


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of every left with every right set,
    by products of 0/1 matrices over tiles of the hashes both sides have."""
    out = np.zeros((len(left), len(right)))
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    if not len(both):
        return out

    def cells(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(both, flat)
        at[at == len(both)] = 0
        ok = both[at] == flat
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets])[ok], at[ok]

    (ra, ca), (rb, cb) = cells(left, a), cells(right, b)
    width = max(1, CELLS_AT_ONCE // (len(left) + len(right)))
    for lo in range(0, len(both), width):
        tiles = []
        for n, r, c in ((len(left), ra, ca), (len(right), rb, cb)):
            m = (c >= lo) & (c < lo + width)
            tile = np.zeros((n, min(width, len(both) - lo)), np.float32)
            tile[r[m], c[m] - lo] = 1
            tiles.append(tile)
        out += tiles[0] @ tiles[1].T
    return out


def linked_pairs(
    left: np.ndarray,
    right: np.ndarray,
    band: int,
    sets: list[np.ndarray],
    values: np.ndarray,
    bands: np.ndarray,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (one of ``left``, one of ``right``, as indices) whose Jaccard
    similarity reaches the threshold, among those whose first shared band is ``band``."""
    same = left is right
    found_i, found_j = [], []
    height = max(1, PAIRS_AT_ONCE // max(1, len(right)))
    for lo in range(0, len(left), height):
        rows = left[lo : lo + height]
        match = bands[rows, band][:, None] == bands[right, band][None, :]
        for b in range(band):
            match &= bands[rows, b][:, None] != bands[right, b][None, :]
        i, j = np.nonzero(match)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        seen = np.zeros(len(i), np.int64)
        for k, least in enumerate(least_matches(BANDS * ROWS // STEP, STEP, threshold, tolerance)):
            cols = slice(k * STEP, (k + 1) * STEP)
            seen += (values[left[i], cols] == values[right[j], cols]).sum(1)
            keep = seen >= least
            i, j, seen = i[keep], j[keep], seen[keep]
        if len(i):
            ui, i = np.unique(i, return_inverse=True)
            uj, j = np.unique(j, return_inverse=True)
            a, b = [sets[x] for x in left[ui]], [sets[x] for x in right[uj]]
            shared = _shared(a, b)[i, j]
            na, nb = np.array([len(s) for s in a])[i], np.array([len(s) for s in b])[j]
            ok = shared >= threshold * (na + nb - shared) - 1e-9
            found_i.append(left[ui[i[ok]]])
            found_j.append(right[uj[j[ok]]])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n items over the pairs."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _compare(table: pa.Table) -> pa.Table:
    """Links among the rows of one group: two blocks of one bucket, or one block with itself."""
    band, side_a, side_b = (table.column(c)[0].as_py() for c in ("band", "block_a", "block_b"))
    keys, texts = table.column("set_key").to_pylist(), strings(table.column("text"))
    sets, values, bands = signatures(texts, WordIds())
    at = np.array(list({key: a for a, key in enumerate(keys)}.values()), np.int64)  # rows may repeat
    block = np.array(table.column("block").to_pylist(), np.int64)
    copies = np.array(table.column("copies").to_pylist(), np.int64)
    left, right = at[block[at] == side_a], at[block[at] == side_b]
    i, j = linked_pairs(left, left if side_a == side_b else right, band, sets, values, bands)
    links = np.bincount(i, copies[j], len(keys)) + np.bincount(j, copies[i], len(keys))
    root, member = roots(len(keys), i, j), np.flatnonzero(links)
    return pa.table(
        {
            "set_key": pa.array([keys[m] for m in member], pa.binary()),
            "links": pa.array(links[member].astype(np.int64)),
            "root": pa.array([keys[root[m]] for m in member], pa.binary()),
        }
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of ``edges`` (columns a, b)
    is connected to. Each round takes the smallest root among a node's
    neighbours and then follows it one step; labels are stored between rounds."""
    both = stored(
        edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "roots")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        low = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("root").alias("next"))
        step = stored(
            low.join(up, "low").select("node", F.least("low", "next").alias("root"), (F.least("low", "next") < F.col("root")).alias("moved")),
            "roots",
        )
        moved = step.filter("moved").limit(1).count()
        labels = step.drop("moved")
        if not moved:
            return labels


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash`` (xxhash64 of the
    text), ``class_id`` (the smallest id among the documents linked to it over
    any number of links), ``n_links`` (other rows whose similarity is 0.8 or
    more; copies count one by one), ``n_copies`` (rows with the same shingle
    set, itself included), ``class_key`` (equal for the rows of a class) and
    ``first`` (true for the rows with the smallest id, then text hash, of their class).

    Words are lower-case runs of letters, digits and underscores. A text of
    one to four words is one shingle. Null and empty texts and texts without
    words link to nothing and are each their own class (``class_key`` null).
    Rows with a null id take part and sort last; a class of such rows alone
    has a null ``class_id``. A row that repeats counts as a copy. Other columns
    of ``docs`` are not used, whatever their names."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    marks = stored(rows.mapInArrow(_marks, MARKS), "near_marks")
    worded = marks.filter(F.length("set_key") > 0)
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    members = stored(
        worded.groupBy("set_key").agg(
            F.min(name).alias("name"), F.count(F.lit(1)).alias("copies"),
            F.max("chars").alias("chars"), F.min("bands").alias("bands"),
        ),
        "near_sets",
    )
    postings = members.select("set_key", "chars", F.posexplode("bands").alias("band", "bucket"))
    tag = F.xxhash64("set_key")
    buckets = (
        postings.groupBy("bucket", "band")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("chars").alias("total"),
            F.bit_xor(tag).alias("x"), F.sum(F.pmod(tag, F.lit((1 << 31) - 1))).alias("y"),
        )
        .filter("n > 1")
        .groupBy("n", "x", "y")
        .agg(F.min(F.struct("band", "bucket")).alias("one"), F.max("total").alias("total"))
        .select(
            "one.band", "one.bucket",
            F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("total") / BLOCK_CHARS)).cast("int").alias("blocks"),
        )
    )
    found = stored(postings.select("set_key", "band", "bucket").join(buckets, ["band", "bucket"]), "near_buckets")
    wanted = found.select("set_key").distinct().join(members.select("set_key", "name", "copies"), "set_key")
    same = rows.doc_id.eqNullSafe(wanted.name.doc_id) & (rows.text_hash == wanted.name.text_hash)
    texts = rows.join(wanted, same).select("set_key", "copies", "text")
    block = F.pmod(F.xxhash64("set_key", F.lit(1)), F.col("blocks")).cast("int")
    dealt = (
        found.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "set_key", "band", "bucket", "block",
            F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"),
        )
        .join(texts, "set_key")
    )
    links = stored(dealt.groupBy("band", "bucket", "block_a", "block_b").applyInArrow(_compare, LINKS), "near_links")
    roots_of = components(links.filter("set_key != root").select(F.col("set_key").alias("a"), F.col("root").alias("b")))
    linked = (
        links.groupBy(F.col("set_key").alias("key")).agg(F.sum("links").alias("links"))
        .join(roots_of.withColumnRenamed("node", "key"), "key", "left")
    )
    grouped = linked.join(members.select(F.col("set_key").alias("key"), "name"), "key")
    heads = grouped.groupBy("root").agg(F.min("name").alias("head"))
    classes = spread_join(grouped.select("key", "links", "root"), heads, "root", hot_keys(grouped, "root"))
    named = members.select("set_key", "name", "copies").join(classes, F.col("set_key") == F.col("key"), "left").select(
        "set_key", "copies", "links", F.coalesce("root", "set_key").alias("class_key"), F.coalesce("head", "name").alias("head")
    )
    # A set may have many copies, and many texts no words: the first are spread, the others not joined.
    own = worded.select("doc_id", "text_hash", "set_key")
    placed = spread_join(own, named, "set_key", hot_keys(members, "set_key", "copies"), "left")
    nameless = marks.filter(F.coalesce(F.length("set_key"), F.lit(0)) == 0).select("doc_id", "text_hash", F.lit(None).cast(marks.schema["set_key"].dataType).alias("set_key"))
    return placed.unionByName(nameless, allowMissingColumns=True).select(
        "doc_id", "text_hash",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        "class_key",
        F.coalesce(name == F.col("head"), F.lit(True)).alias("first"),
    )
