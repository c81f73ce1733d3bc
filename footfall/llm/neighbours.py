"""Operator 3: approximate nearest neighbours with a random-projection forest.

Trees are fitted on a bounded sample: a node splits its vectors at the median
of their projection on the difference of two of them. Every row is routed to
one leaf in each tree. A query searches all trees through one priority queue
ordered by the largest margin crossed on the way to a node, until the leaves
it has taken hold the share of the rows wanted. Leaves are dealt with their
rows into groups of bounded size; a group measures its queries against the
rows of the leaves they took, exactly and in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import unit_hash

SAMPLE_ROWS = 20_000  # expected vectors that the trees are fitted on
TREES = 3
LEAF_ROWS = 64  # of the sample
SHARE = 0.42  # of a tree's rows that a query takes, on the average over the trees
TOP = 10
LEAVES_TOGETHER = 16
GROUP_ROWS = 8192
GROUP_QUERIES = 16_384
CELLS_AT_ONCE = 1 << 21
SEED = 5


@dataclass
class Tree:
    """Split nodes: normals, thresholds and children (leaf i as -1 - i); share of the sample by leaf."""

    normals: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    shares: np.ndarray


def grow(x: np.ndarray, leaf_rows: int, seed: int) -> Tree:
    """One tree over the sample ``x``. A node whose vectors a split does not part is a leaf."""
    rng = np.random.default_rng(seed)
    normals, cuts, children, sizes = [], [], [], []

    def node(at: np.ndarray) -> int:
        if len(at) > leaf_rows:
            a, b = x[rng.choice(at, 2, replace=False)]
            normal = (a - b) / (np.linalg.norm(a - b) or 1.0)
            side = x[at] @ normal
            cut = float(np.median(side))
            right = side > cut
            if right.any() and not right.all():
                me = len(cuts)
                normals.append(normal)
                cuts.append(cut)
                children.append([0, 0])
                children[me] = [node(at[~right]), node(at[right])]
                return me
        sizes.append(len(at))
        return -len(sizes)

    node(np.arange(len(x)))
    wide = x.shape[1]
    return Tree(
        np.array(normals).reshape(-1, wide), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), np.array(sizes) / max(1, len(x))
    )


def route(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf of each vector."""
    if not len(tree.cuts):
        return np.zeros(len(x), np.int64)
    right = x @ tree.normals.T > tree.cuts
    at = np.zeros(len(x), np.int64)
    while True:
        live = np.flatnonzero(at >= 0)
        if not len(live):
            return -1 - at
        at[live] = tree.children[at[live], right[live, at[live]].astype(np.int64)]


def search(forest: list[Tree], margins: list[np.ndarray], share: float) -> list[tuple[int, int]]:
    """(tree, leaf) that one query takes, nearest first; ``margins`` are its
    distances to the split planes of each tree."""
    queue = [(0.0, t, 0 if len(tree.cuts) else -1) for t, tree in enumerate(forest)]
    taken, held, wanted = [], 0.0, share * len(forest)
    while queue and held < wanted:
        far, t, n = heapq.heappop(queue)
        tree = forest[t]
        while n >= 0:
            m = margins[t][n]
            near = int(m > 0)
            heapq.heappush(queue, (max(far, abs(m)), t, int(tree.children[n, 1 - near])))
            n = int(tree.children[n, near])
        taken.append((t, -1 - n))
        held += tree.shares[-1 - n]
    return taken


def _vectors(col: pa.Array, wide: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, wide)


def _nearest(members: pa.Table, queries: pa.Table, wide: int, top: int) -> pa.Table:
    """The ``top`` nearest ids of each query of a group, among its leaves' rows;
    an id counts at its smallest distance."""
    out_q, out_v, out_s = [], [], []
    if members.num_rows and queries.num_rows:
        ids, leaf = members["vec_id"].to_numpy(), members["leaf"].to_numpy()
        x = _vectors(members["vector"].combine_chunks(), wide)
        qid, q = queries["query_id"].to_numpy(), _vectors(queries["vector"].combine_chunks(), wide)
        order = np.argsort(leaf, kind="stable")
        ids, leaf, x = ids[order], leaf[order], x[order]
        for row, leaves in enumerate(queries["leaves"].to_pylist()):
            lo, hi = np.searchsorted(leaf, leaves, side="left"), np.searchsorted(leaf, leaves, side="right")
            at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
            at = at[ids[at] != qid[row]]
            score = np.empty(len(at))
            step = max(1, CELLS_AT_ONCE // wide)
            for s in range(0, len(at), step):
                score[s : s + step] = np.sqrt(((x[at[s : s + step]] - q[row]) ** 2).sum(1))
            reach = top
            while True:  # the nearest rows, more of them until they have ``top`` ids
                close = np.arange(len(at))
                if len(at) > 4 * reach:
                    close = np.flatnonzero(score <= np.partition(score, reach - 1)[reach - 1])
                best = close[np.lexsort((ids[at[close]], score[close]))]
                best = best[np.sort(np.unique(ids[at[best]], return_index=True)[1])[:top]]
                if len(best) == top or len(close) == len(at):
                    break
                reach *= 4
            out_q.append(np.full(len(best), qid[row]))
            out_v.append(ids[at[best]])
            out_s.append(score[best])
    flat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0), kind)
    return pa.table({"query_id": flat(out_q, pa.int64()), "vec_id": flat(out_v, pa.int64()), "score": flat(out_s, pa.float64())})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and ``vector`` (doubles) of the rows that take part: with an id,
    not null, no null or non-finite component, not all zero."""
    v = F.col("vector")
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & v.isNotNull())
        .filter(F.forall(v, lambda e: e.isNotNull() & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0))
    )


def nearest_neighbours(vectors: DataFrame, every: int = 100, top: int = TOP, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance, double precision)
    of the ``top`` nearest rows found for each row whose id ``every`` divides.

    Vectors of another length than the most frequent one take no part, nor do
    those ``usable`` leaves out. Of rows with the same vector only the
    ``top`` + 1 smallest ids can be listed, so the others are left out before
    the search; an id that repeats is listed once, at its smallest distance,
    and rows that repeat (id and vector) are one.
    Ties go to the smaller id. Fewer rows than ``top``: all are listed, as far
    as the leaves searched hold them."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("vector").alias("wide")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "wide").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wide, total = sizes[0].wide, sizes[0].n
    rows = rows.filter(F.size("vector") == wide)
    sample = rows.filter(unit_hash("vec_id", F.lit(SEED)) < SAMPLE_ROWS / total).distinct().select("vector").toArrow()
    x = _vectors(sample["vector"].combine_chunks(), wide) if sample.num_rows else np.zeros((1, wide))
    x = x[np.lexsort(x.T[::-1])]  # one order, whatever the partitions
    forest = [grow(x, LEAF_ROWS, SEED + t) for t in range(TREES)]
    shared = spark.sparkContext.broadcast(forest)  # grown on the bounded sample
    groups = sum(-(-len(t.shares) // LEAVES_TOGETHER) for t in forest) / TREES
    blocks = max(1, round(total / groups / GROUP_ROWS))
    sheets = max(1, -(-total // every // GROUP_QUERIES))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column("vector"), wide)
            found = np.stack([route(t, v) for t in shared.value], 1)
            cells = pa.ListArray.from_arrays(np.arange(0, found.size + 1, TREES, dtype=np.int32), pa.array(found.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), cells], ["vec_id", "vector", "leaves"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column("vector"), wide)
            planes = [v @ t.normals.T - t.cuts for t in shared.value]
            at, tree, group, taken = [], [], [], []
            for i in range(len(v)):
                by: dict[tuple[int, int], list[int]] = {}
                for t, leaf in search(shared.value, [p[i] for p in planes], share):
                    by.setdefault((t, leaf // LEAVES_TOGETHER), []).append(leaf)
                for (t, g), found in by.items():
                    at.append(i)
                    tree.append(t)
                    group.append(g)
                    taken.append(found)
            rows_at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(rows_at), batch.column("vector").take(rows_at),
                    pa.array(tree, pa.int32()), pa.array(group, pa.int32()), pa.array(taken, pa.list_(pa.int32())),
                ],
                ["query_id", "vector", "tree", "group", "leaves"],
            )

    same = Window.partitionBy("vector").orderBy("vec_id")
    single = rows.distinct().withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= top + 1).drop("nth")
    members = (
        single.mapInArrow(leaves, "vec_id long, vector array<double>, leaves array<int>")
        .select("vec_id", "vector", F.posexplode("leaves").alias("tree", "leaf"))
        .withColumn("group", F.expr(f"leaf div {LEAVES_TOGETHER}").cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        .withColumn("sheet", F.explode(F.sequence(F.lit(0), F.lit(sheets - 1))))
    )
    asked = (
        rows.filter(F.col("vec_id") % every == 0)
        .distinct()
        .mapInArrow(visits, "query_id long, vector array<double>, tree int, group int, leaves array<int>")
        .withColumn("sheet", F.pmod(F.xxhash64("query_id"), F.lit(sheets)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    key = ["tree", "group", "block", "sheet"]
    found = (
        members.groupBy(*key)
        .cogroup(asked.groupBy(*key))
        .applyInArrow(lambda m, q: _nearest(m, q, wide, top), "query_id long, vec_id long, score double")
    )
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
