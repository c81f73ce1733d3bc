"""Operator 11: centroid clustering whose assignment is a threshold algorithm.

Vectors are whole numbers (scaled and floored), so every distance and every
centroid is exact and the result does not depend on partitions or retries. For
each dimension the centroids lie in a list sorted by that component. A vector's
lists are walked outward from its own value, one step in every dimension at a
time; a centroid is measured exactly when a walk first meets it, and what no
walk has met yet is at least as far as the sum of the squared frontier gaps.
The walk ends when that sum strictly exceeds the best distance: a centroid at an
equal distance has then been met, and ties go to the smaller number.

A round is one pass over the stored vectors; tasks return sums and counts per
centroid, so only ``clusters`` x ``dims`` numbers reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
LIMIT = 1 << 27  # of a scaled component: squared distances of 64 of them still fit a long
BLOCK = 4096  # vectors walked together
FAR = np.iinfo(np.int64).max

RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
PARTIAL = "cluster int, n long, sums array<long>"


def scaled_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and the whole-number vector ``x`` of every row whose embedding
    has exactly ``dims`` components, none of them null, NaN, infinite, or
    ``LIMIT / scale`` or more in size (its distances need not fit a long)."""
    given = F.col("embedding").cast("array<double>")
    fine = F.forall(given, lambda v: F.abs(v) < float(LIMIT // scale))  # not so for NaN
    kept = vectors.filter((F.size(given) == dims) & fine)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(given, lambda v: F.floor(v * float(scale)).cast("int")).alias("x"),
    )


def first_centroids(scaled: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The vectors whose ``seed:vec_id`` have the smallest hashes, in that order
    (a null id counts as empty text; rows that share an id by their components)."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = scaled.select(F.sha2(name.cast("binary"), 256).alias("hash"), "x").orderBy("hash", "x").limit(clusters).collect()
    return np.array([r.x for r in rows], np.int64)


class Nearest:
    """The nearest centroid of each of many vectors."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")  # of each dimension's list
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the nearest centroids and squared distances."""
        parts = [self._walk(x[at : at + BLOCK]) for at in range(0, len(x), BLOCK)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, dims = self.centroids.shape
        best, who = np.full(len(x), FAR), np.zeros(len(x), np.int64)
        met = np.zeros((len(x), k), bool)
        up = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in range(dims)], axis=1)
        down = up - 1
        going, column = np.arange(len(x)), np.arange(dims)
        while len(going):
            here, high, low = x[going], up[going], down[going]
            over = np.where(high < k, self.values[np.minimum(high, k - 1), column] - here, FAR)
            under = np.where(low >= 0, here - self.values[np.maximum(low, 0), column], FAR)
            upward = over < under
            at = np.where(upward, np.minimum(high, k - 1), np.maximum(low, 0))
            gap = np.where(upward, over, under)  # the frontier of each list
            up[going], down[going] = high + upward, low - ~upward
            reached = np.zeros((len(going), k), bool)
            np.put_along_axis(reached, self.order[at, column], True, axis=1)
            reached &= ~met[going]
            met[going] |= reached
            for c in np.flatnonzero(reached.any(axis=0)):
                row = np.flatnonzero(reached[:, c])
                away = ((here[row] - self.centroids[c]) ** 2).sum(axis=1)
                row = going[row]
                nearer = (away < best[row]) | ((away == best[row]) & (c < who[row]))
                best[row[nearer]], who[row[nearer]] = away[nearer], c
            bound = (gap**2).sum(axis=1)
            going = going[~(bound > best[going]) & ~met[going].all(axis=1)]
        return who, best


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _sums(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        n, sums = np.zeros(len(centroids), np.int64), np.zeros_like(centroids)
        for batch in batches:
            x = _matrix(batch, centroids.shape[1])
            who, _ = nearest(x)
            n += np.bincount(who, minlength=len(centroids))
            for c in np.unique(who):
                sums[c] += x[who == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(n)), pa.int32()), pa.array(n), pa.array(sums.tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return run


def _assign(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        for batch in batches:
            who, away = nearest(_matrix(batch, centroids.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(away, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def moved(scaled: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of exact means; empty ones stay."""
    parts = scaled.mapInArrow(_sums(centroids), PARTIAL)
    totals = (
        parts.select("cluster", "n", F.posexplode("sums").alias("dim", "part"))
        .groupBy("cluster", "dim")
        .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        .filter("n > 0")
    )
    new = centroids.copy()
    for r in totals.collect():  # clusters x dims numbers
        new[r.cluster, r.dim] = int(r.total) // int(r.n)
    return new


def clustered(
    vectors: DataFrame, dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED
) -> DataFrame:
    """One row per vector that takes part: ``vec_id``, its ``cluster``, squared
    ``distance``, ``cluster_inertia`` and ``inertia`` (distances summed over its
    cluster, over all; null where that does not fit a long) and
    ``centroid_sha256`` of the final centroid.

    Rows whose embedding is null, of another length, or holds a null, NaN,
    infinite or too large component (``LIMIT``) take no part. Rows that repeat,
    share an id or have none are each clustered; equal vectors get the same
    cluster. Fewer than ``clusters`` vectors give as many centroids; an empty
    table an empty result. Other columns are not used."""
    scaled = stored(scaled_vectors(vectors, dims, scale), "centroid_vectors")
    spark = scaled.sparkSession
    centroids = first_centroids(scaled, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = moved(scaled, centroids)
    found = stored(scaled.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long"), "centroid_members")
    totals = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part"))
    hashes = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    about = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string").join(totals, "cluster")
    about = about.select(
        "cluster", "centroid_sha256", F.col("part").try_cast("long").alias("cluster_inertia"),
        totals.select(F.sum("part")).scalar().try_cast("long").alias("inertia"),
    )
    # One row a centroid.
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clustered_sql(dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> str:
    """The same in DuckDB SQL, round by round."""
    parts = [
        f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: cast(floor({scale} * cast(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e) AND abs(e) < {LIMIT // scale})) = {dims}
)""",
        f"""
c0 AS MATERIALIZED (
  SELECT cast(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS c, x
  FROM (SELECT sha256('{seed}:' || coalesce(cast(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {clusters})
)""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min([d, c]) AS m
  FROM (SELECT r, c, cast(list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c{i}.x[i]) * (v.x[i] - c{i}.x[i]))) AS BIGINT) AS d
        FROM v CROSS JOIN c{i})
  GROUP BY r
)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, list(cast((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
  FROM (SELECT m[2] AS c, i, sum(v.x[i]) AS s, count(*) AS n
        FROM a{i} JOIN v USING (r) CROSS JOIN (SELECT unnest(range(1, {dims + 1})) AS i) GROUP BY ALL)
  GROUP BY c
  UNION ALL SELECT c, x FROM c{i} WHERE c NOT IN (SELECT m[2] FROM a{i})
)""")
    return "WITH " + ",".join(parts) + f"""
SELECT v.vec_id, cast(m[2] AS INTEGER) AS cluster, m[1] AS distance,
       cast(sum(m[1]) OVER (PARTITION BY m[2]) AS BIGINT) AS cluster_inertia,
       cast(sum(m[1]) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.c = m[2]"""
