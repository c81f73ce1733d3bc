"""Operator 11 against brute force."""

import hashlib
import math

import duckdb
import numpy as np

from footfall.llm import centroids as ce

TINY = "/root/testdata/sf0.001"
NAMES = "vec_id long, embedding array<double>, cluster string"


def brute(rows, dims, clusters, rounds):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [math.floor(1024 * v) for v in x]))
    name = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [x for _, x in sorted(kept, key=name)[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        of = [nearest(x)[1] for _, x in kept]
        for c in set(of):
            own = [x for (_, x), o in zip(kept, of) if o == c]
            cents[c] = [sum(col) // len(own) for col in zip(*own)]
    out = [(vec_id, *nearest(x)[::-1]) for vec_id, x in kept]
    parts = {c: sum(d for _, o, d in out if o == c) for _, c, _ in out}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((v, c, d, parts[c], sum(parts.values()), sha[c]) for v, c, d in out)


def got(df, **how):
    return sorted(tuple(r) for r in ce.clustered(df, **how).collect())


def test_small_vectors_with_ties_and_repeats(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) / 8 for v in rng.integers(-3, 4, 4)]) for i in range(300)]
    rows += rows[:40] + [(7, [9.0, 9.0, 9.0, 9.0])] * 100
    df = spark.createDataFrame([(*r, "x") for r in rows], NAMES)
    for k, rounds in ((1, 3), (5, 4), (8, 10)):
        assert got(df.repartition(7), dims=4, clusters=k, rounds=rounds) == brute(rows, 4, k, rounds)


def test_walks_equal_plain_distances():
    rng = np.random.default_rng(1)
    for k, dims, spread in ((8, 64, 300), (3, 2, 2), (40, 5, 4), (1, 3, 9)):
        cents, x = rng.integers(-spread, spread, (k, dims)), rng.integers(-2 * spread, 2 * spread, (500, dims))
        who, away = ce.Nearest(cents)(x)
        every = ((x[:, None] - cents[None]) ** 2).sum(axis=2)
        assert (who == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()


def test_the_walk_stops_early():
    class Seen(np.ndarray):
        def __getitem__(self, i):
            measured.append(int(i))
            return np.asarray(self)[i]

    measured = []
    cents = np.array([[0, 0], [1000, 1000], [2000, 2000], [-5000, 7000]])
    near = ce.Nearest(cents)
    near.centroids = cents.view(Seen)
    who, away = near(np.array([[3, 4]]))
    assert (who[0], away[0]) == (0, 25) and measured == [0, 1]  # the others are never measured
    # At an equal distance the walk goes on: the smaller number wins.
    near = ce.Nearest(np.array([[4, 0], [0, 0], [2, 2]]))
    assert [int(v[0]) for v in near(np.array([[2, 0]]))] == [0, 4]


def test_odd_vectors(spark):
    big = [1e300, 0.0]
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (7, [1.0, 2.0, 3.0])]
    fine = [(8, [-0.0001, 0.5]), (None, [0.25, 0.25]), (8, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows + fine + [(9, big)]], NAMES)
    out = ce.clustered(df, dims=2)
    assert [f.name for f in out.schema] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r)[0], tuple(r)[2]) for r in out.collect() if r.vec_id) == [(8, 0), (8, 0)]
    assert [r.distance for r in out.collect() if r.vec_id is None] == [0] and out.count() == 3
    assert ce.clustered(df.filter("vec_id < 8"), dims=2).collect() == []
    assert ce.clustered(df.filter("false")).schema == ce.clustered(df.filter("false")).schema


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{TINY}/embeddings.parquet'")
    want = con.execute(ce.clustered_sql()).fetchall()
    assert got(spark.read.parquet(f"{TINY}/embeddings.parquet")) == sorted(want)
