"""Operator 13 against brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from footfall.llm import prefix_trie as pt

NAMES = "conv_id long, turn long, role string, text string, depth int"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) or 1
        saved[p] = sum(saved[q] for q in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(made[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), above, len(members[p]), len(below), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, parts=5, **how):
    df = spark.createDataFrame([(*r, 1) for r in rows], NAMES).repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = pt.prefix_trie(pt.rebuilt(pt.conversation_turns(df)), **how)
        assert found.columns == pt.RESULT
        return sorted((tuple(r) for r in found.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def random_rows(seed, n, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "system", f"text {rng.randint(0, words)} é" * rng.randint(0, 3)))
    return rows


@pytest.mark.parametrize("seed,n,longest,words,shard", [(1, 60, 12, 1, 10_000), (2, 120, 9, 2, 20), (3, 40, 90, 0, 30), (4, 80, 5, 50, 7)])
def test_random_conversations(spark, seed, n, longest, words, shard):
    rows = random_rows(seed, n, longest, words)
    assert got(spark, rows, shard_turns=shard) == brute(rows)


def test_a_third_alike_over_many_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 300, 5) for t in range(11)]
    rows += [(c, t, "user", f"turn {t}") for c in range(1, 400, 5) for t in range(11)] + random_rows(9, 60, 6, 3)
    assert got(spark, rows, parts=13, shard_turns=25) == brute(rows)


def test_ids_of_many_ends_come_in_chunks(spark, monkeypatch):
    rows = [(c, t, "user", "x") for c in range(0, 2000, 5) for t in range(10)]
    want = brute(rows)
    assert got(spark, rows, parts=4) == want
    paths = ["a" * 32] * 100
    monkeypatch.setattr(pt, "CHUNK", 60)
    parts = list(pt.Shard(np.arange(100), paths, np.ones(100, np.int64)).parts(0))
    assert len(parts[-1]["ids"]) == 34 and ",".join(parts[-1]["ids"]) == ",".join(map(str, range(100)))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (3, None, "user", "first"), (3, 1, None, None), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a")]
    rows += [(c, 0, "user", "only") for c in (7, 8, 11, 12, 13)] + [(4, t, "user", "x" * 100_000) for t in range(12)]
    rows += [(15, t, "user", str(t)) for t in range(3)] + [(c, t, "u", "v") for c in (16, 17, 18, 19) for t in range(9)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    turnless = next(c for c in range(21, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    assert got(spark, [(turnless, 0, "user", "x")]) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    want = con.execute(pt.conversation_trie_sql()).fetchall()
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert sorted(want, key=str) == brute(rows)
    assert got(spark, rows) == brute(rows)
