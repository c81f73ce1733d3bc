"""Operator 1 against all pairs of shingle sets."""

import random
import re
from math import comb

import pyarrow.parquet as pq
import pytest

from footfall.llm import near_copies as nc

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in least[find(i)] if d is not None]
        out.append((doc, min(ids) if ids and sets[i] else doc, links[i]))
    return sorted(out, key=str)


def variants(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(edits):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def rows():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    out = [(r["doc_id"], r["text"]) for r in table]
    more = variants(25, 120, 2, 1) + variants(12, 300, 4, 2) + ["Tiny one", "tiny  ONE!", "tiny two", "", "  ...", None, "a b c d e", "a b c d e"]
    out += [(1000 + i, t) for i, t in enumerate(more)] + [(1000, more[0]), (None, more[1]), (None, "lone text without an id")]
    return out


@pytest.mark.parametrize("block_rows", [1024, 4])
def test_links_and_classes_equal_all_pairs(spark, rows, block_rows, monkeypatch):
    monkeypatch.setattr(nc, "BLOCK_ROWS", block_rows)  # of the plan: hot buckets are cut into blocks
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, set_key string, class_id int")
    got = nc.near_copies(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)
    firsts = [r.class_key for r in got if r["first"] and r.class_key is not None]
    assert len(set(firsts)) == len({r.class_key for r in got if r.class_key is not None})


def test_empty_table(spark):
    assert nc.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pruning_bound_is_the_posterior():
    for n, least in zip((32, 64, 96, 128, 160), nc.least_matches(5, 32, 0.8, 1e-6)):
        tail = lambda m: sum(comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert tail(least) >= 1e-6 > tail(least - 1)


def test_hot_sets_and_hot_classes(spark):
    rng = random.Random(8)
    texts = ["the same text for a third of all the rows"] * 300 + variants(60, 200, 3, 5) + [""] * 200
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(100)]
    rows = list(enumerate(texts))
    got = nc.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)


def test_very_long_texts(spark):
    rng = random.Random(3)
    long = [f"w{rng.randrange(10**7)}" for _ in range(150_000)]
    near = list(long)
    for i in range(0, len(near), 100):
        near[i] = "changed"
    texts = [" ".join(long), " ".join(near), "word " * 200_000, "x" * 1_000_000]
    got = nc.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == [(0, 0, 1), (1, 0, 1), (2, 2, 0), (3, 3, 0)]
