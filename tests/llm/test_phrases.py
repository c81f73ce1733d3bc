"""Operator 12 against a plain parse."""

import hashlib
import random

import numpy as np

from footfall.llm import phrases as ph

SF = "/root/testdata/sf0.001"


def plain_phrases(text):
    seen, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen


def plain_mix(h):
    m = (1 << 64) - 1
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & m
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & m
    return h ^ (h >> 31)


def plain_mark(text):
    least = {}
    for p in plain_phrases(text):
        h = plain_mix((sum((ord(c) + 1) * pow(ph.BASE, i, 1 << 64) for i, c in enumerate(p)) + len(p)) % (1 << 64))
        least[h >> 57] = min(h, least.get(h >> 57, h))
    return [plain_mix(least[b]) % ph.NONE if b in least else ph.NONE for b in range(ph.BINS)]


def brute(rows):
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), in order."""
    order, out = sorted(rows, key=lambda r: r[0]), []
    near = lambda a, b: 1.0 if a == b == [ph.NONE] * ph.BINS else sum(x == y != ph.NONE for x, y in zip(a, b)) / sum(x != ph.NONE or y != ph.NONE for x, y in zip(a, b))
    hexed = lambda m: np.array(m, np.uint16).tobytes().hex()
    for i, (doc_id, text) in enumerate(order):
        follower = order[(i + 1) % len(order)][1]
        k = len(text) // 4
        edited = text[: len(text) - k] + follower[:k]
        own, new, then = plain_mark(text), plain_mark(edited), plain_mark(follower)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(new), near(own, new), near(own, then)))
    return out


def got(df):
    return sorted((tuple(r) for r in ph.phrase_fingerprints(df).collect()), key=str)


def test_whole_documents_against_a_plain_parse(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 3000")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(docs.repartition(5)) == sorted(brute(rows), key=str)


def test_odd_texts(spark):
    rows = [(5, ""), (1, None), (2, "a"), (3, "aé😀b" * 50), (4, "aé😀b" * 50), (9, "\x00\n\t " * 9), (8, "abcd"), (7, "xyz" * 4000)]
    df = spark.createDataFrame([(i, t, "f", "m") for i, t in rows], "doc_id long, text string, fingerprint string, mark string")
    assert got(df) == sorted(brute([(i, t or "") for i, t in rows]), key=str)
    by = {r.doc_id: r for r in ph.phrase_fingerprints(df).collect()}
    assert by[3].fingerprint == by[4].fingerprint and by[3].near_next == 1.0
    assert ph.phrase_fingerprints(df.filter("false")).collect() == []
    one = ph.phrase_fingerprints(df.filter("doc_id = 8")).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(4, 1.0)]


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "one two three")] * 5 + [(2, "four five six")] + [(None, "zero one")] * 2 + [(2, "another text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = ph.phrase_fingerprints(df).collect()
    assert sorted((r.doc_id for r in out), key=str) == sorted((r[0] for r in rows), key=str)
    # A repeated row follows itself, its last copy is followed by the next text.
    assert sorted(r.near_next == 1.0 for r in out if r.doc_id == 1) == [False] + [True] * 4
    assert sorted(r.near_next == 1.0 for r in out if r.doc_id is None) == [False, True]
    tail = lambda a, b: a[: len(a) - len(a) // 4] + b[: len(a) // 4]
    firsts = {hashlib.sha256(tail("zero one", t).encode()).hexdigest() for t in ("zero one", "one two three")}
    assert {r.edited_sha256 for r in out if r.doc_id is None} == firsts


def ends_of(text):
    codes, ends = ph._codes(text), []
    ph._read(codes, {}, 0, ends, 0)
    return codes, ends


def test_a_full_dictionary_starts_anew(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdef ") for _ in range(n)) for n in (900, 4000)]
    for size in (5, 40, 300):
        monkeypatch.setattr(ph, "PHRASES", size)
        for text in texts:
            doc = ph.Document(text)
            assert (doc.mark == ph.signature(ph.phrase_hashes(*ends_of(text)))).all()
            for head in (*texts, texts[0][::-1]):
                new, mark = doc.edited(head)
                assert new == text[: len(text) - len(text) // 4] + head[: len(text) // 4]
                assert (mark == ph.signature(ph.phrase_hashes(*ends_of(new)))).all()


def test_pieces_hash_alike(monkeypatch):
    codes, ends = ends_of("some words and some words again " * 300)
    whole = ph.phrase_hashes(codes, ends)
    monkeypatch.setattr(ph, "PIECE", 64)
    assert (ph.phrase_hashes(codes, ends) == whole).all()
    assert len(set(whole.tolist())) == len(ends)


def test_likeness_estimates_the_jaccard_similarity(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("n_chars between 800 and 3000").select("text").limit(60).collect()
    off, edited, other = [], [], []
    for a, b in zip(rows, rows[1:]):
        new = a.text[: len(a.text) * 3 // 4] + b.text[: len(a.text) // 4]
        for x, y, into in ((a.text, new, edited), (a.text, b.text, other)):
            p, q = plain_phrases(x), plain_phrases(y)
            found = float(ph.likeness(ph.Document(x).mark, ph.Document(y).mark))
            off.append(found - len(p & q) / len(p | q))
            into.append(found)
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.07
    assert np.median(edited) > 0.45 and np.mean(np.array(edited) > np.array(other)) > 0.9


def test_a_long_run_is_linear():
    codes, ends = ends_of("a" * 1_000_000)
    assert len(ends) < 1500 and ends[-1] <= len(codes)
