"""Operators 4 and 7 against Python's re, operator 8 against plain search."""

import hashlib
import random
import re
import time

import pyarrow.parquet as pq

from footfall.llm import licenses as lic
from footfall.llm import personal_data as pii
from footfall.llm import secrets as sec

SF = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_pii(text):
    out = []
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    for kind, pattern, ok in rules:
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text or "") if ok(m[0])]
    return out


def brute_secrets(text):
    out = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text or "", re.I | re.A) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return [(sec.RULES[r][0], a, b) for a, r, b in sorted(out)]


def digest(spans):
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return joined, hashlib.sha256(joined.encode()).hexdigest()


def texts(parts, n, seed):
    rng = random.Random(seed)
    own = pq.read_table(f"{SF}/documents.parquet", columns=["text"])["text"].to_pylist()
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]
    return own + made + [None, "", " ", "0" * 20_000, "1 " * 10_000, "a" * 60_000 + "@b.c" + ".d" * 8000, "1.2.3.4 " * 300, made[0]]


def test_base_personal_data(spark):
    all_ = texts(["a", "b.c", "@", ".", "1", "22", "256", "4", "0", " ", "-", "+4", "(", ")", "é", "\n", "x@y.z", "1.2.3.4", "4111111111111111", "_", "😀"], 1500, 1)
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(all_)], "doc_id long, text string, base string")
    for r in pii.personal_digests(docs).collect():
        want = brute_pii(all_[r.doc_id])
        joined, sha = digest(want)
        assert r.base_sha256 == sha, (all_[r.doc_id][:80], joined[:200], r.spans[:200])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in ("email", "ip", "card", "phone")]
        assert r.spans.startswith(joined)


def test_patterns_reveal_unseen_identifiers(spark):
    said = [f"plain text here\nkontakt: user{i}@mail.example.com and more" for i in range(8)]
    said += ["kontakt: AB-99120034 follows", "the AB-99120035 follows", "the word the next"]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert [(s.kind, said[8][s.start : s.end]) for s in got[8].context] == [("context", "AB-99120034")]
    assert not got[9].context and not got[0].context
    assert pii.personal_digests(docs.filter("false")).collect() == []


def test_entities_with_blanks_are_seeds(spark):
    said = [f"call now. Tel: +1 (017) 555-77{i:02} or so" for i in range(8)] + [f"Konto 4111 1111 1111 1111, {i}" for i in range(2)]
    said += ["Tel: 0301234567 follows", "x Tel: " + "AB-" * 40 + "99120034 end", "Konto 12345678", "see 0301234568"]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    got = {r.doc_id: [said[r.doc_id][s.start : s.end] for s in r.context] for r in pii.personal_data(docs).collect()}
    assert {k: v for k, v in got.items() if v} == {10: ["0301234567"], 11: ["AB-" * 40 + "99120034"]}


def brute_context(said):
    """Context spans by a plain walk: labels, a bipartite graph, three rounds."""
    sep, word = "[ \t\"'(]{1,3}", r"[^\W\d]+[:=#]?"
    label = re.compile(rf"(?<![^\W\d])({word}){sep}")
    seen, totals = [], {}
    for d, text in enumerate(said):
        for w in re.findall(word, text.lower()):
            totals[w] = totals.get(w, 0) + 1
        base = brute_pii(text)
        at = {}
        for _, a, b in base:
            for m in label.finditer(text, 0, a):
                if m.end() == a or (m.end() == a - 1 and text[a - 1] == "+"):
                    at.setdefault(m.end(), (m[1].lower(), text[a:b], a, b, True))
        pos = 0
        while m := label.search(text, pos):
            t = re.compile(r"\+?[A-Za-z0-9][A-Za-z0-9@._%+/-]{5,}").match(text, m.end())
            if not t or not re.match("[A-Za-z._%+/-]*[0-9@]", t[0]):
                pos = m.start() + 1
                continue
            token = t[0].rstrip("._%+/-")
            if "@" in token or sum(c.isdigit() for c in token) >= 4:
                at.setdefault(m.end(), (m[1].lower(), token, m.end(), m.end() + len(token), False))
            pos = t.end()
        seen += [(d, *v, any(a < v[3] and b > v[2] for _, a, b in base)) for v in at.values()]
    n, seed = {}, {}
    for _, before, token, _, _, is_seed, _ in seen:
        n[before, token] = n.get((before, token), 0) + 1
        seed[token] = seed.get(token, False) or is_seed
    confidence = {t: float(s) for t, s in seed.items()}
    for _ in range(pii.ROUNDS):
        sure = {}
        for p in {b for b, _ in n}:
            own = {t: k for (b, t), k in n.items() if b == p}
            score = sum(k * confidence[t] for t, k in own.items()) / max(totals.get(p, 0), sum(own.values()))
            if score >= pii.CONFIDENT and sum(confidence[t] >= pii.CONFIDENT for t in own) >= pii.SUPPORT:
                sure[p] = score
        doubt = {}
        for b, t in n:
            if b in sure:
                doubt[t] = doubt.get(t, 1.0) * (1 - min(sure[b], 1.0) * pii.TRUST)
        confidence = {t: 1.0 if s else 1 - doubt.get(t, 1.0) for t, s in seed.items()}
    out = {d: set() for d in range(len(said))}
    for d, before, token, a, b, _, met in seen:
        if before in sure and not met and not seed[token] and confidence[token] >= pii.CONFIDENT:
            out[d].add((a, b))
    return {d: sorted(v) for d, v in out.items()}


def labelled(n, seed):
    """Texts of which some hold an identifier behind a telling label, others a
    number behind a word that also stands elsewhere; and where the identifiers are."""
    rng = random.Random(seed)
    said, true = [], {}
    for d in range(n):
        parts, spans = [], []
        for _ in range(rng.randint(1, 6)):
            pick, label = rng.random(), rng.choice(["mail:", "Tel:", "kontakt", "id#"])
            if pick < 0.6:
                new = f"{label} " + rng.choice([f"user{rng.randint(0, 40)}@mail.example.org", f"+49 30 {rng.randint(1000000, 9999999)}"])
            elif pick < 0.67:
                token = f"KD-{rng.randint(10**6, 10**7)}"
                at = sum(map(len, parts)) + 3 * len(parts) + len(label) + 1
                spans.append((at, at + len(token)))
                new = f"{label} {token}"
            else:
                new = rng.choice(["room 123456", "room with a view", "the year 20011 was", "order 99/88/7766 came", "room for all"])
            parts.append(new)
        said.append(" , ".join(parts))
        true[d] = spans
    return said, true


def test_context_against_a_plain_walk(spark):
    said, true = labelled(400, 7)
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: sorted((s.start, s.end) for s in r.context) for r in pii.personal_data(docs).collect()}
    assert got == brute_context(said)
    hits = sum(s in got[d] for d, spans in true.items() for s in spans)
    assert hits >= 0.95 * sum(map(len, true.values())) and hits >= 0.95 * sum(map(len, got.values()))


def test_context_of_repeated_rows_and_missing_ids(spark):
    said = [f"Tel: +1 (017) 555-77{i:02} or so" for i in range(40)] + ["Tel: 0301234567 follows"]
    rows = [(i, t) for i, t in enumerate(said)] + [(None, said[40])] * 2 + [(40, said[40])] + [(None, None), (8, "")]
    got = pii.personal_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert sorted(str(r.doc_id) for r in got if "context:5:15" in r.spans) == ["40", "40", "None", "None"]


def test_long_texts_are_walked_in_proportion(spark):
    long = [" ".join(f"10.0.{i % 256}.{i % 200}" for i in range(80_000)), "1 " + "a(" * 500_000, "mail: u@x.org " * 70_000]
    t0 = time.monotonic()
    got = pii.personal_digests(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")).collect()
    assert time.monotonic() - t0 < 120
    assert {r.doc_id: (r.n_ip, r.n_email) for r in got} == {0: (80_000, 0), 1: (0, 0), 2: (0, 70_000)}


def test_base_secrets(spark):
    all_ = texts(["token", "Secret", "api_key", "=", ":", " ", '"', "'", "ab", "0", "f", "AKIA", "Z", "9", "é", "\n", "abcdef0123456789", ".", "K", "ghp_" + "a" * 40, ","], 1500, 2)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(all_)], "doc_id long, text string, secrets int")
    for r in sec.secret_digests(docs).collect():
        want = brute_secrets(all_[r.doc_id])
        assert r.base_sha256 == digest(want)[1], all_[r.doc_id][:200]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for k, _, _ in want) for kind in ("assign", "access", "hex")]
    assert sec.secret_digests(docs.filter("false")).collect() == []


def test_other_formats_and_masks(spark):
    key = "ghp_" + "aB3" * 12
    docs = spark.createDataFrame([(1, f"é {key}, token={key}!"), (2, "clean"), (3, None)], "doc_id long, text string")
    found = sec.secrets(docs)
    out = {r.doc_id: r for r in sec.masked_texts(found).collect()}
    assert [(s.kind, s.start) for s in out[1].secrets] == [("github", 2), ("assign", 44), ("github", 50)]
    assert out[1].masked == f"é {sec.MASK}, {sec.MASK}!" and out[2].masked is None and out[3].masked is None


def test_license_notices_equal_plain_search(spark):
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    rows += [{"doc_id": 10**6 + i, "text": t} for i, t in enumerate([None, "", "mit", "word " * 100_000 + lic.TEMPLATES["mit-notice"]])]
    rows += [{"doc_id": 10**6 + 10 + i, "text": f"{'pad ' * i}{lic.TEMPLATES['bsd']}{' end' * i}"} for i in range(40)]
    docs = spark.createDataFrame([(r["doc_id"], r["text"], "x") for r in rows], "doc_id long, text string, license string")
    got = {(r.doc_id, r.license) for r in lic.licenses(docs).collect() if r.containment == 1.0}
    flat = lambda s: f" {' '.join(re.findall(r'\w+', (s or '').lower()))} "
    want = {(r["doc_id"], name) for r in rows for name, t in lic.TEMPLATES.items() if flat(t) in flat(r["text"])}
    assert len(want) > 60 and got == want
    assert lic.licenses(docs.filter("false")).collect() == []


def test_license_with_changes_is_verified_by_containment(spark):
    words = lic.TEMPLATES["mit"].split()
    few, many = list(words), list(words)
    few[20] = "else"
    many[::6] = ["else"] * len(many[::6])
    docs = spark.createDataFrame([(1, "x " * 50 + " ".join(few)), (2, " ".join(many))], "doc_id long, text string")
    got = [(r.doc_id, r.license, r.containment >= 0.8) for r in lic.licenses(docs).collect()]
    assert got == [(1, "mit", True)]


def test_bands_guarantee():
    assert (1 - 0.5**lic.ROWS) ** lic.BANDS <= lic.MISS


def test_places_in_texts_that_are_not_ascii():
    text = "é secret=abcdefgh1 😀 " * 30_000
    t0 = time.monotonic()
    spans = sec.find(sec._scanner(), [text])[0]
    assert time.monotonic() - t0 < 60 and len(spans) == 30_000
    assert all(text[a:b] == "secret=abcdefgh1" for _, a, b in spans)


def test_masks_of_many_and_overlapping_spans():
    assert sec.mask("abcdef", [("a", 1, 3), ("b", 2, 4), ("c", 4, 5), ("d", 1, 2)]) == f"a{sec.MASK}{sec.MASK}f"
    n = 100_000
    began = time.monotonic()
    out = sec.mask("é" * 10 * n, [("a", 10 * i, 10 * i + 9) for i in range(n)])
    assert out == (sec.MASK + "é") * n and time.monotonic() - began < 5
