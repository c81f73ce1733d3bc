"""Operators 2 and 6: held-out accuracy and behaviour on odd texts."""

import numpy as np
import pyarrow.parquet as pq

from footfall.llm import language as lang
from footfall.llm import toxicity as tox
from footfall.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n "), (None, "12 34"), (3, " \n "), (8, "ab " * 200_000)]


def test_toxicity_learns_words_and_their_misspellings():
    rng = np.random.default_rng(0)
    plain = [f"{a}{b}" for a in ("an", "be", "co", "du") for b in ("lor", "min", "tas", "ver", "zek")]
    texts, labels = [], []
    for i in range(400):
        words = list(rng.choice(plain, 150))
        if i % 4 == 0:
            words[int(rng.integers(150))] = rng.choice(["gruffwit", "snarlhead"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    model = tox.train(texts[:300], np.array(labels[:300]))
    score = tox.Scorer(model)
    assert ((score(texts[300:]) >= tox.REJECT) == np.array(labels[300:], bool)).all()
    unseen, clean = score(["anlor comin gruffwitt duver", "anlor comin bever duver"])
    assert unseen > 2 * clean


def test_toxicity_does_not_depend_on_where_a_window_would_start():
    texts = ["gruffwit snarlhead"] * 8 + ["anlor comin duver betas"] * 8
    score = tox.Scorer(tox.train(texts, np.array([1] * 8 + [0] * 8)))
    pair = score([" ".join(["anlor"] * n + ["gruffwit", "snarlhead"] + ["anlor"] * (20 - n)) for n in range(21)])
    assert np.ptp(pair) < 1e-9 and score(["anlor " * 22])[0] < pair[0]
    long = " ".join(["gruffwit"] * 3 + ["anlor"] * 50)
    assert score([long])[0] == score(["snarlhead anlor", "", long, "a b"])[2]


def test_toxicity_query(spark):
    got = QUERIES["op2_toxicity"](spark, SF).toPandas()
    toxic = pq.read_table(f"{SF}/labels.parquet").to_pandas()[["doc_id", "toxic"]]
    assert len(got) == 1000 and got.score.between(0, 1).all()
    held = got[got.held_out].merge(toxic, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.93
    assert (got.predicted == (got.score >= 0.7)).all()


def test_toxicity_of_odd_texts_and_tables(spark):
    model = tox.train(["bad bad", "good good"] * 3, np.array([1, 0] * 3))
    docs = spark.createDataFrame([(*r, "kept") for r in ODD], "doc_id long, text string, SCORE string")
    got = tox.toxicity(docs, model).collect()
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len(got) == len(ODD) and len(empty) == 1 and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tox.toxicity_scores(none, labels).collect() == []
    assert all(r.predicted == 0 for r in tox.toxicity_scores(docs.select("doc_id", "text"), labels).collect())


def test_language_query(spark):
    got = QUERIES["op6_language"](spark, SF).toPandas()
    true = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "lang"]).to_pandas()
    held = got[got.held_out].merge(true, on="doc_id")
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() > 0.97


def test_language_backs_off_to_shorter_grams():
    model = lang.build([("aa", 0, "kala", 5), ("bb", 0, "mint", 5), ("aa", 3, "kal", 3), ("bb", 3, "min", 3), ("aa", 1, "z", 2), ("bb", 1, "q", 2)])
    of = lang.Identifier(model)(["kala mint kala", "kalq", "minor", "zzz", "qq", "12 !", ""])
    assert of[0] == ["aa", "aa", "bb", "aa", "bb", "und", "und"]


def test_language_of_odd_texts_and_tables(spark):
    docs = spark.createDataFrame([(*r, "en", 1.0) for r in ODD], "doc_id long, text string, lang string, score double")
    got = lang.languages(docs).collect()
    assert len(got) == len(ODD) and {r.lang_pred for r in got} <= {"en", "und"}
    assert sum(r.lang_pred == "und" for r in got) == 5
    assert lang.languages(docs.filter("false")).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in lang.languages(unlabelled).collect()} == {"und"}


def plain_language(model, text):
    """The language of a text, word by word."""
    total = np.zeros(len(model.langs))
    known = {n: set(table.tolist()) for n, (table, _) in model.grams.items()}
    words = lang.LETTERS(text.lower())
    for word in words:
        if word in model.words:
            total += model.word_logs[model.words[word]]
            continue
        for n in range(lang.LONGEST, 0, -1):
            hashes = [int(lang._hashes([g], n)[0][0]) for g in lang.grams(word, n)]
            hits = [h for h in hashes if h in known.get(n, ())]
            if hits:
                table, logs = model.grams[n]
                total += np.mean([logs[np.searchsorted(table, np.uint64(h))] for h in hits], axis=0)
                break
    return model.langs[int(np.argmax(total))] if words else "und"


def test_language_against_a_plain_walk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = lang.fit(docs.filter("doc_id % 4 = 0"), 40)
    texts = [r.text[:400] for r in docs.filter("doc_id % 4 = 1").select("text").limit(80).collect()]
    texts += ["qzxv wwkk", "Ünbekannt", "a", "", "1 2"]
    assert lang.Identifier(model)(texts)[0] == [plain_language(model, t) for t in texts]


def test_language_learns_the_labels_with_most_rows(spark):
    rows = [(i, f"word{'abcdefgh'[i % 3]} text", ["en", "de", f"dirty {i}"][i % 3]) for i in range(300)]
    model = lang.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), languages=2)
    assert model.langs == ["de", "en"]


def plain_toxicity(model, text):
    """Probability of label 1 of the most toxic window, word by word."""
    words = tox.words_of(text)
    if not words:
        return 1 / (1 + np.exp(-model.offset))
    each = model.words(words)
    most = max(sum(each[i : i + tox.WINDOW]) for i in range(max(1, len(words) - tox.WINDOW + 1)))
    return 1 / (1 + np.exp(-(model.offset + most / tox.WINDOW)))


def test_toxicity_against_a_plain_walk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 4000")
    model = tox.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), 60)
    got = tox.toxicity(docs.select("doc_id", "text").limit(120), model).collect()
    assert all(abs(r.score - plain_toxicity(model, r.text)) < 1e-6 for r in got)


def test_one_text_of_a_repeated_id_is_learnt(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tox, "train", lambda texts, labels: seen.append((texts, labels.tolist())))
    docs = spark.range(100_000).selectExpr("id % 10 as doc_id", "concat('text ', id % 20) as text")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(10)], "doc_id long, quality int, toxic int")
    tox.fit(docs, labels)
    assert len(seen[0][0]) == 10 and seen[0][1] == [i % 2 for i in range(10)]
