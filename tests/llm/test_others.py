"""Operators 3, 5, 9 and 10 and the pipeline."""

import html
import re
import time

import duckdb
import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import decontamination as dec
from footfall.llm import html_text as ht
from footfall.llm import mixing as mix
from footfall.llm.neighbours import nearest_neighbours

SF, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def exact(ids, x, top=10):
    out = {}
    for i in np.flatnonzero(ids % 100 == 0):
        score = np.sqrt(((x - x[i]) ** 2).sum(1))
        at = np.flatnonzero(ids != ids[i])
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in at[np.lexsort((ids[at], score[at]))][:top]]
    return out


def test_neighbours_recall_and_scores(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    ids, x = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), np.float64)
    got = nearest_neighbours(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()
    true, hits = exact(ids, x), 0
    for r in got:
        hits += r.vec_id in dict(true[r.query_id])
        assert r.score == np.sqrt(((x[ids == r.vec_id][0] - x[ids == r.query_id][0]) ** 2).sum())
    assert hits >= 0.9 * sum(map(len, true.values()))
    assert {r["rank"] for r in got} == set(range(1, 11))


def test_neighbours_odd_vectors(spark):
    rows = [(i, [1.0, 2.0], 1) for i in range(200, 240)] + [(0, [1.0, 2.0], 1), (100, [5.0, 5.0], 1), (100, [5.0, 5.0], 1)]
    rows += [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [1.0, float("nan")], 1), (5, [1.0, float("inf")], 1), (None, [1.0, 2.0], 1), (6, [1.0, 2.0, 3.0], 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = nearest_neighbours(docs).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got if r.query_id == 0] == list(range(200, 210))
    assert [r.vec_id for r in got if r.query_id == 100] == [0, *range(200, 209)]
    assert [r.vec_id for r in got if r.query_id == 200] == [0, *range(201, 210)]
    assert nearest_neighbours(docs.filter("false")).collect() == []


def test_neighbours_of_repeated_rows(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 31)] * 2 + [(100, [0.0, 1.0])] * 2  # every row twice
    rows += [(5000, [-50.0, 1.0])] * 12 + [(i, [-50.0, 1.0]) for i in range(5001, 5012)] + [(6000, [-50.0, 1.0])]  # one id, many rows
    rows += [(7001, [500.0 + i, 0.0]) for i in range(50)] + [(7000, [500.0, 1.0])] + [(i, [600.0 + i - 7010, 0.0]) for i in range(7010, 7020)]  # one id, many vectors
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), share=1.0).orderBy("query_id", "rank").collect()
    of = lambda q: [r.vec_id for r in got if r.query_id == q]
    assert of(100) == list(range(1, 11))
    assert of(6000) == list(range(5000, 5010))
    assert of(7000) == [7001, *range(7010, 7019)]


ITEM = "Anna Berg buys 12 apples and 5 pears for 30 dollars, then sells 7 apples. How many apples are left over for the winter?"


def overlap(spark, texts, items):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return docs, bench, {(r.doc_id, r.item_id) for r in dec.benchmark_overlap(docs, bench).collect()}


def test_reparameterised_questions(spark):
    other = "Once there, Carla Lind buys 40 apples and 6 pears for 99 dollars, then sells 3 apples. How many apples are left over for the winter? Done."
    mixed = ITEM.replace("12 apples", "7 apples").replace("7 apples.", "5 apples.")  # 12 -> 7, 7 -> 5, 5 -> 5
    same = "Eva Holm buys 8 apples and 8 pears for 8 dollars, then sells 8 apples. How many apples are left over for the winter?"
    texts = [f"pad {ITEM} end", other, "How many apples are left over today?", None, "", "x " * 200_000 + ITEM, same, mixed]
    docs, bench, got = overlap(spark, texts, [ITEM, "too short", None, ""])
    assert got == {(0, 0), (1, 0), (5, 0), (6, 0), (7, 0)}
    left = dec.without_benchmark(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    assert overlap(spark, [], [ITEM])[2] == set() and overlap(spark, texts, [])[2] == set()


def test_two_slots_of_an_item_may_meet_one_value(spark):
    item = "A baker sells 12 loaves and 15 rolls before noon, then bakes 12 loaves more. How many loaves did the baker sell?"
    alike = item.replace("12", "9").replace("15", "9")
    apart = item.replace("12", "9", 1).replace("12", "10").replace("15", "11")
    assert overlap(spark, [item, alike, apart], [item])[2] == {(0, 0), (1, 0)}


def test_copies_of_short_and_literal_poor_items(spark):
    items = ["What is 12 + 30 + 45 - 7?", "Name the planet", "What is the capital of France?", "Anna Berg walks to the old town"]
    texts = [f"Some pad. {t} And more" for t in items] + ["Question: What is the capital of France?", 'He asked "What is the capital of Peru?" twice']
    texts += ["She said that Carla Lind walks to the old town", "What is 12 + 30 + 45 - 8?", "What was the planet", "planet the Name"]
    assert overlap(spark, texts, items)[2] == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 2), (5, 2), (6, 3)}


def test_benchmark_bitmap_is_not_pulled_row_by_row(spark, monkeypatch):
    def refused(self, *a, **b):
        raise AssertionError("driver loop over rows")

    monkeypatch.setattr(type(spark.range(0)), "toLocalIterator", refused)
    assert overlap(spark, [f"pad {ITEM} end", "else"], [ITEM, "no match here"])[2] == {(0, 0)}


def test_verbatim_items_equal_plain_search(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in dec.benchmark_overlap(docs, bench).collect()}
    want = {(d.doc_id, b.item_id) for b in bench.collect() for d in docs.filter(F.contains("text", F.lit(b.text))).collect()}
    assert want and got == want


def test_pages_equal_their_articles(spark):
    rows = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in ht.page_texts(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for r in rows:
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert got[r["page_id"]].text == "\n".join(filter(None, blocks))
        assert got[r["page_id"]].n_chars == len(got[r["page_id"]].text) and got[r["page_id"]].url == r["url"]


def test_site_tree_removes_what_pages_share(spark):
    page = '<body><div class=top><span>Same strap line</span></div><div class=x{n}><div>Own words {i} &amp; more</div><p>Copied</p></div><div id="cookie-box">ok?</div></body>'
    rows = [(i, "http://a.example/x", page.format(i=i, n=""), "h") for i in range(6)] + [(9, None, None, "h"), (10, "no url", "", "h"), (10, "no url", "", "h")]
    rows += [(11, "https://b.example/", "<main><ul><li>One<li>Two</ul>Three<br>four<table><tr><td>c<td>d</table></main><p>out" + "<i>" * 3000, "h")]
    got = sorted((r.page_id, r.text) for r in ht.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect())
    assert got == [*((i, f"Own words {i} & more\nCopied") for i in range(6)), (9, ""), (10, ""), (10, ""), (11, "One\nTwo\nThree four\nc\nd")]
    assert ht.page_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_shortages_go_to_siblings_first(spark):
    rows = [("a", "en", "a1", 100), ("a", "en", "a2", 1000), ("a", "de", "a3", 1000), ("b", "en", "b1", 5000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    plan = mix.Plan(weights={}, epochs=1, share=0.4)  # 2840: 1420 a domain, 710 a language, 355 a source
    got = {r.source: r.budget for r in mix.budgets(leaves, plan).collect()}
    assert got == {"a1": 100, "a2": 610, "a3": 710, "b1": 1420}
    got = {r.source: r.budget for r in mix.budgets(leaves, mix.Plan(weights={"lang": {"en": 9}}, epochs=1, share=0.6)).collect()}
    assert got == {"a1": 100, "a2": 1000, "a3": 1000, "b1": 2160}  # language a/en is full, then domain a


def test_mixture_equals_its_sql(spark):
    con = duckdb.connect()
    for name, sql in (("plan", mix.mixture_sql(f"read_parquet('{SF}/documents.parquet')")), ("even", mix.mixture_sql(f"read_parquet('{SF}/documents.parquet')", mix.Plan({}, 3, 1.5, "s")))):
        want = con.sql(sql).df()
        got = mix.mixture(spark.read.parquet(f"{SF}/documents.parquet"), None if name == "plan" else mix.Plan({}, 3, 1.5, "s")).drop("text_hash").toPandas()
        key = ["doc_id", "epoch"]
        want, got = (f[sorted(f.columns)].sort_values(key).reset_index(drop=True) for f in (want, got))
        assert len(want) > 100 and want.astype(str).equals(got.astype(str))


def test_mixture_of_odd_rows(spark):
    rows = [(1, None, None, None, 0), (2, "", "en", "s1", 0), (3, "one two", None, None, 0), (3, "one two", None, None, 0), (None, "a b c", "en", "s1", 0), (4, "w " * 100_000, "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch int")
    got = mix.mixture(docs, mix.Plan({}, 1, 1.0)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 3), (3, 2), (3, 2), (4, 100_000)]
    assert mix.mixture(docs.filter("false")).collect() == []


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    more = docs.limit(3).unionByName(docs.sparkSession.createDataFrame([(None, None, None, None, None), (None, "lone words", "en", "s", 10)], docs.schema))
    docs = docs.unionByName(more)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, TINY)
        path = str(tmp_path / name)
        out.write.parquet(path)
        kept[name] = spark.read.parquet(path)
        if name != "mixing":
            assert kept[name].schema == docs.schema
            docs = kept[name]
    n = {k: v.count() for k, v in kept.items()}
    assert n["near_copies"] < n["toxicity"] <= 205 and n["decontamination"] <= n["near_copies"] and n["secrets"] == n["decontamination"]
    ids = [r.doc_id for r in kept["near_copies"].select("doc_id").collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids))  # repeated rows went
    assert kept["near_copies"].filter("doc_id is null").count() == 2
    assert kept["mixing"].count() > 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, TINY).collect() == []


def test_copies_and_inline_elements_keep_article_text(spark):
    said = ["first words", "first words", "second words", "third words"]
    pages = {"bold": "<article><p><b>{}</b></p></article>", "div": "<article><div>{}</div><div>Share this</div></article>"}
    pages |= {"list": "<article><ul><li>{}</li></ul></article>", "plain": "<div>{} <i>and more</i></div>"}
    rows = [(i, f"http://{name}.example/{i}", page.format(t)) for name, page in pages.items() for i, t in enumerate(said)]
    got = {r.url: r.text for r in ht.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, t in enumerate(said):
        assert [got[f"http://{name}.example/{i}"] for name in pages] == [t, t, t, f"{t} and more"]


def test_list_of_an_article_goes_only_where_it_repeats(spark):
    page = "<article><p>Story {i}</p><ul><li>{t}</li></ul></article>"
    rows = [(i, "http://a.example/", page.format(i=i, t="Read more" if i else "Found nowhere else")) for i in range(9)]
    got = {r.page_id: r.text for r in ht.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "Story 0\nFound nowhere else", **{i: f"Story {i}" for i in range(1, 9)}}


def text_of(spark, pages, host="a"):
    rows = [(i, f"http://{host}.example/{i}", p) for i, p in enumerate(pages)]
    got = ht.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_suspicious_wrappers_keep_what_they_hold(spark):
    said = "The first paragraph of a story about rivers and mills."
    wrappers = [
        '<body><form id="aspnetForm" action=x><div class=nav>Home</div><div><p>{}</div></form>',
        '<div class="page has-sidebar"><div><p>{}</div><div class="sidebar">Top ten</div></div>',
        '<div class=menu>Home</div><div id="social-history"><p>{}</p></div>',
        '<article><div class="menu-item-text">{}</div></article>',
    ]
    for k, page in enumerate(wrappers):
        assert text_of(spark, [page.format(said)], f"one{k}") == [said]
        many = [f"Story {i} tells of mill number {i} and of its river, at length." for i in range(5)]
        assert text_of(spark, [page.format(t) for t in many], f"many{k}") == many


def test_what_a_site_repeats_stays_out_though_it_is_all_there_is(spark):
    page = "<div class=cookie>We use cookies, as every page says</div><article>{}</article>"
    assert text_of(spark, [page.format(t) for t in ("", "one", "two")]) == ["", "one", "two"]
    page = "<div class=cookie>We use cookies, as every page says</div><div>{}</div>"
    assert text_of(spark, [page.format(t) for t in ("", "one", "two")], "b") == ["", "one", "two"]


def test_a_site_without_telling_names_loses_its_menus_by_entropy(spark):
    page = "<div class=a1><div>Start</div><div>Contact us</div></div><div class=b{n}><div>{t}</div></div><div class=c>All rights</div>"
    said = [f"Words of page {i} alone" for i in range(6)]
    assert text_of(spark, [page.format(n="x" * i, t=t) for i, t in enumerate(said)]) == said
    assert ht.main_text(ht.parse(page.format(n=1, t="Words")), set(), set()) != "Words"  # the tree, not the names


def test_deep_pages_are_read_in_proportion():
    t0 = time.monotonic()
    for source in ("<div>" * 60_000 + "x", "<p>" + "<b><i>" * 30_000 + "x", "<ul>" + "<div></li>" * 30_000 + "x", "<span></p></em>" * 30_000 + "x"):
        assert ht.main_text(ht.parse(source), set(), set()) == "x"
    assert time.monotonic() - t0 < 30
