"""Ranked search, main text and periodic runs, each against a plain version of its own."""

import hashlib
import math
import re
import zlib
from collections import Counter
from html import unescape

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import documents, empty, plain
from pyspark.sql import functions as F

from veriloom.llm import periodic, queries, ranked, tag_paths

# ---- periodic runs ------------------------------------------------------------------------------------


def brute_runs(ids):
    ids, out = list(ids), []
    for q in range(1, len(ids) // 3 + 1):
        i = 0
        while i + q < len(ids):
            j = i
            while j + q < len(ids) and ids[j] == ids[j + q]:
                j += 1
            block = ids[i:j + q]
            if j > i and len(block) >= max(24, 3 * q) and not any(block[r:] == block[:-r] for r in range(1, q)):
                out.append((i, len(block), q))
            i = max(j, i + 1)
    return sorted(out)


def sequences():
    plain_words = st.lists(st.integers(0, 3), max_size=80)
    planted = st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(2, 6), st.integers(0, 40))
    grown = planted.map(lambda p: (p[0] * p[1])[:max(1, len(p[0]) * p[1] - p[2])])
    return st.lists(plain_words | grown, max_size=5).map(lambda parts: [x for part in parts for x in part])


@settings(max_examples=200, deadline=None)
@given(sequences())
def test_runs_equal_brute_force(ids):
    found = periodic.runs_of(np.array(ids, dtype=np.int64))
    assert found == brute_runs(ids)
    kept = periodic.without_repeats(len(ids), found)
    assert [i for i in range(len(ids)) if kept[i]] == [i for i in range(len(ids)) if not any(s + q <= i < s + n for s, n, q in found)]


@pytest.mark.parametrize("period", [1, 8, 9, 13, 14, 100, 1234, 20_000])
def test_long_periods(period):
    rng = np.random.default_rng(period)
    ids = np.concatenate([rng.integers(0, 9000, 500) + 10_000, np.tile(rng.integers(0, 9000, period), 30 if period < 9 else 3), rng.integers(0, 9000, 700) + 20_000])
    assert [r for r in periodic.runs_of(ids)] == [(500, period * (30 if period < 9 else 3), period)]


def brute_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    top = min(runs, key=lambda r: (-(10 ** 12 * r[1] // r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, top[0] if top[0] is None else 1000 * top[1] // top[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapsed))


def test_periodic_query_on_the_table(spark, sf):
    got = queries.op13_periodic_runs(spark, sf)
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    rows = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 2500").select("doc_id", "text").collect()
    want = {r.doc_id: brute_digest(r.doc_id, r.text) for r in rows}
    assert {r.doc_id: tuple(r) for r in got.collect() if r.doc_id in want} == want and sum(w[1] > 0 for w in want.values()) > 5


def test_periodic_odd_rows(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = plain(queries.op13_periodic_runs(spark, str(tmp_path)))
    assert [r for r in got if r[0] != 4] == sorted([brute_digest(r.doc_id, r.text) for r in documents(spark).where("coalesce(doc_id, 0) <> 4").collect()], key=repr)
    assert periodic.find(empty(spark)).count() == 0
    found = {r.doc_id: r for r in periodic.find(documents(spark)).collect()}
    assert found[1].n_words == 0 and found[1].runs == [] and found[1].collapsed == ""
    assert [tuple(r) for r in found[4].runs] == sorted([(0, 12060, 201), *((201 * i, 200, 5) for i in range(60))])
    assert found[5].collapsed == "One two, three four five." and [tuple(r) for r in found[5].runs] == [(0, 60, 5)]


# ---- ranked search ------------------------------------------------------------------------------------


def brute_search(docs, items, k=20):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(split(t))) for i, t in docs]
    n_docs, words = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for w, x in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            n = sum(c.values())
            score = sum(q * weight[w] * ((1000000000 * c[w]) // (1000 * c[w] + 12 * (75 + (25 * n * n_docs) // words))) for w, q in Counter(split(text)).items() if w in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


ASK = [(1, "one two Three!"), (2, "lorem lorem IPSUM call"), (3, None), (4, ""), (5, "nothinglikethis"), (6, "é b c 14 x its"), (7, "one two Three!"), (7, "here at all")]


@pytest.mark.parametrize("entries,block", [(2_000_000, 200_000), (1, 200_000), (5, 8)])
def test_search_equals_brute_force(spark, entries, block):
    docs = documents(spark).repartition(3)
    items = spark.createDataFrame(ASK, "item_id bigint, text string").withColumn("rank", F.lit("x")).withColumn("score", F.lit("y"))
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], ASK, 3)
    assert plain(ranked.search(docs, items, 3, entries=entries, block_terms=block)) == want
    assert plain(ranked.search(empty(spark), items)) == [] == plain(ranked.search(docs, items.limit(0)))


def test_search_resolves_ties(spark):
    rows = [(i, f"alpha beta {'gamma ' * (i % 3)}") for i in range(400, 0, -1)] + [(i, "alpha") for i in range(401, 900)]
    ask = [(1, "alpha gamma"), (2, "alpha alpha beta"), (3, "alpha")]
    got = ranked.search(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), spark.createDataFrame(ask, "item_id bigint, text string"), entries=100)
    assert plain(got) == brute_search(rows, ask)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 12))
def test_reading_stops_with_exact_scores(seed, k):
    rng = np.random.default_rng(seed)
    size, distinct = 60, 9
    pairs = sorted({(int(t), int(d)) for t, d in zip(rng.integers(0, distinct, 300), rng.integers(0, size, 300))})
    numbers, docs = map(np.array, zip(*pairs))
    values = rng.integers(1, 1 << rng.integers(1, 40), len(pairs))
    query = ranked.Query(0, list(range(0, distinct, 2)), [1, 2, 1, 3, 1])
    found, scores = ranked.best(ranked.lists(numbers, docs, values, size, distinct), query, k)
    exact = Counter()
    for t, d, v in zip(numbers.tolist(), docs.tolist(), values.tolist()):
        if t % 2 == 0:
            exact[d] += v * query.times[t // 2]
    want = sorted(((-s, d) for d, s in exact.items()))[:k]
    assert sorted(zip((-scores).tolist(), found.tolist()))[:k] == want


# ---- main text ------------------------------------------------------------------------------------------


def article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(unescape(re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", inner))).split())


def test_main_text_of_the_table(spark, sf):
    rows = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op12_main_text(spark, sf).collect():
        assert r.text == article(rows[r.page_id].html) and r.url == rows[r.page_id].url and r.n_chars == len(r.text)


PAGE = """<!doctype html><html><head><title>No title</title><script>if (a < b) document.write("<p>no</p>")</script></head>
<body class="page with-sidebar comments-open"><header><a href=/>Site name</a></header>
<div class="cookie-notice">We use cookies, on all pages.</div>
<div id=menu><ul><li><a href=1>Home<li><a href=2>News</ul></div>
<div class="content"><h1>A storm, at last</h1><p>It rained   all night&comma; and the river&nbsp;rose, they said. <b>Bold</b>ly, too.<p>Nobody came &lt;home&gt; before noon, and then
the sun came out: slowly, then at once. <a href=x>A link</a> stays.</p><ul><li>One.<li>Two, three.</ul>
<form><label>Mail</label><input name=x><button>Send</button></form><blockquote>"So it was", said she.</blockquote></div>
<aside><p>Also read, today: other things, as good as these.</p></aside>
<div class="links"><a href=1>One</a> <a href=2>Two</a></div><div class="links"><a href=3>Three</a></div>
<section id="comments"><p>First, I like this, really. And more, much more, as it is.</p></section><footer>All rights reserved.</footer></body></html>"""


def test_main_text_of_a_page():
    assert tag_paths.main_text(PAGE) == ("A storm, at last It rained all night, and the river rose, they said. Boldly, too. Nobody came <home> before noon, and then "
                                         "the sun came out: slowly, then at once. A link stays. One. Two, three. \"So it was\", said she.")


def test_ratios_alone_find_the_article():
    body = " ".join(f"<p>Sentence {i}, with a comma; and it goes on for a while, as texts do.</p>" for i in range(12))
    page = f"<body><div><div><span>Home</span></div><div>News</div><div>Sport</div></div><div><section><h2>Head</h2>{body}</section></div><table><tr><td>x<td>y</table></body>"
    text = tag_paths.main_text(page, trusting=False)
    assert text.startswith("Head Sentence 0,") and text.endswith("as texts do.") and "Sport" not in text


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("plain, text", "plain, text"), ("<p>cut &amp; <b>o", "cut & o"), ("<p>cut <a hre", "cut"), ("a<br>b<!-- c", "a b"),
                                       ("<nav>menu", ""), ("<script>x", ""), ("</p></div>x<div>y", "x y"), ("1 < 2 <3", "1 < 2 <3"), ("&amp &am &#65;&#x42;", "& &am AB")])
def test_main_text_odd_pages(page, text):
    assert tag_paths.main_text(page or "") == text


def test_main_text_odd_rows(spark):
    pages = documents(spark).withColumnRenamed("text", "html").withColumn("text", F.lit("t")).withColumn("url", F.lit(None).cast("string")).withColumnRenamed("doc_id", "page_id")
    got = tag_paths.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == pages.count()
    assert {(r.page_id, r.n_chars) for r in got.collect() if not r.text} == {(1, 0), (2, 0), (3, 0), (None, 0)}
    assert tag_paths.extract(pages.limit(0)).count() == 0
    assert len(tag_paths.main_text("<div>" * 20000 + "deep, text")) == 10
