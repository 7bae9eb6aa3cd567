import base64
import hashlib
import os
import re
import struct
import uuid
from collections import Counter

import duckdb
import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from veriloom.llm import ann, queries, urls, warc

URLS = ["http://a.com", "http://a.com/", "HTTPS://X.NET/es/1", "http://example.com/en/1", "http://www.example.com/en/1?x=1#y", "http://sub.www.example.com/en/", "http://xcom/",
        "no scheme", "", None, "a://b://c.net/fr/z", "http://com/", "http://é.COM/É", "http://bad.org/p/?utm_source=1&b=2&a=1", "http://www.bad.org/p?a=1&b=2", "http://bad.org/p.html",
        "http://bad.org/p", "http://bad.org/q", "http://bad.org/q", "x://" + "y" * 100_000 + "/z", "http://user@bad.org:80/p", "http://net\n/es/"]


def brute_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for verdict, h, p in queries.URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, best


def test_urls_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").withColumns({"_block": F.lit(1), "canonical": F.lit("c"), "verdict": F.lit("v")})
    listed = spark.createDataFrame([("bad.org/p?a=1&b=2",), ("bad.org/q",), ("bad.org/q",), (None,)], "canonical string")
    rows = {r.page_id: r for r in urls.judge(df, queries.URL_RULES, listed).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, best = brute_url(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, best and best[0]), url
        assert rows[i].verdict == (best[1] if best else "block" if i in (13, 14, 17, 18) else "allow"), url
    assert {r.verdict for r in urls.judge(df, [], listed.limit(0)).collect()} == {"allow"}
    assert urls.judge(df.limit(0), queries.URL_RULES, listed).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 256
    probe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    got = urls.might_hold(probe, "key", urls.bloom_blocks(keys, "key", blocks), blocks)
    assert got.where("id < 5000 AND NOT _maybe").count() == 0
    assert got.where("id >= 5000 AND _maybe").count() < 15_000 * 0.05
    full = urls.on_list(probe, "key", keys)  # exact after the join
    assert full.where("listed").count() == 5000 and full.where("listed AND id >= 5000").count() == 0


def test_no_python_in_native_queries(spark, sf):
    for name in ("op4_pii_disclosure", "op6_url_filter"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", plan)


# nearest neighbours


def brute_neighbours(rows, queries_, k):
    out = {}
    for q, a in queries_:
        a = np.array(a, np.float64)
        scored = sorted((-(a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)), v) for v, b in ((v, np.array(b, np.float64)) for v, b in rows) if v != q)
        out[q] = [(v, -s) for s, v in scored[:k]]
    return out


def test_few_vectors_are_searched_exactly(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(50)] + [(200 + i, [2 * x for x in rows[1][1]]) for i in range(3)] + [(5, rows[5][1])]
    bad = [(300, None), (301, []), (302, [0.0] * 6), (303, [1.0, None] * 3), (304, [float("nan")] * 6), (305, [float("inf")] * 6), (306, [1.0, 2.0]), (None, rows[2][1])]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>").withColumns({"rep": F.lit(1), "cell": F.lit("c"), "ids": F.lit(0), "query_id": F.lit(1), "label": F.lit(1)})
    got = ann.search(df, F.col("vec_id") % 5 == 0, recall=1.0).collect()
    seen = {}
    for v, e in rows:
        seen[v] = e
    want = brute_neighbours(sorted(seen.items()), [(v, e) for v, e in seen.items() if v % 5 == 0], 5)
    assert {r.query_id for r in got} == set(want)
    for q, near in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert [r.vec_id for r in mine] == [v for v, _ in near] or [r.score for r in mine] == pytest.approx([s for _, s in near], abs=1e-12)
        assert [r.score for r in mine] == pytest.approx([s for _, s in near], abs=1e-12)
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    assert ann.search(df.where("vec_id = 1"), F.lit(True)).count() == 0
    assert ann.search(df.where("vec_id IN (1, 2)"), F.lit(True)).count() == 2


@pytest.mark.parametrize("cell_rows", [10, 200])
def test_every_length_is_searched_and_no_near_tie_is_lost(spark, monkeypatch, cell_rows):
    """Three lengths, the rarest with one row; 100 vectors all but equally near to a query. Indexed and, in cells of more rows, whole."""
    monkeypatch.setattr(ann, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(30)] + [(2000, [1.0] * 9)]
    near = [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    rows += [(3000, near)] + [(3100 - i, [1.0, 1e-3, i * 1e-12, 0.0, 0.0, 0.0]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 10 == 0, recall=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    asked = [(v, e) for v, e in rows if v % 10 == 0 and v != 2000]
    assert set(got) == {v for v, _ in asked}  # the only row of its length has no candidates
    for v, e in asked:
        want = brute_neighbours([(w, f) for w, f in rows if len(f) == len(e)], [(v, e)], 5)[v]
        assert [n for n, _, _ in sorted(got[v])] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in sorted(got[v])] == pytest.approx([s for _, s in want], abs=1e-12)


def test_blocks_give_the_same(spark, sf, monkeypatch):
    df = queries.table(spark, sf, "embeddings")
    whole = odd.plain(ann.search(df, F.col("vec_id") % 20 == 0, recall=1.0))
    monkeypatch.setattr(ann, "ENTRIES", 7)
    monkeypatch.setattr(ann, "QUERIES", 3)
    assert odd.plain(ann.search(df, F.col("vec_id") % 20 == 0, recall=1.0)) == whole


def test_recall_on_the_table(spark):
    df = queries.table(spark, "/root/testdata/sf0.1", "embeddings")
    got = queries.QUERIES["op8_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect()
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute_neighbours(rows, [r for r in rows if r[0] % 50 == 0], 5)
    mine = {(r.query_id, r.vec_id) for r in got}
    assert len(got) == 5 * len(want) and sum((q, v) in mine for q, near in want.items() for v, _ in near) >= 0.9 * 5 * len(want)


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(5)
    a, b = rng.random(9), rng.random(7)
    cells = list(ann.Index((np.zeros((9, 1)), np.zeros((7, 1)))).walk(a, b))
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert sorted(cells) == list(range(63)) and sums == sorted(sums)


# archives

PAGES = [(1, "http://a.org/1", "short"), (2, "http://a.org/2", "short"), (3, "http://a.org/é x\r\nEvil: 1", "é" * 600), (4, None, "é" * 600), (5, "u", None), (6, "u", ""), (9, "u", "é" * 600),
         (9, "u", "é" * 600), (10, "u", "y" * 999), (11, "u", "y" * 999), (12, "u", "z" * 1000), (13, "u", "z" * 1000), (14, "u", "<html>\r\n\r\nWARC/1.1\r\n\r\n" * 90_000), (None, "u", "no id")]


def brute_archive(pages):
    groups = {}
    for p, _, h in pages:
        if len((h or "").encode()) >= 1000 and p is not None:
            groups.setdefault(h, []).append(p)
    out = Counter()
    for p, _, h in pages:
        data = (h or "").encode()
        first = max(groups.get(h, [p]), default=p) if p is not None else p
        out[p, len(data), hashlib.sha1(data).hexdigest(), "response" if first == p else "revisit", None if first == p else first] += 1
    return out


def test_archives_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumns({"digest": F.lit("d"), "payload": F.lit("p"), "record_type": F.lit(1)})
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive(df).collect())
    assert got == brute_archive(PAGES)
    assert warc.archive(df.limit(0)).count() == 0


def test_files_are_valid(spark, tmp_path, sf):
    import zstandard

    pages = queries.table(spark, sf, "pages")
    dictionary = warc.train(pages)
    assert dictionary[:4] == struct.pack("<I", warc.DICT_MAGIC)
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    files = warc.write(warc.plan(pages), folder, dictionary).collect()
    want = {r.page_id: r.html for r in pages.collect()}
    seen = {}
    for f in files:
        raw = open(f.path.removeprefix("file://"), "rb").read()
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D and raw[8:8 + size] == dictionary and len(raw) == f.bytes
        at, frames = 8 + size, 0
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        while at < len(raw):  # every frame is one whole record
            one = plain.decompressobj()
            record = one.decompress(raw[at:])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            at, frames = len(raw) - len(one.unused_data), frames + 1
        assert frames == f.records + 1
        for fields, block in warc.read_file(f.path):
            if fields["warc-type"] == "response":
                payload = block.partition(b"\r\n\r\n")[2]
                seen[int(fields["warc-record-id"][len("<urn:x-page:"):-1])] = payload.decode()
                assert fields["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert seen == want
    html = sum(len(h.encode()) for h in want.values())
    assert sum(os.path.getsize(f.path.removeprefix("file://")) for f in files) < html


def test_damage_is_noticed(spark, tmp_path):
    df = spark.createDataFrame(PAGES[:3], "page_id bigint, url string, html string")
    files = warc.write(warc.plan(df.coalesce(1)), f"file://{tmp_path}/{uuid.uuid4().hex}", b"")
    path = files.first().path.removeprefix("file://")
    raw = open(path, "rb").read()
    open(path, "wb").write(raw[:-7])
    with pytest.raises(Exception):
        warc.read(files).collect()


# queries against SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agrees_with_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    cur = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(repr(tuple(r)) for r in df.select(*cols).collect()) == sorted(repr(tuple(r)) for r in cur.fetchall())
