"""The operators applied to the given tables, and the SQL that must agree where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.llm import ann, classifier, mixing, packing, periodic, pii, quality_rules, ranked, simhash, tag_paths, tokens, urls, warc

#: The contracts' word, as a DuckDB pattern.
SQL_WORD = r"[^\x20\x09-\x0D]+"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"), tokenizer_path())


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.apply_rules(table(spark, folder, "documents"))
    return found.select("doc_id", *quality_rules.NUMBERS, "base_failed", "kept", "removed_words")


ORACLES["op3_quality_rules"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '{SQL_WORD}') AS words FROM docs),
windows AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM worded)),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
split AS (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
lines AS (SELECT *, len(regexp_extract_all(line, '{SQL_WORD}')) AS n, row_number() OVER (PARTITION BY r, line ORDER BY pos) AS nth,
          regexp_replace(translate(array_to_string(regexp_extract_all(line, '{SQL_WORD}'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[1-9]', '0', 'g') AS plain
          FROM split WHERE regexp_matches(line, '{SQL_WORD}')),
common AS (SELECT source, plain FROM lines GROUP BY source, plain HAVING count(DISTINCT text) > 10),
per_doc AS (SELECT r, sum(CASE WHEN nth > 1 THEN 1 ELSE 0 END) AS twice, sum(CASE WHEN c.plain IS NULL THEN 0 ELSE n END) AS gone
            FROM lines l LEFT JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.plain = c.plain GROUP BY r),
numbers AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(array_to_string(words, '')), 0) AS BIGINT) AS word_chars,
            CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(twice, 0) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone, 0) AS BIGINT) AS removed_words
            FROM worded w LEFT JOIN repeated p ON w.r = p.r LEFT JOIN per_doc d ON w.r = d.r),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM numbers)
SELECT *, NOT base_failed AND n_words - removed_words >= 0.5 * n_words AS kept FROM judged"""


#: Fixed values of the contract, in its order.
URL_RULES = [urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
             urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/")]
#: Names by which the given pages mark unwanted sites; the list of URLs is taken from their pages.
UNWANTED = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


@query
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    labels = F.split(urls.host_of(F.col("url")), r"\.")
    listed = pages.where(F.arrays_overlap(labels, F.array(*map(F.lit, UNWANTED)))).select(urls.canonical(F.col("url")).alias("canonical"))
    return urls.judge(pages, URL_RULES, listed)


ORACLES["op6_url_filter"] = rf"""
WITH parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
               list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
                                     lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS kept FROM pages),
named AS (SELECT page_id, host, path, regexp_replace(host, '^www\.', '') || regexp_replace(path, '(/|\.html)$', '')
          || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM named WHERE list_has_any(string_split(host, '.'), [{", ".join(f"'{x}'" for x in UNWANTED)}])),
rules AS (SELECT * FROM (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}) AS t(verdict, rule_host, rule_path)),
best AS (SELECT page_id, arg_max(rule_host || rule_path, len(rule_host || rule_path)) AS rule, arg_max(verdict, len(rule_host || rule_path)) AS verdict
         FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT n.page_id, host, path, b.rule, coalesce(b.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN best b ON n.page_id = b.page_id LEFT JOIN listed l ON n.canonical = l.canonical"""


@query
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages"))


ORACLES["op10_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM payloads),
grouped AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM grouped"""


@query
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op4_pii_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    order = F.array_sort("more", lambda a, b: F.when(a["kind"] != b["kind"], F.when(a["kind"] < b["kind"], -1).otherwise(1)).otherwise(a["start"] - b["start"]))
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.concat("base", order)).alias("spans"))


@query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLES["op11_ranked_search"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
items AS (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(text, '{SQL_TERM}')) AS term FROM items) GROUP BY ALL),
counted AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(regexp_extract_all(text, '{SQL_TERM}')) AS term FROM docs) GROUP BY ALL),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY r),
corpus AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, corpus GROUP BY term),
entries AS (SELECT c.r, c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll))) AS impact
            FROM counted c JOIN sizes USING (r) JOIN weights USING (term), corpus),
scores AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(q * impact) AS BIGINT) AS score FROM asked JOIN entries USING (term) GROUP BY item_id, r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20"""


@query
def op12_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return tag_paths.extract(table(spark, folder, "pages"))


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's fixed rule by which one document in ten, told by its id, gets a run: the word read at every place."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    order = np.arange(n)
    order[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return order


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find(table(spark, folder, "documents"), places=planted_order)
    top = found.withColumn("_top", periodic.strongest(F.col("runs")))
    return top.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "_top.start", "_top.length", "_top.period",
                      F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
                      F.sha2(periodic.written(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
