"""URL filters: rules on host and path, then a list of URLs looked up by way of a blocked Bloom filter and an exact join.

Only DataFrame functions. The filter is a table of 256-bit blocks whose number is bounded by a parameter, so it is broadcast; a URL
touches one block. What passes is joined exactly to the list, so false positives cost a row in that join and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import ascii_lower
from veriloom.session import materialise

MAX_BLOCKS = 1 << 16  # 2.6 MB as a table
BITS_PER_KEY = 12
WORDS = 4


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) part after the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column, tracking: str = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)") -> Column:
    """Host without ``www.``, path without a closing ``/`` or ``.html``, and the sorted query without tracking parameters."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"(/|\.html)$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(tracking)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, by length of host and path; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.host, r.path)):  # the last to apply wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """Two of 64 bits in each word of the block, from six bits of a second hash each."""
    h = F.xxhash64(F.lit("bits"), key)
    bit = lambda i: F.expr("shiftleft(1L, CAST(shiftrightunsigned(_h, %d) & 63 AS INT))" % (6 * i))
    return [h, *[bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: one row per block that any key touches."""
    h, *masks = _masks(F.col(key))
    hashed = keys.select(_block(F.col(key), blocks).alias("_block"), h.alias("_h"))
    return hashed.groupBy("_block").agg(*[F.bit_or(m).alias(f"_w{i}") for i, m in enumerate(masks)])


def might_hold(df: DataFrame, key: str, filter_blocks: DataFrame, blocks: int, name: str = "_maybe") -> DataFrame:
    h, *masks = _masks(F.col(key))
    probe = df.withColumn("_block", _block(F.col(key), blocks)).withColumn("_h", h)
    joined = probe.join(F.broadcast(filter_blocks), "_block", "left")
    every = F.lit(True)
    for i, m in enumerate(masks):
        every = every & (F.col(f"_w{i}").bitwiseAND(m) == m)
    return joined.withColumn(name, F.coalesce(every, F.lit(False))).drop("_block", "_h", *[f"_w{i}" for i in range(WORDS)])


def maybe(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Add ``_maybe``: false only for rows whose ``key`` isn't among the stored ``keys``. The filter grows with the keys up to MAX_BLOCKS."""
    wanted, blocks = keys.count() * BITS_PER_KEY / 256, 1
    while blocks < min(wanted, MAX_BLOCKS):
        blocks *= 2
    return might_hold(df, key, bloom_blocks(keys, key, blocks), blocks)


def on_list(df: DataFrame, key: str, listed: DataFrame, name: str = "listed") -> DataFrame:
    """Add whether ``key`` is among the keys of ``listed`` (one column of the same name), exactly. Null keys are not."""
    keys = materialise(listed.select(key).where(F.col(key).isNotNull()).distinct(), "listed")
    tested = maybe(df, key, keys)
    hits = tested.where("_maybe").join(keys.withColumn(name, F.lit(True)).hint("shuffle_merge"), key, "left")
    misses = tested.where("NOT _maybe").withColumn(name, F.lit(False))
    return hits.withColumn(name, F.coalesce(name, F.lit(False))).unionByName(misses).drop("_maybe")


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", page: str = "page_id") -> DataFrame:
    """page_id, host, path, rule and verdict: that of the longest fitting rule, else block for canonical URLs that are on the list
    and allow for others.

    ``listed`` has a column ``canonical``. A null URL, or one without ``://``, has an empty host and path, no rule, and the
    canonical form of an empty URL. Repeated rows are answered each; an empty list blocks nothing.
    """
    u = F.col(url)
    rows = pages.select(F.col(page).alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"), F.coalesce(canonical(u), F.lit("")).alias("canonical"))
    ruled = rows.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    decided = ruled.where("_rule IS NOT NULL").select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("verdict"))
    asked = on_list(ruled.where("_rule IS NULL"), "canonical", listed)
    method = asked.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"))
    return decided.unionByName(method)
