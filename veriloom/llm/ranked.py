"""Ranked lexical search by NRA: impact-sorted lists read in step, without random access.

Documents are cut into shards of bounded size. In a shard every term has a list of (document, impact), largest impacts first. For a
query its lists are read from the top down to a common impact, which is lowered again and again. Each document seen has a score interval: what its
entries read so far add up to, and that plus the next unread impact of every list in which it hasn't been seen. Reading goes on until no
unseen document can come in, ties included, and the scores of all that may belong to the best are exact. The best of the shards are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.llm.common import byte_slices
from veriloom.session import materialise

WINDOW_BYTES = 1 << 20
#: Entries of a shard's lists; about 50 MB in a task.
SHARD_ENTRIES = 2_000_000
#: Distinct query terms, and query terms in all, that are shipped to tasks at once; larger query sets are answered in blocks.
BLOCK_TERMS = 200_000
#: Bytes that are no part of a term become a space, A-Z small: terms are what lies between.
_TERM_BYTES = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + WINDOW_BYTES)
        while end < len(text) and _TERM_BYTES[text[end]] != 32:  # never cut a term
            end += 1
        yield text[at:end].translate(_TERM_BYTES).split()
        at = end


class Query(NamedTuple):
    row: int
    terms: list[int]  # numbers of distinct terms
    times: list[int]


class Lists(NamedTuple):
    """A shard: entries of term t are places[t] to places[t + 1], by falling impact."""

    size: int
    places: np.ndarray
    documents: np.ndarray
    impacts: np.ndarray


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Fixed rule of the contract, in 64-bit integers, divisions rounding down. n: terms of the entry's document."""
    m = 100 - 25 + (25 * n * documents) // words
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def lists(numbers: np.ndarray, documents: np.ndarray, values: np.ndarray, size: int, distinct: int) -> Lists:
    order = np.lexsort((-values, numbers))
    places = np.zeros(distinct + 1, np.int64)
    np.cumsum(np.bincount(numbers, minlength=distinct), out=places[1:])
    return Lists(size, places, documents[order], values[order])


def best(shard: Lists, query: Query, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the shard that may be among its ``k`` best, with their exact scores: all with a score of the k-th or more, above 0."""
    low = np.zeros(shard.size, np.int64)
    ends = [int(shard.places[t + 1]) for t in query.terms]
    at = [int(shard.places[t]) for t in query.terms]
    first = list(at)
    times = query.times
    following = lambda j: int(shard.impacts[at[j]]) if at[j] < ends[j] else 0
    left = [following(j) for j in range(len(at))]  # the largest impact still unread, by list
    cut, still = max(left, default=0), None  # still: what may yet belong to the best, once nothing else can
    while any(left):
        cut //= 2
        for j, value in enumerate(left):
            if value > cut:
                end = ends[j] if not cut else at[j] + int(np.searchsorted(-shard.impacts[at[j]:ends[j]], -cut, side="left"))
                docs, gain = shard.documents[at[j]:end], shard.impacts[at[j]:end]
                if still is not None:
                    open_ = still[docs]
                    docs, gain = docs[open_], gain[open_]
                low[docs] += times[j] * gain  # a document stands once in a list
                at[j] = end
                left[j] = following(j)
        if len(low) < k:
            continue
        level = int(np.partition(low, len(low) - k)[len(low) - k])
        unseen = sum(t * v for t, v in zip(times, left))
        if level > unseen:
            high = low + unseen
            for j, value in enumerate(left):
                if value:
                    high[shard.documents[first[j]:at[j]]] -= times[j] * value
            still = high >= level if still is None else still & (high >= level)
            if not any(left) or np.array_equal(high[still], low[still]):
                break
    level = max(1, int(np.partition(low, len(low) - k)[len(low) - k])) if len(low) >= k else 1
    found = low >= level if still is None else still & (low >= level)
    docs = np.flatnonzero(found)
    return docs, low[docs]


def _index(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms) and, of the terms in ``vocabulary``, their numbers and how often they occur, of rows (doc_id, _text)."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)  # at most BLOCK_TERMS terms

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in byte_slices(batch, "_text", WINDOW_BYTES):
                sizes, numbers, often = [], [], []
                for text in part.column("_text").to_pylist():
                    n, counted = 0, Counter()
                    for found in terms(text):
                        n += len(found)
                        counted.update(found)
                    held = [w for w in counted if w in known]
                    sizes.append(n)
                    numbers.append([known[w] for w in held])
                    often.append([counted[w] for w in held])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(numbers, pa.list_(pa.int32())),
                                                  pa.array(often, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tf"])

    return rows.mapInArrow(compute, f"doc_id {kind}, n bigint, terms array<int>, tf array<bigint>")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _ranked(index: DataFrame, weights: np.ndarray, queries: list[Query], documents: int, words: int, k: int, entries: int) -> DataFrame:
    """row, doc_id and score: of every shard and query, all documents that may be among the ``k`` best."""
    kind = index.schema["doc_id"].dataType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast((weights, queries))  # at most BLOCK_TERMS terms

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, asked = shared.value
        held: list[pa.RecordBatch] = []

        def answers() -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays([b.column("doc_id") for b in held])
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            numbers, sizes = map(np.concatenate, zip(*[_flat(b.column("terms")) for b in held]))
            tf = np.concatenate([_flat(b.column("tf"))[0] for b in held]).astype(np.int64)
            of = np.repeat(np.arange(len(n)), sizes)
            values = impacts(known[numbers], tf, n[of], documents, words)
            keep = values > 0
            shard = lists(numbers[keep], of[keep], values[keep], len(n), len(known))
            order = np.full(len(n), len(n))  # ties go to smaller ids; rows without one come last
            order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(n))
            for query in asked:
                docs, scores = best(shard, query, k)
                top = np.lexsort((order[docs], -scores))[:k]  # the shard's k best hold all of the k best of all that lie in it
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), query.row), pa.int64()), ids.take(pa.array(docs[top])), pa.array(scores[top], pa.int64())], ["row", "doc_id", "score"])

        full = 0
        for batch in batches:
            held.append(batch)
            full += len(batch.column("terms").flatten())
            if full >= entries:
                yield from answers()
                held, full = [], 0
        if held:
            yield from answers()

    return index.mapInArrow(compute, f"row bigint, doc_id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", doc: str = "doc_id", item: str = "item_id", item_text: str = "text",
           entries: int = SHARD_ENTRIES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score (above 0) of the ``k`` best documents of every row of ``items``; equal scores by rising id, a null one last.

    Runs jobs when called. Per block of queries the texts are read once and an index of the block's terms is stored; weights come from
    counts over all documents. Queries are shipped to the tasks in blocks of at most ``block_terms`` terms (an item of more stands alone),
    so their memory is bounded however many there are. Null and empty texts hold no term and count for nothing; a repeated document or item is
    another one; extra columns aren't read; no documents or no items give no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))
    asked = materialise(items.select(F.col(item).alias("item_id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).cast("binary").alias("_text"),
                                     F.monotonically_increasing_id().alias("row")), "items")
    size = F.octet_length("_text")
    sized = asked.select("row", size.alias("bytes"))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    parts = max(1, math.ceil(total / (2 * block_terms)))  # a term has a byte and one between at least
    found = None
    for number in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == number).select("row", "_text").orderBy("row").toArrow()  # one block
        vocabulary: dict[bytes, int] = {}
        queries = []
        for row, content in zip(rows.column("row").to_pylist(), rows.column("_text").to_pylist()):
            counted = Counter(w for part in terms(content) for w in part)
            if counted:
                queries.append(Query(row, [vocabulary.setdefault(w, len(vocabulary)) for w in counted], list(counted.values())))
        index = materialise(_index(source, vocabulary), "index")
        documents, words = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()  # at most the block's terms
        df = np.zeros(len(vocabulary), np.int64)
        df[holding.column("term").to_numpy()] = holding.column("df").to_numpy()
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        part = _ranked(index, weights, queries, documents, words, k, entries)
        found = part if found is None else found.unionByName(part)
    order = W.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("row", "item_id").hint("shuffle_merge"), "row").select("item_id", "rank", "doc_id", "score")
