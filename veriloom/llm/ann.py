"""Nearest neighbours by cosine with an inverted multi-index.

Both halves of every (unit) vector are quantised on their own; a pair of centroids is a cell. A query walks the pairs in order of
summed distance, by a heap over the two sorted lists, until it has seen enough entries, and its candidates are ranked by the
exact measure. How many are enough is learned: a pass finds the true neighbours of a bounded set of rows and how far the walk must
go to meet the wanted share of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.llm.common import bounded_sample
from veriloom.session import materialise

SAMPLE, PROBES = 20_000, 200
MOST_CENTROIDS, CELL_ROWS = 256, 200
ENTRIES, QUERIES, CHUNK = 8192, 2048, 256


class Index(NamedTuple):
    halves: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray | None = None

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.halves[0].shape[1]
        return tuple(((p * p).sum(1)[:, None] - 2 * p @ c.T + (c * c).sum(1)).clip(0)
                     for p, c in zip((unit[:, :cut], unit[:, cut:]), self.halves))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return a.argmin(1) * len(self.halves[1]) + b.argmin(1)

    def walk(self, a: np.ndarray, b: np.ndarray) -> Iterator[int]:
        """Cells by summed distance of one query's centroids; ties by place."""
        order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, seen = [(a[order_a[0]] + b[order_b[0]], 0, 0)], {(0, 0)}
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(order_a[i]) * len(b) + int(order_b[j])
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(a) and y < len(b) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (a[order_a[x]] + b[order_b[y]], x, y))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cluster(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means; an emptied centroid moves to the worst-placed point."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), size=min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        far = ((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1)).clip(0)
        near = far.argmin(1)
        for c in range(len(centres)):
            mine = near == c
            centres[c] = points[mine].mean(0) if mine.any() else points[far.min(1).argmax()]
    return centres


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)


def usable(df: DataFrame, vec: str, embedding: str) -> DataFrame:
    """vec_id, embedding of rows that take part: vectors without null or non-finite components, not zero."""
    e = F.col(embedding).cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    return df.where(F.coalesce(fine, F.lit(False))).select(F.col(vec).alias("vec_id"), F.col(embedding).alias("embedding")).where("vec_id IS NOT NULL")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """One row per different vector: rep (its smallest id), ids (its k + 1 smallest) and the vector. Ranks are cut before the shuffle."""
    n = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    least = rows.distinct().withColumn("_n", n).where(F.col("_n") <= k + 1)
    return least.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "ids", "embedding")


def _exact(query: np.ndarray, found: np.ndarray) -> np.ndarray:
    return (found * query).sum(1) / (np.sqrt((found * found).sum(1)) * np.sqrt((query * query).sum()))


def _top(queries: np.ndarray, entries: np.ndarray, reps: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its k best entries by cosine, ties to the smaller rep: (query, places, scores)."""
    e = unit(entries)
    for start in range(0, len(queries), CHUNK):
        part = queries[start:start + CHUNK]
        scores = unit(part) @ e.T
        few = min(k, len(e))
        cut = np.partition(scores, len(e) - few, axis=1)[:, len(e) - few] - 1e-9
        for i in range(len(part)):
            near = np.flatnonzero(scores[i] >= cut[i])
            exact = _exact(part[i], entries[near])
            best = np.lexsort((reps[near], -exact))[:few]
            yield start + i, near[best], exact[best]


def fit(vectors: DataFrame, total: int) -> Index:
    """Centroids from at most SAMPLE different vectors, those with the smallest hashes; their number follows the number of rows."""
    rows = bounded_sample(vectors.select("rep", "embedding"), SAMPLE, "rep").select("embedding").toArrow()
    size = len(rows.column("embedding")[0])
    points = unit(_matrix(rows.column("embedding"), size))
    k = int(np.clip(np.sqrt(total / CELL_ROWS), 2, min(MOST_CENTROIDS, len(points))))
    cut = max(1, size // 2)
    return Index((cluster(points[:, :cut], k), cluster(points[:, cut:], k)))


def enough(entries: DataFrame, index: Index, k: int, recall: float) -> int:
    """Entries to see so that ``recall`` of the true k nearest of PROBES rows are met: one pass over all entries."""
    probes = bounded_sample(entries.select("rep", "embedding"), PROBES, "rep").toArrow()
    size = len(probes.column("embedding")[0])
    queries, own = _matrix(probes.column("embedding"), size), np.array(probes.column("rep").to_pylist())

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, vectors = np.array(batch.column("rep").to_pylist()), _matrix(batch.column("embedding"), size)
            cells = np.asarray(batch.column("cell"))
            for q, at, scores in _top(queries, vectors, reps, k + 1):
                fits = reps[at] != own[q]
                yield pa.RecordBatch.from_pydict({"q": np.full(fits.sum(), q), "cell": cells[at][fits], "score": scores[fits], "rep": pa.array(reps[at][fits].tolist()).cast(pa.string())})

    found = entries.mapInArrow(nearest, "q bigint, cell bigint, score double, rep string")
    n = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "rep"))
    truth = found.withColumn("n", n).where(F.col("n") <= k).select("q", "cell").collect()  # PROBES * k rows at most
    a, b = index.distances(unit(queries))
    seen = {}
    for q in range(len(queries)):
        order = list(index.walk(a[q], b[q]))
        seen[q] = dict(zip(order, np.cumsum(index.counts[order]).tolist()))
    needed = sorted(seen[r["q"]][r["cell"]] for r in truth)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))] if needed else 0


def search(df: DataFrame, is_query, k: int = 5, vec: str = "vec_id", embedding: str = "embedding", recall: float = 0.96) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row for which ``is_query`` holds, its own row aside.

    Runs jobs when called. Every vector is indexed; equal ones are one entry with their smallest ids, and equal queries are searched once.
    Vectors of different lengths have no cosine: each length is searched by itself. Those with too few vectors to fill a cell are ranked
    whole, all such lengths in one job. Cells and the queries that visit them are cut into blocks, so no task holds more than a block of
    each. Ties go to the smaller id. Rows without an id or a usable vector take no part; ids stand for rows, so repeated rows count once.
    No rows give none.
    """
    spark = df.sparkSession
    rows = materialise(usable(df, vec, embedding), "vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    vectors = materialise(distinct_vectors(rows, k), "distinct")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    totals = {r["n"]: r["c"] for r in vectors.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c")).collect()}  # a row per length
    large = sorted(n for n, c in totals.items() if c > CELL_ROWS)
    parts = [_indexed(vectors.where(F.size("embedding") == n), asked.where(F.size("embedding") == n), totals[n], k, recall) for n in large]
    if len(large) < len(totals):
        rest = ~F.size("embedding").isin(large)
        parts.append(_blockwise(vectors.where(rest), asked.where(rest), k))
    if not parts:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    return reduce(DataFrame.unionByName, parts)


def _ranker(k: int):
    """A function for cogrouped blocks of entries and queries of one length: each query's k + 1 best entries."""
    def rank_block(found: pa.Table, wanted: pa.Table) -> pa.Table:
        at, hits, scores = [], [], []
        if found.num_rows and wanted.num_rows:
            size = len(found.column("embedding")[0])
            reps = np.array(found.column("rep").to_pylist())
            for q, near, s in _top(_matrix(wanted.column("embedding"), size), _matrix(found.column("embedding"), size), reps, k + 1):
                at += [q] * len(near)
                hits += near.tolist()
                scores += s.tolist()
        at, hits = pa.array(at, pa.int64()), pa.array(hits, pa.int64())
        return pa.table({"embedding": wanted.column("embedding").take(at), "rep": found.column("rep").take(hits), "ids": found.column("ids").take(hits), "score": pa.array(scores, pa.float64())})

    return rank_block


def _answers(ranked: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k nearest ids of every query from the best entries of its blocks."""
    best = F.row_number().over(W.partitionBy("embedding").orderBy(F.desc("score"), "rep"))
    lists = ranked.withColumn("_n", best).where(F.col("_n") <= k + 1).groupBy("embedding").agg(F.collect_list(F.struct("score", "ids")).alias("near"))
    each = asked.join(lists.hint("shuffle_merge"), "embedding").select("query_id", F.explode("near").alias("_e")).select("query_id", "_e.score", F.explode("_e.ids").alias("vec_id"))
    order = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.where("vec_id <> query_id").withColumn("rank", order).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _blockwise(vectors: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Every query of a length against all of its at most CELL_ROWS entries: what a single cell of the index would do."""
    kind, shape = (vectors.schema[c].dataType.simpleString() for c in ("rep", "embedding"))
    left = vectors.withColumn("n", F.size("embedding"))
    right = asked.select("embedding").distinct().withColumn("n", F.size("embedding"))
    ranked = left.groupBy("n").cogroup(right.groupBy("n")).applyInArrow(_ranker(k), f"embedding {shape}, rep {kind}, ids array<{kind}>, score double")
    return _answers(ranked, asked, k)


def _indexed(vectors: DataFrame, asked: DataFrame, total: int, k: int, recall: float) -> DataFrame:
    """The index over the vectors of one length."""
    spark = vectors.sparkSession
    kind = vectors.schema["rep"].dataType.simpleString()
    index = fit(vectors, total)
    size = index.halves[0].shape[1] + index.halves[1].shape[1]
    shape = vectors.schema["embedding"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("cell", pa.array(index.cells(unit(_matrix(batch.column("embedding"), size))), pa.int64()))

    entries = materialise(vectors.mapInArrow(place, f"rep {kind}, ids array<{kind}>, embedding {shape}, cell bigint"), "entries")
    sizes = {r["cell"]: r["n"] for r in entries.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # MOST_CENTROIDS ** 2 at most
    counts = np.zeros(len(index.halves[0]) * len(index.halves[1]), np.int64)
    counts[list(sizes)] = list(sizes.values())
    index = index._replace(counts=counts)
    limit = max(enough(entries, index, k, recall), k + 1)

    queries = asked.select("embedding").distinct()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = index.distances(unit(_matrix(batch.column("embedding"), size)))
            at, cells = [], []
            for q in range(batch.num_rows):
                left = limit
                for cell in index.walk(a[q], b[q]):
                    if index.counts[cell]:
                        at.append(q)
                        cells.append(cell)
                        left -= index.counts[cell]
                        if left <= 0:
                            break
            for s in range(0, len(at), 10_000):
                yield pa.RecordBatch.from_arrays([batch.column("embedding").take(pa.array(at[s:s + 10_000])), pa.array(cells[s:s + 10_000], pa.int64())], ["embedding", "cell"])

    visits = materialise(queries.mapInArrow(visit, f"embedding {shape}, cell bigint"), "visits")
    asks = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # likewise
    blocks = spark.createDataFrame([(int(c), -(-int(n) // ENTRIES), -(-int(asks.get(c, 0)) // QUERIES)) for c, n in sizes.items()], "cell bigint, parts int, asks int")
    blocks = F.broadcast(blocks)  # a row per cell
    left = (entries.join(blocks, "cell").where("asks > 0").withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("ask")).drop("parts", "asks"))
    right = (visits.join(blocks, "cell").withColumn("ask", F.pmod(F.xxhash64("embedding"), "asks").cast("int"))
             .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_p")).withColumn("part", F.col("_p").cast("bigint")).drop("parts", "asks", "_p"))

    keys = ("cell", "part", "ask")
    ranked = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_ranker(k), f"embedding {shape}, rep {kind}, ids array<{kind}>, score double")
    return _answers(ranked, asked, k)
