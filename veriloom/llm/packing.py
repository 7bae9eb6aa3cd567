"""Best-fit packing planned on a histogram of lengths.

The plan works on counts: at most ``capacity`` distinct lengths, however many documents there are. It says which places the
n-th piece of a length takes; pieces are ranked within their length and joined to the places by (length, rank).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import byte_slices, rank_within, stored_rows
from veriloom.llm.tokens import BATCH_BYTES, Encoder

PLACES_PER_ROW = 10_000


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first, which takes the rest."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))] if total else []


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, items, items per sequence, first sequence, offset in it), by best fit on falling lengths.

    Sequences with equal free space form ranges. The tightest range that holds an item takes as many of its length as fit,
    sequence by sequence, which is what best fit does item by item. Steps depend on the lengths, not on the counts.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    runs, opened = [], 0

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in free:
                insort(spaces, space)
                free[space] = []
            free[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens doesn't fit {capacity}")
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(spaces, length)
            if i == len(spaces):
                space, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            else:
                space = spaces[i]
                first, n = free[space].pop()
                if not free[space]:
                    del free[space], spaces[i]
            per = space // length
            whole = min(n, left // per)
            for n_of, each in ((whole, per), (min(n - whole, 1), left - whole * per if n > whole else 0)):
                if n_of and each:
                    runs.append((length, rank, n_of * each, each, first, capacity - space))
                    put(space - each * length, first, n_of)
                    first, n, rank, left = first + n_of, n - n_of, rank + n_of * each, left - n_of * each
            put(space, first, n)
    return runs


def pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int | None = 0, text: str = "text",
           doc: str = "doc_id") -> DataFrame:
    """(doc, piece, start, length, ids_crc32) of every document: its ids, then ``end_id``, cut by :func:`cut`."""
    source = df.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, "_text", BATCH_BYTES):
                at, piece, start, length, crc = [], [], [], [], []
                for i, parts in enumerate(encoder.encode(part.column("_text").to_pylist())):
                    ids = memoryview(b"".join([*parts, tail]))
                    for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        at.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(ids[4 * s:4 * (s + n)]))
                columns = [part.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(encode, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, text: str = "text",
         doc: str = "doc_id") -> DataFrame:
    """Place every piece of every document: pieces' columns, sequence_id and offset.

    Runs jobs when called: pieces are encoded once and stored (five numbers a piece, no text), then their lengths
    are counted. Null texts are empty and still take their end token. Repeated rows are packed as often as they occur,
    null ids like others. No rows give no rows. Sequence numbers start at 0 and depend on how rows were stored.
    """
    spark = df.sparkSession
    stored = stored_rows(pieces(df, tokenizer, capacity, end_id, text, doc), "pieces")
    histogram = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    runs = np.array(best_fit(histogram, capacity), dtype=np.int64).reshape(-1, 6)
    plan = spark.createDataFrame(pa.table(dict(zip(("length", "rank0", "items", "per", "seq0", "offset0"), runs.T))))
    blocks = plan.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("items") - 1, F.lit(PLACES_PER_ROW).cast("bigint"))).alias("at"))
    places = (blocks.repartition("length", "rank0", "at")
              .select("*", F.explode(F.sequence("at", F.least(F.col("at") + PLACES_PER_ROW, "items") - 1)).alias("i"))
              .select("length", (F.col("rank0") + F.col("i")).alias("rank"),
                      (F.col("seq0") + F.floor(F.col("i") / F.col("per"))).alias("sequence_id"),
                      (F.col("offset0") + F.col("i") % F.col("per") * F.col("length")).alias("offset")))
    ranked = rank_within(stored, ["length"])
    # the plan looks small to the planner, its places are as many as the pieces: never broadcast
    return (ranked.join(places.hint("shuffle_merge"), ["length", "rank"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
