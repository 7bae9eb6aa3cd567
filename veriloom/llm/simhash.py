"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a common variant within half of it. Every distinct fingerprint emits its ball
of half the radius; what meets on a variant is near. A ball bounds how many distinct fingerprints can meet, whatever the
number of copies, and a star to the smallest of them keeps them connected without listing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.llm.common import byte_slices, components
from veriloom.session import materialise

SEED = 42
WINDOW_BYTES = 1 << 20


def fingerprint(text: bytes, width: int = 3) -> int:
    """Of lower-cased (A-Z) words; a bit is set if it is in over half the shingles' XXH64, repeats included."""
    from xxhash import xxh64_intdigest as xxh

    counts, total, carried, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(text) or not at:
        end = min(len(text), at + WINDOW_BYTES)
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":  # never cut a word
            end += 1
        words = [*carried, *text[at:end].lower().split()]
        at = max(end, 1)
        if at >= len(text) and not total and 0 < len(words) < width:
            shingles = [b" ".join(words)]
        else:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words], dtype=np.int64)
            starts = [0, *ends.tolist()][:len(words)]
            shingles = [line[s:e - 1] for s, e in zip(starts, ends[width - 1:].tolist())]
        if shingles:
            hashes = np.array([xxh(s, SEED) for s in shingles], dtype="<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(shingles)
        carried = words[-(width - 1):] if width > 1 else []
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0]) if total else 0


def fingerprints(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), width: int = 3) -> DataFrame:
    """Columns ``keep`` and ``fp`` (64 bits as a bigint). Null and empty texts have fingerprint zero."""
    source = df.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("_text").schema.fields)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text", WINDOW_BYTES):
                found = [fingerprint(t, width) for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(found, pa.int64())], [*keep, "fp"])

    return source.mapInArrow(compute, f"{schema}, fp bigint")


def ball(radius: int) -> list[int]:
    """XOR masks of up to ``radius`` of 64 bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` at most ``radius`` bits apart that connect all such pairs.

    ``radius`` is even: then all that meet on a variant are within it, and one link from each to the smallest suffices.
    """
    if radius % 2:
        raise ValueError("radius must be even")
    distinct = prints.select("fp").where("fp IS NOT NULL").distinct()
    variants = distinct.select("fp", F.explode(F.transform(F.lit(ball(radius // 2)), lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    low = F.min("fp").over(W.partitionBy("variant"))
    met = variants.select("fp", low.alias("low")).where("fp <> low").distinct()
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("low"))) <= radius).select(F.col("fp").alias("a"), F.col("low").alias("b"))


def text_key(text: str = "text") -> Column:
    """A number of the text; null and empty ones have the same."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _classes(df: DataFrame, text: str, doc: str, width: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """The stored rows (doc_id, key, fp), and fp, root (never null) and component_id of every fingerprint."""
    rows = df.select(F.col(doc).alias("doc_id"), text_key(text).alias("key"), F.col(text).alias("text"))
    stored = materialise(fingerprints(rows, "text", ("doc_id", "key"), width), "fingerprints")
    roots = components(links(stored, radius), "simhash")
    prints = stored.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return stored, materialise(rooted.join(ids.hint("shuffle_merge"), "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(df: DataFrame, text: str = "text", doc: str = "doc_id", width: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``df``: doc_id, fp and component_id, the smallest id reachable over links.

    Runs jobs when called and stores (id, text's hash, fingerprint), never texts. Equal fingerprints, those of empty texts too, are
    linked. Repeated rows share a component; a component without any id has a null one. No rows give no rows.
    """
    stored, classes = _classes(df, text, doc, width, radius)
    return stored.join(classes.hint("shuffle_merge"), "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, text: str = "text", doc: str = "doc_id", width: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component left, as ``keep_first`` says; rows without an id stay besides."""
    stored, classes = _classes(docs, text, doc, width, radius)
    named = stored.where("doc_id IS NOT NULL").join(classes.hint("shuffle_merge"), "fp")
    return keep_first(docs.where(F.col(doc).isNotNull()), named, text, doc).unionByName(docs.where(F.col(doc).isNull()))


def keep_first(docs: DataFrame, members: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``docs`` with exactly one row of each component left: that with the smallest id, or any if none has one.

    ``members``: doc_id, key (``text_key``) and root, the component, of every row. A row is known by id and text, so rows that share an
    id but not a text are each judged by their own component. Of rows equal in both one stays.
    """
    none = lambda c: c.isNull().alias("_none")
    name = lambda c: F.coalesce(c.cast("string"), F.lit("")).alias("_name")
    first = members.groupBy("root").agg(F.min(F.struct(none(F.col("doc_id")), "doc_id", "key")).alias("_first")).select("_first.*")
    kept = first.select("_none", name(F.col("doc_id")), F.col("key").alias("_key"))
    rows = docs.select(none(F.col(doc)), name(F.col(doc)), text_key(text).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    by = ["_none", "_name", "_key"]
    n = F.row_number().over(W.partitionBy(*by).orderBy(F.xxhash64("_doc")))
    return rows.join(kept.hint("shuffle_merge"), by, "left_semi").withColumn("_n", n).where("_n = 1").select("_doc.*")
