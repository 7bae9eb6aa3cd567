"""Quality rules on single texts, and on how often lines recur across the documents of a host.

One pass over the texts yields a few numbers and a list of (line hash, words) per document; all that follows works on those.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import byte_slices
from veriloom.session import materialise

SLICE_BYTES = 4 << 20
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def _hash(data: bytes) -> int:
    """The leading 63 bits of the MD5."""
    return int.from_bytes(hashlib.md5(data).digest()[:8], "big") >> 1


def line_hash(line: bytes) -> int:
    """Of a normalised line: A-Z lower-cased, white space runs as one space, digits alike."""
    return _hash(b" ".join(line.lower().split()).translate(_DIGITS))


_DIGITS = bytes.maketrans(b"123456789", b"0" * 9)


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found at least twice."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    _, pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, which, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:k + len(twice)] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple[int, int, int, int, int, int, list[int], list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, hash of the text, and hash and words of each line that has a word."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    twice, hashes, sizes = 0, [], []
    for line in raw.split(b"\n"):
        n = len(line.split())
        if n:
            twice += line in seen
            seen.add(line)
            hashes.append(line_hash(line))
            sizes.append(n)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), twice,
            repeat_words(words), _hash(raw), hashes, sizes)


NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(df: DataFrame, text: str, doc: str, host: str) -> DataFrame:
    source = df.select(F.col(doc).alias("doc_id"), F.col(host).alias("host"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    names = ["doc_id", "host", *NUMBERS, "text_hash", "lines", "line_words"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text", SLICE_BYTES):
                found = list(zip(*map(measure, part.column("_text").to_pylist())))
                columns = [part.column("doc_id"), part.column("host"), *(pa.array(c, pa.int64()) for c in found[:6])]
                columns += [pa.array(found[6], pa.list_(pa.int64())), pa.array(found[7], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (f"doc_id {kinds['doc_id']}, host {kinds['host']}, " + ", ".join(f"{n} bigint" for n in NUMBERS)
              + ", text_hash bigint, lines array<bigint>, line_words array<bigint>")
    return source.mapInArrow(compute, schema)


def common_lines(rows: DataFrame, limit: int) -> DataFrame:
    """(host, line, distinct_docs) of lines that recur in over ``limit`` distinct documents of a host.

    Copies of a text are one document, and a line counts once in it. Both aggregates combine before the shuffle, so neither a hot
    host nor a hot line or text gathers in a task.
    """
    documents = rows.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    lines = documents.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    return lines.groupBy("host", "line").agg(F.count("*").alias("distinct_docs")).where(F.col("distinct_docs") > limit)


def apply_rules(df: DataFrame, text: str = "text", doc: str = "doc_id", host: str = "source", limit: int = 10,
                least_left: float = 0.5) -> DataFrame:
    """One row per row of ``df``: doc_id, the base numbers, removed_words, base_failed and kept.

    base_failed: under 50 words, or over half of them in repeated windows. Otherwise a document is rejected if, without the
    lines of :func:`common_lines`, under ``least_left`` of its words are left. Runs jobs when called; stores numbers and hashes, no
    texts. Null and empty texts have no words and fail. A null host is a host. Repeated rows are answered each; no rows
    give none.
    """
    rows = materialise(measured(df, text, doc, host).withColumn("_row", F.monotonically_increasing_id()), "lines")
    common = materialise(common_lines(rows, limit).withColumnsRenamed({"host": "_host", "line": "_line"}).drop("distinct_docs"), "common")
    lines = rows.select("_row", "host", F.explode(F.arrays_zip(F.col("lines").alias("line"), F.col("line_words").alias("words"))).alias("_l")).select("_row", "host", "_l.*")
    hits = lines.join(common, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")), "left_semi")
    removed = hits.groupBy("_row").agg(F.sum("words").alias("removed_words"))
    judged = rows.drop("lines", "line_words", "text_hash").join(removed, "_row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words") >= F.lit(least_left) * F.col("n_words")
    return judged.select("doc_id", *NUMBERS, "removed_words", failed.alias("base_failed"), (~failed & left).alias("kept"))

