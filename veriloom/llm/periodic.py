"""Periodic runs of words by multi-scale minimizers.

A run is a maximal stretch whose words repeat at its smallest period q, at least three times over and LEAST words long. Periods
up to SHORT are found by comparing the words with themselves at each lag. Longer ones are found by scale: for periods from lo to hi
the words are hashed in grams of k = hi words, and the smallest hash of every w = 2 * lo + 1 - hi neighbouring grams is kept. A run of
period q holds two such windows q apart whatever its place, so it holds equal minimizers q apart; and as k >= q, the same gram stands
nowhere between them. So neighbouring equal minimizers seed every run; seeds are extended word by word, which decides. Where a
scale has no two equal minimizers, no longer period can be there either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import byte_slices

LEAST, TIMES = 24, 3
SHORT = LEAST // TIMES
WINDOW_BYTES = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
Run = tuple[int, int, int]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * np.uint64(0xBF58476D1CE4E5B9) + b)


def _sliding(x: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick over every ``width`` neighbours, in linear time: a window is the end of one block and the start of the next."""
    if width == 1:
        return x
    blocks = np.full(-(-len(x) // width) * width, fill, x.dtype)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, width)
    heads = pick.accumulate(blocks, axis=1).ravel()
    tails = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(tails[:len(x) - width + 1], heads[width - 1:len(x)])


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places of grams that are the smallest of some ``width`` neighbours."""
    low = _sliding(grams, width, np.minimum, np.iinfo(np.uint64).max)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), width, np.maximum, 0) == grams)


def _equal_from(ids: np.ndarray, a: int, b: int) -> int:
    """How many words from a on equal those from b on; b > a."""
    n, step = 0, 64
    while b + n < len(ids):
        size = min(step, len(ids) - b - n)
        same = ids[a + n:a + n + size] == ids[b + n:b + n + size]
        if not same.all():
            return n + int(same.argmin())
        n, step = n + size, step * 2
    return n


def _equal_before(ids: np.ndarray, a: int, b: int) -> int:
    """How many words before a equal those before b; b > a."""
    n, step = 0, 64
    while n < a:
        size = min(step, a - n)
        same = (ids[a - n - size:a - n] == ids[b - n - size:b - n])[::-1]
        if not same.all():
            return n + int(same.argmin())
        n, step = n + size, step * 2
    return n


def _smallest(block: np.ndarray) -> bool:
    """Whether the block isn't a shorter one repeated."""
    rest, p = len(block), 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            step = len(block) // p
            if np.array_equal(block[step:], block[:-step]):
                return False
            while rest % p == 0:
                rest //= p
        p += 1
    return True


def runs_of(ids: np.ndarray) -> list[Run]:
    """(start, length, period) of every run of the numbers ``ids``, by start, then period."""
    n, found = len(ids), []

    def keep(start: int, length: int, period: int) -> None:
        if length >= max(LEAST, TIMES * period) and _smallest(ids[start:start + period]):
            found.append((start, length, period))

    for q in range(1, min(SHORT, n // TIMES) + 1):
        same = ids[q:] == ids[:-q]
        if np.count_nonzero(same) < LEAST - q:
            continue
        steps = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        for start, end in zip(steps[::2].tolist(), steps[1::2].tolist()):
            keep(start, end - start + q, q)
    lo, span = SHORT + 1, 1
    level = _mixed(ids.astype(np.uint64) + np.uint64(1))
    while TIMES * lo <= n:
        hi = lo * 3 // 2
        while 2 * span <= hi:
            level, span = _joined(level[:-span], level[span:]), 2 * span
        grams = _joined(level[:n - hi + 1], level[hi - span:]) if hi > span else level
        at = minimizers(grams, 2 * lo + 1 - hi)
        values = grams[at]
        order = np.argsort(values, kind="stable")
        at, values = at[order], values[order]
        same = values[1:] == values[:-1]
        if not same.any():
            break
        apart = np.diff(at)
        seeds = np.flatnonzero(same & (apart >= lo) & (apart <= hi))
        order = np.lexsort((at[seeds], apart[seeds]))
        done, lag = 0, 0
        for p, q in zip(at[seeds][order].tolist(), apart[seeds][order].tolist()):
            if q == lag and p < done:  # inside the stretch that an earlier seed gave
                continue
            start, done, lag = p - _equal_before(ids, p, p + q), p + _equal_from(ids, p, p + q), q
            keep(start, done - start + q, q)
        lo = hi + 1
    return sorted(found)


def without_repeats(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay if every run keeps its first period only."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + WINDOW_BYTES)
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":  # never cut a word
            end += 1
        yield text[at:end].split()
        at = end


def collapse(text: bytes, places: Callable[[int], np.ndarray | None] = lambda n: None) -> tuple[int, list[Run], bytes]:
    """Number of words, runs and the text without their repeats. ``places(n)`` may give another order of the n words, by numbers."""
    known: dict[bytes, int] = {}
    parts = [np.zeros(0, np.int64)]
    for words in _words(text):
        for w in dict.fromkeys(words):
            known.setdefault(w, len(known))
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    ids = np.concatenate(parts)
    if (order := places(len(ids))) is not None:
        ids = ids[order]
    runs = runs_of(ids)
    kept, names = ids[without_repeats(len(ids), runs)] if runs else ids, list(known)
    lines = (b" ".join(map(names.__getitem__, kept[i:i + 65536].tolist())) for i in range(0, len(kept), 65536))
    return len(ids), runs, b" ".join(lines)


def find(df: DataFrame, text: str = "text", doc: str = "doc_id", places: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; in words, by start, then period) and collapsed, the words left with one space
    between them, of every row.

    ``places(doc_id, n)`` may give the order in which a row's n words are read. One pass without a shuffle; a text is read whole, in memory of
    its distinct words and eight bytes a word. Null and empty texts have no words, repeated rows are answered each, other columns are
    not read, no rows give none.
    """
    source = df.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    shape = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text", WINDOW_BYTES):
                ids = part.column("doc_id").to_pylist()
                got = [collapse(t, (lambda n, i=i: places(i, n)) if places else lambda n: None) for i, t in zip(ids, part.column("_text").to_pylist())]
                runs = [[dict(zip(("start", "length", "period"), r)) for r in found] for _, found, _ in got]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([n for n, _, _ in got], pa.int64()), pa.array(runs, shape),
                                                  pa.array([c for _, _, c in got], pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    return source.mapInArrow(compute, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed binary").withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones that with the smallest start, then period. Null if there is none."""
    def better(a: Column, b: Column) -> Column:  # runs come by start, then period: the earlier one wins a tie
        return F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)

    return F.when(F.size(runs) > 0, F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0), better))


def written(runs: Column) -> Column:
    """One line ``start,length,period`` a run."""
    numbers = lambda r: [r[k].cast("string") for k in ("start", "length", "period")]
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", *numbers(r)), F.lit("\n"))), "")
