"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, and a linear hinge-loss model on them, fitted by
dual coordinate descent.

n-grams are taken over words and over their shapes (case, digits, closing punctuation, repetition), hashed into DIMENSIONS indicators.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import bounded_sample, byte_slices

BITS = 18
DIMENSIONS = 1 << BITS
SAMPLE = 10_000
SLICE_BYTES = 4 << 20
#: Of the memo of a worker, some 35 MB; words of over MEMO_WORD characters don't enter it.
MEMO_ENTRIES, MEMO_WORD = 60_000, 64
_memo: dict[str, tuple[int, int]] = {}


def _word(word: str) -> tuple[int, int]:
    """A hash of the lower-cased word, and its shape: case, digits, last character, length class; under 512."""
    from xxhash import xxh32_intdigest

    if (found := _memo.get(word)) is None:
        if len(_memo) >= MEMO_ENTRIES:
            _memo.clear()
        letters = [c for c in word if c.isalpha()]
        upper = sum(c.isupper() for c in letters)
        case = 0 if not letters else 1 if not upper else 2 if upper == 1 and word[:1].isupper() else 3 if upper == len(letters) else 4
        last = word[-1]
        end = 0 if last.isalnum() else 1 if last == "." else 2 if last == "," else 3 if last in "!?" else 4 if last in ";:)\"'" else 5
        digits = any(c.isdigit() for c in word)
        size = min(len(word) // 8, 3)
        found = (xxh32_intdigest(word.lower().encode("utf-8", "surrogatepass")), ((case * 6 + end) * 2 + digits) * 4 + size)
        if len(word) <= MEMO_WORD:
            _memo[word] = found
    return found


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    h = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: str | None) -> np.ndarray:
    """The sorted indicators of a whole text; none for a null or empty one."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int32)
    codes = np.array(list(map(_word, words)), dtype=np.uint64)
    ids, shape = codes[:, 0], codes[:, 1] << np.uint64(1)
    shape[1:] |= (ids[1:] == ids[:-1]).astype(np.uint64)  # the word before again
    out = [_mix(ids, 1), _mix(shape, 2)]
    if len(words) > 1:
        out += [_mix(ids[:-1] * np.uint64(0x100000001B3) ^ ids[1:], 3), _mix(shape[:-1] << np.uint64(10) | shape[1:], 4)]
    if len(words) > 2:
        out.append(_mix(shape[:-2] << np.uint64(20) | shape[1:-1] << np.uint64(10) | shape[2:], 5))
    return np.unique(np.concatenate(out))


class Model(NamedTuple):
    """weights[f] = coordinate times log-count ratio; scales[f] its square, for unit length; score = 1 / (1 + exp(-(slope * margin + shift)))."""

    weights: np.ndarray
    scales: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        length = float(self.scales[found].sum()) ** 0.5
        return float(self.weights[found].sum()) / length + self.bias if length else self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    p, q = np.full(DIMENSIONS, smoothing), np.full(DIMENSIONS, smoothing)
    for found, y in zip(rows, labels):
        (p if y > 0 else q)[found] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: np.ndarray, rounds: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model: exact minimisation over one dual variable at a time, in random order, each between 0
    and its cost; a constant feature carries the bias."""
    rng = np.random.default_rng(seed)
    w, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(rows)):
            found, v, y = rows[i], values[i], labels[i]
            slack = y * (float(w[found] @ v) + bias) - 1
            new = min(max(alpha[i] - slack / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y
            if step:
                w[found] += step * v
                bias += step
                most = max(most, abs(step))
                alpha[i] = new
        if most < 1e-3:
            break
    return w, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from margins to the probability of label 1, by Newton steps with smoothed targets."""
    n1, n0 = (labels > 0).sum(), (labels <= 0).sum()
    t = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (p - t) + 1e-6 * beta)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, fold: int = 5) -> Model:
    """``labels`` are 1 and -1. One row in ``fold`` is left for the calibration. With one label only, every score is its smoothed share."""
    zero = np.zeros(DIMENSIONS)
    n1, n0 = int((labels > 0).sum()), int((labels <= 0).sum())
    if min(n1, n0) < 2 * fold:
        return Model(zero, zero, 0.0, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    spare = np.zeros(len(rows), bool)
    for y in (1, -1):  # both labels in both parts
        spare[np.flatnonzero(labels == y)[::fold]] = True
    inner = [i for i in range(len(rows)) if not spare[i]]
    ratio = log_count_ratios([rows[i] for i in inner], labels[inner])
    scales = ratio * ratio

    def unit(found: np.ndarray) -> np.ndarray:
        return ratio[found] / max(float(scales[found].sum()) ** 0.5, 1e-12)

    share = {1: cost * len(inner) / (2 * (labels[inner] > 0).sum()), -1: cost * len(inner) / (2 * (labels[inner] <= 0).sum())}
    w, bias = descend([rows[i] for i in inner], [unit(rows[i]) for i in inner], labels[inner], np.array([share[int(y)] for y in labels[inner]]))
    model = Model(w * ratio, scales, bias, 1.0, 0.0)
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(spare)])
    return model._replace(**dict(zip(("slope", "shift"), calibrate(margins, labels[spare]))))


def held_out(doc: str, parts: int = 5):
    """Whether the row belongs to the fold that no fit sees; rows without an id don't."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % parts == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc: str = "doc_id", sample: int = SAMPLE, parts: int = 5) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fold, those with the smallest hashes of their ids.

    The bound is a parameter; at about 700 indicators a document the default is some 30 MB on the driver. Labels that are null or of null
    ids are left out. Of several texts of one id and label that with the smallest features is taken, so no id crowds out others.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull() & ~held_out(doc, parts)).select(F.col(doc).alias("_id"), (F.col(label) > 0).alias("_y"))
    chosen = bounded_sample(known, sample, "_id", "_y")
    rows = docs.select(F.col(doc).alias("_id"), F.col(text).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")  # at most ``sample`` rows of two numbers

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text", SLICE_BYTES):
                found = [features(t).tobytes() for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"id": part.column("_id").cast(pa.string()), "y": part.column("_y"), "f": pa.array(found, pa.binary())})

    each = rows.mapInArrow(extract, "id string, y boolean, f binary").groupBy("id", "y").agg(F.min("f").alias("f"))
    got = each.toArrow()  # a row per (id, label) chosen: at most ``sample``
    got = got.take(pc.sort_indices(got, [("id", "ascending"), ("y", "ascending")]))
    return fit([np.frombuffer(b.as_py(), np.int32) for b in got.column("f")], np.where(np.array(got.column("y").to_pylist(), bool), 1, -1))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """Columns ``keep`` and the score of every row's whole text. Null and empty texts get that of the bias."""
    held = [f"k{i}" for i in range(len(keep))]  # whatever the columns are called
    source = docs.select(*[F.col(f"`{k}`").alias(h) for k, h in zip(keep, held)], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.drop("_text").schema.fields)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB, whatever the data

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in byte_slices(batch, "_text", SLICE_BYTES):
                found = [known.score(features(t)) for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(h) for h in held), pa.array(found, pa.float64())], [*held, "score"])

    return source.mapInArrow(compute, f"{schema}, score double").toDF(*keep, name)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc: str = "doc_id", least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row. Runs a job for the fit. No rows give none; repeated rows are scored each."""
    model = train(docs, labels, label, text, doc)
    scored = score(docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
