"""Features, z-scores and a distributed isolation forest for laboratory results."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.functions.parse import join_issues
from veriloom.operators.skew import (
    exact_percentiles, latest_per_key, previous_row, same_keys, small_side, trailing_count, with_group_stats,
)
from veriloom.session import materialise

FEATURES = ("result_value_numeric", "result_vs_reference_min_pct", "result_vs_reference_max_pct",
            "days_since_last_test", "test_frequency_30d", "percent_change_from_previous", "z_score_within_patient",
            "z_score_population")


def training_set(lab: DataFrame, patients: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Final numeric results of the last ``days`` days with birth date and gender."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_interval(days=F.lit(days))
    recent = lab.where(F.col("ResultValueNumeric").isNotNull() & (F.col("ResultStatus") == "FINAL")
                       & (F.col("ResultDate") >= start))
    who = patients.select("PatientId", "DateOfBirth", "Gender")
    return recent.select("ResultId", "PatientId", "TestCode", "ResultValueNumeric", "ResultDate", "ReferenceRangeMin",
                         "ReferenceRangeMax", "AbnormalFlag").join(who, "PatientId", "left")


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """0 where the deviation is unknown or zero."""
    return F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0))


def frequency(lab: DataFrame, days: int = 30) -> DataFrame:
    """Results of the patient and test in the preceding ``days`` days, the result itself included."""
    return trailing_count(lab, ["PatientId", "TestCode"], "ResultDate", days, 86400, "test_frequency_30d")


def patient_stats() -> dict[str, Column]:
    """Aggregates per patient and test, as ``stats`` of a previous-row pass."""
    return {"_pm": F.avg("ResultValueNumeric"), "_ps": F.stddev_samp("ResultValueNumeric")}


def population_stats(lab: DataFrame) -> DataFrame:
    """Mean and sample deviation per test, a small side. Pass a narrow frame: it is read in full here."""
    v = F.col("ResultValueNumeric")
    return small_side(lab.select("TestCode", "ResultValueNumeric").groupBy("TestCode").agg(
        F.avg(v).alias("_tm"), F.stddev_samp(v).alias("_ts")), "population")


def zscores(lab: DataFrame, population: DataFrame | None = None) -> DataFrame:
    """Deviation from the patient's own mean and from the test's population mean (sample deviation).

    Uses patient aggregates already on the rows, and computes them otherwise.
    """
    v = F.col("ResultValueNumeric")
    df = lab if "_pm" in lab.columns else with_group_stats(lab, ["PatientId", "TestCode"], **patient_stats())
    df = same_keys(df, population if population is not None else population_stats(lab), ["TestCode"], "left")
    return df.withColumns({
        "z_score_within_patient": F.coalesce(zscore(v, F.col("_pm"), F.col("_ps")), F.lit(0.0)),
        "z_score_population": F.coalesce(zscore(v, F.col("_tm"), F.col("_ts")), F.lit(0.0))}).drop("_pm", "_ps", "_tm", "_ts")


def features(lab: DataFrame) -> DataFrame:
    """The eight model features per result; NULL becomes 0."""
    base = lab.select("ResultId", "PatientId", "TestCode", "ResultDate", "ResultValueNumeric", "ReferenceRangeMin",
                      "ReferenceRangeMax")
    v = F.col("ResultValueNumeric")
    df = previous_row(base, ["PatientId", "TestCode"], ["ResultDate", "ResultId"], ["ResultValueNumeric", "ResultDate"],
                      stats=patient_stats())
    df = zscores(frequency(df), population_stats(base))

    def against(bound: str) -> Column:
        b = F.col(bound)
        return F.when(b > 0, (v - b) / b * 100).otherwise(F.lit(0.0))

    prev = F.col("_prev.ResultValueNumeric")
    raw = {
        "result_value_numeric": v,
        "result_vs_reference_min_pct": against("ReferenceRangeMin"),
        "result_vs_reference_max_pct": against("ReferenceRangeMax"),
        "days_since_last_test": F.coalesce(F.datediff("ResultDate", F.col("_prev.ResultDate")), F.lit(365)),
        "test_frequency_30d": F.col("test_frequency_30d"),
        "percent_change_from_previous": F.when(prev != 0, F.abs((v - prev) / prev * 100)).otherwise(F.lit(0.0)),
        "z_score_within_patient": F.col("z_score_within_patient"),
        "z_score_population": F.col("z_score_population"),
    }
    return df.select("ResultId", "PatientId", "TestCode", "ResultDate",
                     *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in raw.items()])


def zscore_anomaly(scored: DataFrame, z: float = 3.0) -> DataFrame:
    """Deterministic flag from the two z-scores."""
    score = F.greatest(F.abs("z_score_within_patient"), F.abs("z_score_population"))
    return scored.withColumn("AnomalyScore", score).withColumn("IsAnomaly", score > z)


def anomaly_reason(scored: DataFrame) -> DataFrame:
    """Why a flagged row stands out; NULL on rows that are not flagged."""
    text = join_issues(
        F.when(F.abs("z_score_within_patient") > 3, "Unusual for patient (z-score > 3)"),
        F.when(F.abs("z_score_population") > 3, "Unusual for population (z-score > 3)"),
        F.when(F.col("percent_change_from_previous") > 100, "Large change from previous result (>100%)"),
        F.when(F.abs("result_vs_reference_max_pct") > 200, "Far outside reference range (>200%)"))
    return scored.withColumn("AnomalyReason", F.when(F.col("IsAnomaly"), text))


def anomaly_summary(scored: DataFrame) -> DataFrame:
    return (scored.groupBy("TestCode").agg(
        F.count("*").alias("total_results"), F.count_if("IsAnomaly").alias("anomalies"),
        F.avg("AnomalyScore").alias("avg_score")).orderBy(F.col("anomalies").desc(), "TestCode"))


# ---- isolation forest -------------------------------------------------------------------------------

NODES = "tree int, node int, feature int, threshold double, size int"
MAX_MODEL_ROWS = 1_000_000  # nodes broadcast to score; 100 trees of 256 samples have at most 51 100


def average_path(n: float) -> float:
    """Expected path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, int, float, int]]:
    """Nodes (id, feature or -1, threshold, size) of one tree; children of i are 2i+1 and 2i+2."""
    out, todo = [], [(0, np.arange(len(x)), 0)]
    while todo:
        node, idx, depth = todo.pop()
        part = x[idx]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(idx) > 1 else np.array([], dtype=int)
        if depth >= limit or len(spread) == 0:
            out.append((node, -1, 0.0, len(idx)))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        left = part[:, f] < cut
        if not left.any():
            left = part[:, f] <= part[:, f].min()
        out.append((node, f, cut, len(idx)))
        todo += [(2 * node + 1, idx[left], depth + 1), (2 * node + 2, idx[~left], depth + 1)]
    return out


def forest_fit(feats: DataFrame, trees: int = 100, sample: int = 256, seed: int = 42,
               columns=FEATURES, n_rows: int | None = None) -> DataFrame:
    """Isolation trees as rows, one task per tree on its own sample.

    A hash draws about twice the wanted rows and deals them to the trees; the ``sample`` smallest draws per
    tree are kept. One hash per row decides at scale, so the scan stays cheap, no tree sees more than
    ``sample`` rows, and reruns repeat the choice. Small inputs are dealt several times over.
    """
    n = n_rows if n_rows is not None else feats.count()
    wanted = 2 * sample * trees
    copies = trees if n <= sample else max(1, math.ceil(wanted / n))
    top = 1 << 30
    bound = int(top * min(1.0, wanted / max(n, 1)))

    def deal(c: Column) -> Column:
        tree = c if n <= sample else F.pmod(F.xxhash64(F.col("ResultId"), c, F.lit(seed + 1)), F.lit(trees))
        draw = F.pmod(F.xxhash64(F.col("ResultId"), c, F.lit(seed)), F.lit(top))
        return F.struct(tree.cast("int").alias("tree"), draw.alias("draw"))

    dealt = F.filter(F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), deal), lambda x: x["draw"] < F.lit(bound))
    drawn = feats.select("ResultId", *columns, F.inline(dealt)).dropDuplicates(["tree", "ResultId"])
    sampled = latest_per_key(drawn, ["tree"], [F.col("draw"), F.col("ResultId")], sample)
    limit = math.ceil(math.log2(max(sample, 2)))
    names = list(columns)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["draw", "ResultId"])
        nodes = _grow(pdf[names].to_numpy(dtype=float), np.random.default_rng([seed, t]), limit)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "size"])
        out.insert(0, "tree", t)
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "size": "int32"})

    return sampled.groupBy("tree").applyInPandas(fit, NODES)


class Walker:
    """The trees as flat arrays. A leaf has no threshold, so a row that reached it stays; rows walk in blocks that fit a cache."""

    BLOCK = 1 << 13

    def __init__(self, rows: pd.DataFrame):
        trees = [g for _, g in rows.groupby("tree", sort=True)]
        self.trees, self.width = len(trees), int(rows["node"].max()) + 1
        at = np.concatenate([i * self.width + g["node"].to_numpy() for i, g in enumerate(trees)])
        model = pd.concat(trees)
        node, inner = model["node"].to_numpy(), model["feature"].to_numpy() >= 0
        tail = np.vectorize(average_path)(np.arange(int(model["size"].max()) + 1))
        self.feature = np.zeros(self.trees * self.width, np.intp)
        self.threshold, self.value = np.full(self.feature.shape, np.nan), np.zeros(self.feature.shape)
        self.left = np.arange(len(self.feature), dtype=np.intp)
        depth = np.floor(np.log2(node + 1.0))
        self.feature[at[inner]], self.threshold[at[inner]] = model["feature"].to_numpy()[inner], model["threshold"].to_numpy()[inner]
        self.left[at[inner]] = at[inner] + node[inner] + 1
        self.value[at] = depth + tail[model["size"].to_numpy()]
        self.levels = [int(np.log2(g["node"].max() + 1)) for g in trees]
        self.norm = average_path(float(np.mean([g.loc[g["node"] == 0, "size"].iloc[0] for g in trees])))

    def _score(self, total: np.ndarray) -> np.ndarray:
        return -np.power(2.0, -(total / self.trees) / self.norm)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._score(self._paths(x[i:i + self.BLOCK], None)) for i in range(0, len(x), self.BLOCK)] or [np.zeros(0)])

    def changed_scores(self, x: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Per row its score, then that with each feature in turn taken from ``other``."""
        blocks = [self._score(self._paths(x[i:i + self.BLOCK], other[i:i + self.BLOCK])) for i in range(0, len(x), self.BLOCK)]
        return np.concatenate(blocks, axis=1).T if blocks else np.zeros((0, x.shape[1] + 1))

    def _paths(self, x: np.ndarray, other: np.ndarray | None) -> np.ndarray:
        """Sums of path lengths over the trees. With ``other`` a row walks a tree once: a replaced feature only matters from the first node
        that tests it and decides otherwise, and walks on from there by itself."""
        (n, k), feature, threshold, left = x.shape, self.feature, self.threshold, self.left
        values = np.ascontiguousarray(x if other is None else np.hstack([x, other])).ravel()
        wide = k if other is None else 2 * k
        rows = np.arange(n, dtype=np.intp)
        start = rows * wide
        total = np.zeros(n if other is None else (k + 1, n))
        for t, levels in enumerate(self.levels):
            at = np.full(n, t * self.width, np.intp)
            parted, off = [], np.zeros((n, k), bool)
            for _ in range(levels):
                f, cut, child = feature.take(at), threshold.take(at), left.take(at)
                place = start + f
                right = values.take(place) >= cut
                if other is not None:
                    r = np.flatnonzero((values.take(place + k) >= cut) != right)
                    r = r[~off[r, f[r]]]
                    off[r, f[r]] = True
                    parted.append((r, f[r], child[r] + ~right[r]))
                at = child + right
            if other is None:
                total += self.value.take(at)
                continue
            own = np.tile(self.value.take(at), (k + 1, 1))
            if parted:
                r, which, away = map(np.concatenate, zip(*parted))
                self._walk_on(values, r * wide, which, away, k)
                own[which + 1, r] = self.value.take(away)
            total += own
        return total

    def _walk_on(self, values: np.ndarray, start: np.ndarray, which: np.ndarray, at: np.ndarray, k: int) -> None:
        """Move ``at`` to the leaves, feature ``which`` read from the other values."""
        open_ = np.flatnonzero(self.left.take(at) != at)
        while len(open_):
            here = at[open_]
            f = self.feature.take(here)
            v = values.take(start[open_] + f + k * (f == which[open_]))
            at[open_] = here = self.left.take(here) + (v >= self.threshold.take(here))
            open_ = open_[self.left.take(here) != here]


def _walker(model: DataFrame):
    """The model, its size checked, to be shipped to the tasks."""
    rows = model.limit(MAX_MODEL_ROWS + 1).toPandas()
    if len(rows) > MAX_MODEL_ROWS:
        raise ValueError("model too large to ship to the tasks")
    return model.sparkSession.sparkContext.broadcast(Walker(rows))


def forest_scores(feats: DataFrame, model: DataFrame, columns=FEATURES) -> DataFrame:
    """``AnomalyScore`` in [-1, 0): the lower, the more anomalous."""
    walker = _walker(model)

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        return pd.Series(walker.value.scores(np.column_stack([s.to_numpy(dtype=float) for s in cols])))

    return feats.withColumn("AnomalyScore", score(*[F.col(c) for c in columns]))


def forest_flag(scored: DataFrame, contamination: float = 0.05) -> DataFrame:
    """IsAnomaly for scores below the ``contamination`` quantile, found without sorting the scores in one task."""
    cut = exact_percentiles(scored, [], "AnomalyScore", {"_cut": contamination}).scalar()
    return scored.withColumn("IsAnomaly", F.col("AnomalyScore") < cut)


HASH_BITS = 62


def dense_numbers(df: DataFrame, key: str, seed: int, name: str, bucket_rows: int = 1 << 16) -> DataFrame:
    """Number the rows from 0 without gaps along a seeded hash of ``key``; ties by the other columns. Runs a job: rows are counted.

    Buckets are ranges of the hash, so the numbers don't depend on how many there are; each is one window, shifted by the
    rows of the buckets before it.
    """
    bits = max(0, math.ceil(math.log2(max(1, df.count() / bucket_rows))))
    cut = df.withColumn("_h", F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 64 - HASH_BITS)).withColumn("_b", F.shiftright("_h", HASH_BITS - bits))
    before = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)  # one row per bucket
    offsets = cut.groupBy("_b").count().select("_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_b").orderBy("_h", key, *[c for c in df.columns if c != key])
    numbered = cut.withColumn("_i", F.row_number().over(inside) - 1).join(offsets, "_b")
    return numbered.withColumn(name, F.col("_i") + F.col("_offset")).drop("_h", "_b", "_i", "_offset")


def repaired(feats: DataFrame, columns=FEATURES, key: str = "ResultId", seed: int = 42, bucket_rows: int = 1 << 16) -> DataFrame:
    """Rows with ``columns`` and, as ``_other_<column>``, the value of another row: feature k takes that of the row k places ahead in a
    seeded random order, the last rows those of the first. Every value is used once per feature, whatever the number of rows.

    All features move by small steps along one order, so a row's values lie in its own stretch of that order or in the first rows of
    the next, which are copied to it: one shuffle for all features, windows of bounded size and no join.
    """
    reach = len(columns)
    rows = materialise(dense_numbers(feats.select(key, *columns), key, seed, "_p", bucket_rows), "numbered")
    n = rows.count()
    turns = math.ceil(reach / n) if n else 0
    again = rows.where(F.col("_p") < reach).select("*", F.explode(F.sequence(F.lit(1), F.lit(turns))).alias("_turn")) if n else rows.withColumn("_turn", F.lit(1))
    line = rows.withColumn("_own", F.lit(True)).unionByName(
        again.withColumn("_p", F.col("_p") + F.col("_turn") * F.lit(n)).drop("_turn").withColumn("_own", F.lit(False)))
    stretch = line.withColumn("_s", F.floor(F.col("_p") / F.lit(bucket_rows)))
    copies = stretch.where((F.col("_p") % bucket_rows < reach) & (F.col("_s") > 0)).withColumn("_s", F.col("_s") - 1).withColumn("_own", F.lit(False))
    ahead = W.partitionBy("_s").orderBy("_p")
    moved = stretch.unionByName(copies).withColumns({f"_other_{c}": F.lead(c, k).over(ahead) for k, c in enumerate(columns, 1)})
    return moved.where("_own").drop("_own", "_s", "_p")


def permutation_importance(feats: DataFrame, model: DataFrame, columns=FEATURES) -> DataFrame:
    """(feature, importance): mean absolute score change when a feature's values are re-paired (see :func:`repaired`), normalised. One
    pass scores the rows as they are and with each feature replaced."""
    walker, k = _walker(model), len(columns)

    @F.pandas_udf(", ".join(f"`{c}` double" for c in columns))
    def changes(*cols: pd.Series) -> pd.DataFrame:
        x = np.column_stack([s.to_numpy(dtype=float) for s in cols])
        scores = walker.value.changed_scores(x[:, :k], x[:, k:])
        return pd.DataFrame(np.abs(scores[:, 1:] - scores[:, :1]), columns=list(columns))

    scored = repaired(feats, columns).select(changes(*[F.col(c) for c in columns], *[F.col(f"_other_{c}") for c in columns]).alias("_change"))
    change = scored.agg(*[F.avg(F.col(f"_change.{c}")).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0.0))
    return change.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.try_divide(F.col(c), total).alias("importance")) for c in columns])))
