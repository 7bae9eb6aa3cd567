"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``most``. Among all rates with which the words of its source come to the target, those closest
to 1 in relative entropy are min(most, exp(b * length)): the tilt of a convex dual in one variable per source, which safeguarded Newton
iterations solve for each source from the counts per length that Spark aggregates. Rates are rounded into copies so that a source's words
come within about one short document of its target.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.llm.common import WORD, join_same, rank_within
from veriloom.session import materialise


def targets(sources: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Sources in order of their name, null last, take the weights in turn and share ``share`` of all sizes; none gets over
    ``most`` times its size, the rest is shared again by weight. So a target is min(most * size, weight * level), and the level
    follows from running sums over the sources in the order in which they fill. Windows here see one row per source.
    """
    named = W.orderBy(F.col("source").asc_nulls_last())
    filled = W.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("source").asc_nulls_last())
    up_to, after = filled.rowsBetween(W.unboundedPreceding, -1), filled.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    turn = (F.row_number().over(named) - 1) % len(weights)
    rows = (sources.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
            .withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
            .withColumn("_all", F.lit(float(share)) * F.sum("source_size").over(everything))
            .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(up_to), F.lit(0.0))) / F.sum("_weight").over(after)))
    first = F.min_by("_level", F.when(F.col("_cap") > F.col("_weight") * F.col("_level"), F.col("_turn"))).over(everything)  # not full: shares the rest
    return (rows.withColumn("_turn", F.row_number().over(filled)).withColumn("_final", first)
            .withColumn("target", F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_weight") * F.col("_final"))))
            .drop("_weight", "_cap", "_all", "_level", "_turn", "_final"))


def tilt(n: np.ndarray, c: np.ndarray, wanted: float, most: float, tolerance: float, rounds: int) -> float:
    """b of one source: see :func:`solve`. The sum rises with b, so every round narrows a bracket; a Newton step that would leave it is
    replaced by its middle, or by a longer step while a side is open."""
    b, lo, hi = 0.0, -math.inf, math.inf
    words = n * c
    for _ in range(rounds):
        rate = np.exp(np.minimum(b * c, 700.0))
        off = float(np.sum(words * np.minimum(most, rate))) - wanted
        slope = float(np.sum(np.where(rate < most, words * c * rate, 0.0)))
        lo, hi = b if off <= 0 else lo, b if off >= 0 else hi
        if abs(off) <= tolerance * wanted:
            break
        step = b - off / slope if slope else math.nan
        if lo < step < hi and abs(step - b) <= 1 + 2 * abs(b):  # a flat place gives no long jump
            moved = step
        else:
            moved = hi - 1 - abs(hi) if lo == -math.inf else lo + 1 + abs(lo) if hi == math.inf else (lo + hi) / 2
        if moved == b:
            break
        b = moved
    return b


def solve(cells: DataFrame, wanted: DataFrame, most: float = 2.0, tolerance: float = 1e-12, rounds: int = 100) -> DataFrame:
    """(source, b) with sum(n * c * min(most, exp(b * c))) = words_wanted, c being the length in units of the source's mean.

    ``cells``: source, n, c; ``wanted``: source, words_wanted, above 0 and below what ``most`` copies of all give. A group holds a row for
    each length of a source, not for each document; sources are solved side by side, without a job a round.
    """
    kind = cells.schema["source"].dataType.simpleString()

    def per_source(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values("c")
        b = tilt(rows["n"].to_numpy(float), rows["c"].to_numpy(float), float(rows["words_wanted"].iloc[0]), most, tolerance, rounds)
        return rows.iloc[:1].assign(b=b)[["source", "b"]]

    return join_same(cells, wanted, ["source"]).groupBy("source").applyInPandas(per_source, f"source {kind}, b double")


def round_copies(sizes: list[int], counts: list[int], rates: list[float], most: int) -> tuple[list[int], list[int]]:
    """(copies of every document, documents with one more) per length, given in falling order.

    What a length leaves open or takes too much is passed on to the next shorter; a second walk gives or takes copies where that brings
    the sum still nearer. Copies stay within ``most`` and within one of the rate.
    """
    base = [min(int(r + 1e-9), most) for r in rates]
    room = [n if b < most else 0 for n, b in zip(counts, base)]
    more, open_words = [0] * len(sizes), 0.0
    for i, size in enumerate(sizes):
        open_words += counts[i] * (rates[i] - base[i]) * size
        more[i] = min(room[i], max(0, int(open_words / size + 0.5))) if size else 0
        open_words -= more[i] * size
    for i, size in enumerate(sizes):
        if size and rates[i] > base[i] + 1e-9:
            step = min(room[i] - more[i], int(open_words / size + 0.5)) if open_words > 0 else -min(more[i], int(-open_words / size + 0.5))
            more[i] += step
            open_words -= step * size
    return base, more


def _round(most: int):
    def per_source(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values("size", ascending=False)
        base, more = round_copies(rows["size"].tolist(), rows["n"].tolist(), rows["rate"].tolist(), most)
        return rows.assign(base=base, more=more)[["source", "size", "rate", "base", "more"]]

    return per_source


def mix(df: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source", weights: Sequence[float] = (5, 2, 1),
        share: float = 1.5, most: int = 2) -> DataFrame:
    """doc_id, source, size (words), source_size, target, rate, copies and taken of every row.

    Runs jobs when called; stores ids and sizes, never texts. The dual is solved on counts of documents per source and length.
    Which of equally long documents of a source get one copy more follows a hash of their ids, so reruns agree. A null text has size
    0, a null source is a source, repeated rows count as often as they occur, and no rows give no rows. Sources without words
    get nothing.
    """
    size = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    stored = materialise(df.select(F.col(doc).alias("doc_id"), F.col(source).alias("source"), size.alias("size")), "sizes")
    counted = materialise(stored.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    totals = counted.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    aims = materialise(targets(totals, weights, share, most), "targets")
    wanted = (aims.where("source_size > 0 AND target > 0").where(F.col("target") < F.lit(most * (1 - 1e-12)) * F.col("source_size"))
              .select("source", (F.col("docs") * F.col("target") / F.col("source_size")).alias("words_wanted")))
    full = F.when(F.col("source_size") > 0, float(most)).otherwise(0.0)  # no tilt: all of it as often as can be, or nothing to give
    joined = join_same(counted, aims, ["source"])
    cells = joined.select("source", "size", "n", F.coalesce(F.try_divide(F.col("size") * F.col("docs"), F.col("source_size")), F.lit(0.0)).alias("c"), full.alias("_full"))
    tilt = solve(cells.select("source", "n", "c"), wanted, most)
    rated = (join_same(cells, tilt, ["source"], "left")
             .select("source", "size", "n", F.coalesce(F.least(F.lit(float(most)), F.exp(F.least(F.col("b") * F.col("c"), F.lit(700.0)))), F.col("_full")).alias("rate")))
    kind = stored.schema["source"].dataType.simpleString()
    copies = rated.groupBy("source").applyInPandas(_round(most), f"source {kind}, size bigint, rate double, base int, more bigint")
    plan = join_same(copies, aims, ["source"])
    plan = materialise(plan.select("source", "size", "rate", "base", "more", "source_size", "target"), "mix")
    ranked = rank_within(stored, ["source", "size"], row=("doc_id",))
    taken = join_same(ranked, plan, ["source", "size"], hint="shuffle_merge")
    return (taken.withColumn("copies", F.col("base") + (F.col("rank") < F.col("more")).cast("int"))
            .select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def take(df: DataFrame, mixed: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The rows of ``df`` as often as ``mixed`` says. Rows of one id share what was planned for them, as evenly as can be."""
    rows = df.select(F.col(doc).alias("_id"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc"))
    per = mixed.groupBy(F.col("doc_id").alias("_id")).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    nth = F.row_number().over(W.partitionBy("_id").orderBy(F.xxhash64("_doc")))
    share = F.floor(F.col("_copies") / F.col("_rows")) + (nth <= F.col("_copies") % F.col("_rows")).cast("int")
    repeated = rows.join(per.hint("shuffle_merge"), "_id").withColumn("_share", share).where("_share > 0")
    return repeated.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("_share").cast("int")))).select("_doc.*")
