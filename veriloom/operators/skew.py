"""Window-like operators whose tasks stay bounded when one key holds a large share of the rows.

A plain window on a key sends that key to one task. Here a key is cut along time into buckets: each
(key, bucket) is its own window partition, and what crosses a bucket border is carried over as one
summary row per bucket. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.session import materialise

MICROS = 1_000_000
MAX_BROADCAST_BYTES = 32 << 20


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def time_bucket(ts: Column, seconds: int) -> Column:
    return F.floor(micros(ts) / F.lit(seconds * MICROS))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same names in which NULL equals NULL, as in windows and groups. ``right``'s keys are dropped; the
    left ones are kept, so ``how`` is inner, left or a semi or anti join."""
    names = {k: f"_same{i}" for i, k in enumerate(keys)}
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(right.withColumnsRenamed(names), cond, how).drop(*names.values())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in ``order``.

    Spark prunes such a rank filter before the shuffle, so a hot key sends at most n rows per task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                 bucket_seconds: int = 7 * 86400, name: str = "_prev", stats: dict[str, Column] | None = None) -> DataFrame:
    """Add struct ``name`` with ``values`` of the preceding row of the key; NULL struct on the first row.

    ``order[0]`` is a timestamp; the remaining columns break ties and must make the order total. ``stats`` adds
    aggregates over the whole key: they travel with the carried rows, so the data itself is not shuffled again.
    """
    cut = df.withColumn("_bucket", time_bucket(F.col(order[0]), bucket_seconds))
    kept = F.struct(*values)
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order)
    lagged = cut.withColumn("_in", F.lag(kept).over(inside))
    last = cut.groupBy(*keys, "_bucket").agg(F.max_by(kept, F.struct(*order)).alias("_last"))
    between = W.partitionBy(*keys).orderBy("_bucket")
    carry = last.select(*keys, "_bucket", F.lag("_last").over(between).alias("_carry"))
    if stats:
        carry = same_keys(carry, df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()]), list(keys))
    joined = same_keys(lagged, carry, [*keys, "_bucket"], "left")
    return joined.withColumn(name, F.coalesce("_in", "_carry")).drop("_in", "_carry", "_bucket")


def trailing_count(df: DataFrame, keys: Sequence[str], ts: str, steps: int, step_seconds: int,
                   name: str) -> DataFrame:
    """Rows of the key in [ts - steps*step_seconds, ts], the row itself and its ties included.

    Split three ways: rows of the own step up to now, whole steps in between from per-step counts, and
    rows of the oldest step, brought in as copies shifted forward by the width.
    """
    step = step_seconds * MICROS
    width = steps * step
    base = df.withColumn("_t", micros(F.col(ts))).withColumn("_step", F.floor(F.col("_t") / F.lit(step)))
    ghosts = base.select(*keys, (F.col("_t") + width).alias("_t"), (F.col("_step") + steps).alias("_step"),
                         F.lit(1).alias("_ghost"))
    both = base.withColumn("_ghost", F.lit(0)).unionByName(ghosts, allowMissingColumns=True)
    cell = W.partitionBy(*keys, "_step").orderBy("_t")
    own = F.sum(1 - F.col("_ghost")).over(cell.rangeBetween(W.unboundedPreceding, 0))
    old = F.sum("_ghost").over(cell.rangeBetween(0, W.unboundedFollowing))
    counted = both.withColumn("_own", own).withColumn("_old", old).where("_ghost = 0").drop("_ghost")
    per_step = base.groupBy(*keys, "_step").agg(F.count("*").alias("_n"))
    whole = W.partitionBy(*keys).orderBy("_step").rangeBetween(-(steps - 1), -1)
    between = (per_step.withColumn("_mid", F.coalesce(F.sum("_n").over(whole), F.lit(0))).drop("_n")
               if steps > 1 else per_step.select(*keys, "_step", F.lit(0).alias("_mid")))
    return (same_keys(counted, between, [*keys, "_step"], "left")
            .withColumn(name, F.col("_own") + F.col("_old") + F.col("_mid"))
            .drop("_own", "_old", "_mid", "_t", "_step"))


def exact_positions(df: DataFrame, by: Sequence[str], value: str, wanted: dict[str, tuple[float, Column]],
                    accuracy: int = 20_000) -> DataFrame:
    """Order statistics per group without sorting a group in one task. Runs jobs when called: stores one row per group, and the few
    rows near the positions. The input is read twice, by the sketch and by the counts around its brackets.

    ``wanted`` maps an output name to (fraction near the position, 0-based position as a function of
    column ``_total``); fractional positions interpolate linearly. A mergeable sketch brackets each position. Rows
    outside a bracket are only counted, in the tasks that read them; those inside, a share of about 6 / accuracy, are
    shuffled and ranked, by ranges of values.
    """
    group, names = list(by), list(wanted)
    present = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"))
    margin = 3.0 / accuracy
    fractions = [f for n in names for f in (max(0.0, wanted[n][0] - margin), min(1.0, wanted[n][0] + margin))]
    sketch = present.groupBy(*group).agg(F.percentile_approx("_v", fractions, accuracy).alias("_cuts"), F.count("*").alias("_total"))
    if group:
        marked = same_keys(present, small_side(sketch, "sketch"), group)
    else:  # one row for all: a scalar, as a join without keys would be a cross join
        marked = present.withColumn("_s", sketch.agg(F.first(F.struct("_cuts", "_total"))).scalar()).select("_v", "_s.*")
    v, cuts = F.col("_v"), F.col("_cuts")
    side = F.array(*[F.when(v < cuts[2 * i], -1).when(v > cuts[2 * i + 1], 1).otherwise(0) for i in range(len(names))])
    # one pass: a row outside all brackets only counts for its place among them, one inside any is kept with its value
    placed = marked.select(*group, "_v", side.alias("_side"))
    reduced = materialise(placed.groupBy(*group, "_side", F.when(F.array_contains("_side", 0), v).alias("_in")).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")), "brackets")
    each = reduced.select(*group, "_in", "_n", "_least", "_most", F.posexplode("_side").alias("_i", "_at")).withColumn("_name", F.array(*map(F.lit, names))[F.col("_i")])
    # a fractional position may need the neighbour just outside the bracket
    sides = each.groupBy(*group, "_name").agg(
        F.sum("_n").alias("_total"), F.sum(F.when(F.col("_at") < 0, F.col("_n")).otherwise(0)).alias("_below"),
        F.max(F.when(F.col("_at") < 0, F.col("_most"))).alias("_under"), F.min(F.when(F.col("_at") > 0, F.col("_least"))).alias("_over"))
    where = F.coalesce(*[F.when(F.col("_name") == n, wanted[n][1].cast("double")) for n in names])
    sides = sides.withColumn("_pos", where).drop("_total")
    inside = each.where("_at = 0").groupBy(*group, "_name", F.col("_in").alias("_v")).agg(F.sum("_n").alias("_n"))
    ranked = running_weight(inside, [*group, "_name"], "_v", "_n")
    placed = same_keys(ranked, sides, [*group, "_name"])

    def at(place: Column) -> Column:
        k = place - F.col("_below")
        return F.max(F.when((k >= F.col("_before")) & (k < F.col("_before") + F.col("_n")), v))

    found = placed.groupBy(*group, "_name").agg(
        at(F.floor("_pos")).alias("_lo"), at(F.ceil("_pos")).alias("_hi"), F.first("_pos").alias("_pos"),
        F.first("_below").alias("_below"), F.first("_under").alias("_under"), F.first("_over").alias("_over"))
    low = F.coalesce("_lo", F.when(F.floor("_pos") < F.col("_below"), F.col("_under")).otherwise(F.col("_over")))
    high = F.coalesce("_hi", F.when(F.ceil("_pos") < F.col("_below"), F.col("_under")).otherwise(F.col("_over")))
    valued = found.withColumn("_x", low + (high - low) * (F.col("_pos") - F.floor("_pos")))
    wide = valued.groupBy(*group).agg(*[F.max(F.when(F.col("_name") == n, F.col("_x"))).alias(n) for n in names])
    return wide.select(*by, *names)


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Linear-interpolation percentiles (inclusive definition), exact."""
    last = F.col("_total") - 1
    return exact_positions(df, by, value, {n: (q, last * F.lit(q)) for n, q in qs.items()})


def running_weight(df: DataFrame, by: Sequence[str], value: str, weight: str, name: str = "_before") -> DataFrame:
    """Add the total weight of the group's rows with smaller ``value``; one row per (group, value) expected.

    Rows are range-partitioned by (group, value) and stored once, which fixes their partition numbers;
    a group may span any number of partitions. Offsets come from one row per (group, partition).
    """
    group = list(by)
    ordered = df.repartitionByRange(*group, value).withColumn("_part", F.spark_partition_id())
    stored = materialise(ordered, "ranked")
    inside = W.partitionBy(*group, "_part").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    local = stored.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    totals = stored.groupBy(*group, "_part").agg(F.sum(weight).alias("_w"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*group, "_part", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_offset"))
    return (same_keys(local, offsets, [*group, "_part"])
            .withColumn(name, F.col("_local") + F.col("_offset")).drop("_local", "_offset", "_part"))


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Join group aggregates back. The aggregate combines map-side; adaptive execution broadcasts it when
    it turns out small and splits hot keys otherwise, which a window over the key could not."""
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return same_keys(df, totals, list(keys), "left")


def small_side(df: DataFrame, name: str = "small") -> DataFrame:
    """A reduced frame for joining to a large one: stored once when called, measured, and broadcast only if it is small. Left to
    itself the planner would shuffle the large side before learning the size of the other. The size is that of the rows as
    text, which bounds numbers and texts alike."""
    stored = materialise(df, name)
    size = stored.agg(F.sum(F.length(F.to_json(F.struct("*"))) + 16 * len(stored.columns))).first()[0]
    return F.broadcast(stored) if (size or 0) <= MAX_BROADCAST_BYTES else stored
