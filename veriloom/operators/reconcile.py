"""Does a copy equal its source? Each side is read once, whatever the number of columns and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriloom.operators.skew import small_side
from veriloom.session import materialise

ALL_CHECKS = ("column_checksums", "key_sums", "null_counts")


def column_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column, side) of columns only one side has. Metadata only."""
    s, t = set(source.columns), set(target.columns)
    rows = [(c, "source_only") for c in sorted(s - t)] + [(c, "target_only") for c in sorted(t - s)]
    return source.sparkSession.createDataFrame(rows, "column string, side string")


def _common(source: DataFrame, target: DataFrame, columns: Sequence[str] | None) -> list[str]:
    have = set(target.columns)
    return [c for c in (columns or source.columns) if c in have and c in source.columns]


def cell_checksum(c: Column, kind: T.DataType) -> Column:
    """32 bits of md5 over the value's text; floating values as fixed decimals, NULL as a text no value has."""
    text = c.cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.coalesce(F.round(c, 4).try_cast("decimal(38,4)").cast("string"), text)  # NaN and infinities keep their names
    text = F.when(c.isNull(), F.lit("\x00")).otherwise(text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _total(cell: Column) -> Column:
    """Exact sum of 64-bit integers. A plain 64-bit sum could overflow; the three 22-bit parts are summed as plain
    integers, safe for 2^41 rows, and put together as a decimal at the end."""
    part = [F.sum(F.shiftrightunsigned(cell, 22 * k).bitwiseAND(F.lit((1 << 22) - 1))).cast("decimal(38,0)") for k in range(3)]
    return part[0] + part[1] * F.lit(1 << 22) + part[2] * F.lit(1 << 44)


def _side(df: DataFrame, common: list[str], sums: list[str], tag: str, checks: Sequence[str], fast: bool) -> DataFrame:
    """One row per side: count, then per column checksum, NULL count and sum."""
    aggs: list[Column] = [F.count("*").alias("n")]
    for i, c in enumerate(common):
        kind = df.schema[c].dataType
        if "column_checksums" in checks:
            aggs.append(_total(F.xxhash64(c) if fast else cell_checksum(F.col(c), kind)).cast("string").alias(f"k{i}"))
        if "null_counts" in checks:
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"z{i}"))
    for i, c in enumerate(sums):
        aggs.append(F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(f"s{i}"))
    return df.agg(*aggs).withColumn("side", F.lit(tag))


def profile(source: DataFrame, target: DataFrame, key_columns: Sequence[str] = (), columns: Sequence[str] | None = None,
            checks: Sequence[str] = ALL_CHECKS, fast: bool = False) -> tuple[DataFrame, list[str], list[str]]:
    """Both sides' figures in a single row (columns prefixed s_ and t_), with the columns they cover."""
    common = _common(source, target, columns)
    sums = [c for c in key_columns if c in source.columns and c in target.columns] if "key_sums" in checks else []
    both = _side(source, common, sums, "source", checks, fast).unionByName(_side(target, common, sums, "target", checks, fast))
    names = [c for c in both.columns if c != "side"]
    picked = [F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{p}_{c}") for p, side in (("s", "source"), ("t", "target")) for c in names]
    return both.agg(*picked), common, sums


def row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    row, _, _ = profile(source, target, columns=(), checks=())
    return row.select(F.col("s_n").alias("source_rows"), F.col("t_n").alias("target_rows"), (F.col("s_n") == F.col("t_n")).alias("match"))


def _per_column(row: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    parts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s_{key}{i}").alias(f"source_{value}"), F.col(f"t_{key}{i}").alias(f"target_{value}"))
                      for i, c in enumerate(names)])
    return row.select(F.inline(parts))


def checksums(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None, fast: bool = False) -> DataFrame:
    """Checksum per common column over all rows, independent of their order. ``fast`` sums Spark's own 64-bit
    hash, cheaper than md5 but not reproducible outside Spark. Sums, not xors: equal values cancel in an xor."""
    row, common, _ = profile(source, target, (), columns, ("column_checksums",), fast)
    return _per_column(row, common, "k", "checksum").withColumn("match", F.col("source_checksum").eqNullSafe(F.col("target_checksum")))


def null_counts(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    row, common, _ = profile(source, target, (), columns, ("null_counts",))
    return _per_column(row, common, "z", "nulls").withColumn("match", F.col("source_nulls") == F.col("target_nulls"))


def _judge_sums(rows: DataFrame, tol: float) -> DataFrame:
    diff = F.abs(F.col("source_sum") - F.col("target_sum"))
    rel = diff / F.greatest(F.abs("source_sum"), F.lit(1.0))
    return rows.select("column", "source_sum", "target_sum", diff.alias("difference"), rel.alias("relative_difference"),
                       F.when(rel <= tol, "MATCH").otherwise("MISMATCH").alias("status"), (rel <= tol).alias("match"))


def key_sums(source: DataFrame, target: DataFrame, columns: Sequence[str], tol: float = 1e-4) -> DataFrame:
    """Sums per key column within a relative tolerance; a column missing on a side is reported and fails."""
    row, _, sums = profile(source, target, columns, (), ("key_sums",))
    return _judge_sums(_per_column(row, sums, "s", "sum"), tol).unionByName(_absent(source, columns, sums)) if len(sums) < len(columns) \
        else _judge_sums(_per_column(row, sums, "s", "sum"), tol)


def _absent(source: DataFrame, columns: Sequence[str], sums: list[str]) -> DataFrame:
    rows = [(c, 0.0, 0.0, 0.0, 0.0, "COLUMN_NOT_FOUND", False) for c in columns if c not in sums]
    return source.sparkSession.createDataFrame(
        rows, "column string, source_sum double, target_sum double, difference double, relative_difference double, status string, match boolean")


def reconcile(source: DataFrame, target: DataFrame, key_columns: Sequence[str] = (), tol: float = 1e-4,
              checks: Sequence[str] = ALL_CHECKS, columns: Sequence[str] | None = None, fast: bool = True) -> DataFrame:
    """One row: FAILED when counts differ, PARTIAL when a checksum or key sum does, else SUCCESS; with every
    discrepancy named. NULL counts are reported but do not change the status; the row count is always checked.
    Only equality matters here, so Spark's own 64-bit hash serves unless ``fast`` is off."""
    row, common, sums = profile(source, target, key_columns, columns, checks, fast)
    missing = [c for c in key_columns if c not in sums] if "key_sums" in checks else []

    def differing(key: str) -> Column:
        names = F.array(*[F.when(~F.col(f"s_{key}{i}").eqNullSafe(F.col(f"t_{key}{i}")), F.lit(c)) for i, c in enumerate(common)])
        return F.array_compact(names) if common else F.array().cast("array<string>")

    none = F.array().cast("array<string>")
    bad_sums = F.array_compact(F.array(*[
        F.when(F.abs(F.col(f"s_s{i}") - F.col(f"t_s{i}")) / F.greatest(F.abs(f"s_s{i}"), F.lit(1.0)) > tol, F.lit(c)) for i, c in enumerate(sums)],
        *[F.lit(c) for c in missing])) if sums or missing else none
    df = row.select(
        F.col("s_n").alias("source_row_count"), F.col("t_n").alias("target_row_count"),
        (differing("k") if "column_checksums" in checks else none).alias("bad_checksums"), bad_sums.alias("bad_sums"),
        (differing("z") if "null_counts" in checks else none).alias("bad_nulls"))
    count_ok = F.col("source_row_count") == F.col("target_row_count")
    sum_ok, sig_ok = F.size("bad_sums") == 0, F.size("bad_checksums") == 0
    found = F.array_compact(F.array(
        F.when(~count_ok, F.format_string("Row count mismatch: source=%d, target=%d", "source_row_count", "target_row_count")),
        F.when(~sig_ok, F.concat(F.lit("Column checksum mismatch: "), F.array_join("bad_checksums", ", "))),
        F.when(~sum_ok, F.concat(F.lit("Key sum mismatch: "), F.array_join("bad_sums", ", "))),
        F.when(F.size("bad_nulls") > 0, F.concat(F.lit("Null count mismatch: "), F.array_join("bad_nulls", ", ")))))
    return df.select(
        F.when(~count_ok, "FAILED").when(~(sum_ok & sig_ok), "PARTIAL").otherwise("SUCCESS").alias("status"),
        count_ok.alias("row_count_match"), "source_row_count", "target_row_count", sig_ok.alias("checksum_match"),
        sum_ok.alias("key_sums_match"), found.alias("discrepancies"))


def report(result: DataFrame, reconciliation_id: str, as_of: str) -> DataFrame:
    """The stored form, its details as JSON text."""
    return result.select(F.lit(reconciliation_id).alias("reconciliation_id"), "*", F.lit(as_of).cast("timestamp_ntz").alias("validated_at"),
                         F.to_json("discrepancies").alias("discrepancies_json")).drop("discrepancies")


def status_distribution(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))


def failed_results(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != "SUCCESS")


def recent_results(results: DataFrame, n: int = 20) -> DataFrame:
    return results.orderBy(F.col("validated_at").desc(), "task_id").limit(n)


#: Leaves of the digest; a differing leaf brings all its rows into the comparison. Where the rows it brings are more than so many a
#: leaf, they are digested again into leaves of about FINE rows.
LEAVES, MOST_LEAVES, MOST_ROWS, FINE = 1 << 16, 1 << 20, 16, 8


def digest(df: DataFrame, keys: Sequence[str], columns: Sequence[str], leaves: int = LEAVES, folder: str | None = None) -> DataFrame:
    """leaf, n and total: rows and sum of row hashes of each leaf, the rows whose keys' hash falls there.

    Sums take no order and add up, so digests of parts of a table (days, loads) can be stored and summed instead of read again. With
    ``folder``, a column the table is laid out by and that follows from the keys, a leaf lies in one folder.
    """
    if not 1 <= leaves <= MOST_LEAVES:
        raise ValueError(f"between 1 and {MOST_LEAVES} leaves")
    return _digest(_hashed(df, keys, columns, leaves), folder)


def _digest(hashed: DataFrame, folder: str | None = None) -> DataFrame:
    place = [F.col(folder)] if folder else []
    return hashed.groupBy(*place, "_leaf").agg(F.count("*").alias("n"), F.sum("_row").alias("total"))


def _hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], leaves: int) -> DataFrame:
    wide = F.xxhash64(*keys, *columns).cast("decimal(38,0)")
    return df.withColumns({"_leaf": F.pmod(F.xxhash64(*keys), F.lit(leaves)), "_row": wide})


def differing_leaves(source: DataFrame, target: DataFrame, folder: str | None = None) -> DataFrame:
    """Leaves (with their folder, if any) of two digests that don't agree."""
    return _differing(source, target, folder).drop("rows")


def _differing(source: DataFrame, target: DataFrame, folder: str | None = None) -> DataFrame:
    """Differing leaves, and the rows that both sides have there."""
    sign = lambda df, k: df.withColumns({"rows": F.col("n"), "n": F.col("n") * k, "total": F.col("total") * k})
    by = [folder, "_leaf"] if folder else ["_leaf"]
    both = sign(source, 1).unionByName(sign(target, -1))
    sums = [F.sum(c).alias(c) for c in ("n", "total", "rows")]
    return both.groupBy(*by).agg(*sums).where("n <> 0 OR total <> 0").select(*by, "rows")


def differing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, leaves: int = LEAVES,
                   folder: str | None = None) -> DataFrame:
    """Which rows differ: keys, kind (source_only, target_only, changed), source_rows, target_rows and differing_columns.

    Each side is digested in one pass that shuffles a row per leaf and task; then only rows of differing leaves are compared, so what is
    shuffled follows the differences. Where differences spread over so many leaves that these hold more than ``MOST_ROWS`` times ``leaves`` rows, those rows are
    digested once more into small leaves, which shuffles three numbers a row instead of a hash per column. With ``folder`` (see ``digest``) only the folders of such leaves are read again. Runs the jobs of the
    digests when called.

    Rows of a key are compared as multisets, so repeated keys are fine; NULL keys are keys and NULL equals NULL. Columns are named
    where both sides have equally many rows of the key; none are if only their combination differs. ``columns`` are by default all that both sides have
    besides the keys; the target's values are read as the source's types.
    """
    own = [c for c in _common(source, target, columns) if c not in keys and c != folder]
    kinds = {f.name: f.dataType for f in source.schema.fields}
    like = lambda c: F.col(c) if target.schema[c].dataType == kinds[c] else F.col(c).try_cast(kinds[c])
    extra = [folder] if folder else []
    sides = [source.select(*extra, *keys, *own), target.select(*extra, *[like(c).alias(c) for c in (*keys, *own)])]
    found = materialise(_differing(*[digest(x, keys, own, leaves, folder) for x in sides], folder), "leaves")
    if folder:  # the folders are few: the scan prunes by their names
        names = [r[0] for r in found.select(folder).distinct().collect()]
        sides = [x.where(F.col(folder).isin(names)) for x in sides]
    few = F.broadcast(found.select("_leaf").distinct())  # at most ``leaves`` integers
    hashed = [_hashed(x, keys, own, leaves).join(few, "_leaf", "left_semi") for x in sides]
    rows = found.agg(F.sum("rows")).first()[0] or 0
    if rows > MOST_ROWS * leaves:
        fine = F.pmod(F.xxhash64(*keys), F.lit(-(-rows // FINE)))
        hashed = [x.withColumn("_leaf", fine) for x in hashed]
        again = small_side(_differing(*map(_digest, hashed)).select("_leaf"), "fine_leaves")
        hashed = [x.join(again, "_leaf", "left_semi") for x in hashed]
    sums = {f"_d{i}": F.xxhash64(c).cast("decimal(38,0)") for i, c in enumerate(own)}

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*keys, F.lit(sign).alias("_sign"), (F.col("_row") * sign).alias("_row"), *[(c * sign).alias(n) for n, c in sums.items()])

    both = signed(hashed[0], 1).unionByName(signed(hashed[1], -1)).groupBy(*keys).agg(
        F.count_if(F.col("_sign") > 0).alias("source_rows"), F.count_if(F.col("_sign") < 0).alias("target_rows"), *[F.sum(n).alias(n) for n in ("_row", *sums)])
    differ = both.where("source_rows <> target_rows OR _row <> 0")
    named = F.array_compact(F.array(*[F.when(F.col(n) != 0, F.lit(c)) for n, c in zip(sums, own)])) if own else F.array().cast("array<string>")
    kind = F.when(F.col("target_rows") == 0, "source_only").when(F.col("source_rows") == 0, "target_only").otherwise("changed")
    return differ.select(*keys, kind.alias("kind"), "source_rows", "target_rows",
                         F.when(F.col("source_rows") == F.col("target_rows"), named).otherwise(F.array().cast("array<string>")).alias("differing_columns"))
