"""Large JSON documents, read by many tasks.

A document is one array of records, or an object that holds such an array as a member, spread over any number of lines; Spark's reader gives
each file to one task. Here a file is read as text cut at every closing brace, which any task can do from any byte on. Whether a brace
stands in a string, and how deep, depends on all before it; both add up over the pieces: quotes without escaped ones switch between inside and outside,
opening braces outside strings go down, closing ones up. So every byte range is summed on its own, both as if it started inside a string and as if outside;
the ranges' sums, one row each, are added in order, and a second reading knows the state in which each range starts. No text is shuffled or stored,
but for records cut by braces of their own, whose pieces are put together again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.session import materialise

PLACE = ["_file", "_block"]


def _with_sum_before(df: DataFrame, value: Column, name: str) -> DataFrame:
    """The sum of ``value`` over all earlier pieces of the file: over the ranges before, one row each, and inside the range."""
    ranges = df.groupBy(*PLACE).agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    offsets = ranges.select(*PLACE, F.coalesce(before, F.lit(0)).alias("_offset"))
    inside = F.sum(value).over(W.partitionBy(*PLACE).orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
    return df.join(offsets, PLACE).withColumn(name, F.col("_offset") + F.coalesce(inside, F.lit(0))).drop("_offset")


def _split(spark: SparkSession, path: str) -> DataFrame:
    """The files' text in pieces that end at a closing brace, in the order of each byte range: with their quotes, and the braces they open if
    they start outside or inside a string."""
    raw = spark.read.option("lineSep", "}").text(path)
    placed = raw.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.file_size").alias("_size"))
    bare = F.when(F.col("value").contains("\\"), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))  # a quote after a backslash ends no string
    number = lambda c, mark: F.octet_length(c) - F.octet_length(F.replace(c, F.lit(mark), F.lit("")))
    opened = F.when(F.col("_braces") > 0, number(F.regexp_replace("_bare", '"[^"]*("|$)', ""), "{")).otherwise(0)
    counted = placed.withColumn("_bare", bare).withColumns({"_quotes": number(F.col("_bare"), '"'), "_braces": number(F.col("_bare"), "{")}).withColumn("_open0", opened)
    # a brace is outside strings in exactly one of the two cases
    return counted.withColumns({"_open1": F.col("_braces") - F.col("_open0"), "_bytes": F.octet_length("value").cast("bigint") + 1}).drop("_bare", "_braces")  # the brace that was cut off


def _outside(inside: bool) -> Column:
    """A piece's text from where it is outside a string."""
    return F.regexp_replace("value", r'(?s)^(?:[^"\\]++|\\.)*+("|$)', "") if inside else F.col("value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """The batches cut where another byte range starts, and whether one does."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block, file = batch.column("_block"), batch.column("_file")
        other = pc.or_(pc.not_equal(block[1:], block[:-1]), pc.not_equal(file[1:], file[:-1]))
        cuts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            own = (file[start].as_py(), block[start].as_py())
            yield batch.slice(start, end - start), own != last
            last = own


def _states(run: pa.RecordBatch, quotes: int, depth: int) -> tuple[np.ndarray, ...]:
    """For each piece: whether it starts inside a string, the depth at which it starts, what it opens, and whether its own brace closes."""
    own = {k: run.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("_quotes", "_open0", "_open1")}
    after = quotes + np.cumsum(own["_quotes"])
    inside = (after - own["_quotes"]) % 2 == 1
    opens, closes = np.where(inside, own["_open1"], own["_open0"]), (after % 2 == 0).astype(np.int64)
    return inside, depth + np.cumsum(opens - closes) - (opens - closes), opens, closes


_MARKS = ["_starts0", "_starts1", "_ends0", "_ends1"]
_SUMMED = "_file string, _block bigint, _at bigint, _quotes bigint, _depth0 bigint, _depth1 bigint, _bytes bigint, _size bigint, " + ", ".join(f"{m} boolean" for m in _MARKS)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per byte range one row without marks, its sums (``_at``: its pieces); and the pieces with marks, their place and the sums before them."""
    names, held = [c.split()[0] for c in _SUMMED.split(", ")], None

    def row(x: dict) -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * 7, *[pa.bool_()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([x.get(n)], k) for n, k in zip(names, kinds)], names)

    for run, fresh in _runs(batches):
        if fresh:
            if held:
                yield row(held)
            held = {**{k: run.column(k)[0].as_py() for k in ("_file", "_block", "_size")}, **dict.fromkeys(("_at", "_quotes", "_depth0", "_depth1", "_bytes"), 0)}
        marks = np.array([run.column(m).to_numpy(zero_copy_only=False) for m in _MARKS], bool).any(axis=0)
        found = [_states(run, held["_quotes"] + h, held[f"_depth{h}"]) for h in (0, 1)]
        if len(at := np.flatnonzero(marks)):
            some = run.take(pa.array(at))
            numbers = {"_at": held["_at"] + at, "_quotes": np.zeros(len(at), np.int64), "_depth0": found[0][1][at], "_depth1": found[1][1][at]}
            # which of the two states a mark holds for is told from the range's start, so the marks are turned to it
            turned = found[0][0][at]
            both = {m: some.column(m).to_numpy(zero_copy_only=False).astype(bool) for m in _MARKS}
            for k in ("_starts", "_ends"):
                numbers |= {f"{k}0": np.where(turned, both[f"{k}1"], both[f"{k}0"]), f"{k}1": np.where(turned, both[f"{k}0"], both[f"{k}1"])}
            yield pa.RecordBatch.from_arrays([pa.array(numbers[n]) if n in numbers else some.column(n) for n in names], names)
        quotes = int(pc.sum(run.column("_quotes")).as_py())
        for h in (0, 1):
            held[f"_depth{h}"] = int(found[h][1][-1] + found[h][2][-1] - found[h][3][-1])
        held |= {"_at": held["_at"] + run.num_rows, "_quotes": held["_quotes"] + quotes, "_bytes": held["_bytes"] + int(pc.sum(run.column("_bytes")).as_py())}
    if held:
        yield row(held)


def _opening(member: str) -> str:
    return rf'(?s)^.*?(?<!\\)"{member}"\s*:\s*\[\s*'


def _ranges(split: DataFrame, member: str) -> DataFrame:
    """One row a byte range: the state in which it starts (``_q``, ``_d``), the place of a piece that no brace closes (``_open_at``), and of its
    file the places where the member's array starts and where the next array at that level ends (``_from``, ``_to``)."""
    holds = lambda *marks: reduce(and_, [F.col("value").contains(m) for m in marks])
    marked = split.withColumns({f"_starts{h}": holds(f'"{member}"', "[") & _outside(h == 1).rlike(_opening(member)) for h in (0, 1)}
                               | {f"_ends{h}": holds("]") & F.regexp_replace(_outside(h == 1), r"(?s)\{.*$", "").contains("]") for h in (0, 1)})
    stored = materialise(marked.drop("value").mapInArrow(_summed, _SUMMED), "ranges")
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("_file")
    sums = stored.where("_starts0 IS NULL").withColumn("_q", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2)
    net = F.when(F.col("_q") == 1, F.col("_depth1")).otherwise(F.col("_depth0"))
    # a file that doesn't end with a brace has a last piece that none closes
    bare = (F.sum("_bytes").over(whole) > F.max("_size").over(whole)) & (F.col("_block") == F.max("_block").over(whole))
    known = sums.select(*PLACE, "_q", F.coalesce(F.sum(net).over(before), F.lit(0)).alias("_d"), F.when(bare, F.col("_at") - 1).otherwise(-1).alias("_open_at"))
    turned = lambda k: F.when(F.col("_q") == 1, F.col(f"{k}1")).otherwise(F.col(f"{k}0"))
    marks = stored.where("_starts0 IS NOT NULL").join(known, PLACE).select(
        "_file", F.struct("_block", "_at").alias("_place"), (turned("_depth") + F.col("_d")).alias("_depth"), turned("_starts").alias("_starts"), turned("_ends").alias("_ends"))
    starts = marks.where("_starts AND _depth <= 1").groupBy("_file").agg(F.min("_place").alias("_from"))
    ends = marks.where("_ends AND _depth = 1").join(starts, "_file").where("_place > _from").groupBy("_file").agg(F.min("_place").alias("_to"))
    return materialise(known.join(starts, "_file", "left").join(ends, "_file", "left"), "known")


def pieces(split: DataFrame, ranges: DataFrame) -> DataFrame:
    """The pieces with their place, whether they start inside a string, the depth of braces at which they start, how many they open and whether
    their own brace closes one; and what ``ranges`` says of their file."""
    changed = F.raise_error(F.lit("the files were cut into other byte ranges than in the first reading (changed settings, cores or files): read them again"))
    with_state = split.drop("_bytes", "_size").join(F.broadcast(ranges), PLACE, "left").withColumn("_q", F.when(F.col("_q").isNull(), changed.cast("bigint")).otherwise(F.col("_q")))
    names = with_state.columns
    added = {"_at": pa.int64(), "_inside": pa.bool_(), "_depth": pa.int64(), "_opens": pa.int64(), "_closes": pa.int64(), "_closed": pa.bool_()}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = quotes = depth = 0
        for run, fresh in _runs(batches):
            if fresh:
                at, quotes, depth = 0, run.column("_q")[0].as_py(), run.column("_d")[0].as_py()
            inside, own, opens, closes = _states(run, quotes, depth)
            places = at + np.arange(run.num_rows)
            closed = places != run.column("_open_at")[0].as_py()
            columns = [places, inside, own, opens, closes * closed, closed]
            yield pa.RecordBatch.from_arrays([*run.columns, *[pa.array(x, k) for x, k in zip(columns, added.values())]], [*names, *added])
            at, quotes, depth = at + run.num_rows, quotes + int(pc.sum(run.column("_quotes")).as_py()), int(own[-1] + opens[-1] - closes[-1])

    kinds = {pa.int64(): "bigint", pa.bool_(): "boolean"}
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in with_state.schema.fields], *[f"{n} {kinds[k]}" for n, k in added.items()]])
    return with_state.mapInArrow(placed, schema).drop("_quotes", "_open0", "_open1", "_q", "_d", "_open_at")


def records(spark: SparkSession, path: str, member: str = "claims") -> DataFrame:
    """(file, record): the text of every record of the documents under ``path``: elements of a top-level array, of the array that a top-level
    object holds as ``member``, or else that object itself. A record that its file doesn't end is left out. The files are read three times:
    when called for the ranges' sums and the records cut by braces of their own, and with the result."""
    place = F.struct("_block", "_at")
    split = _split(spark, path)
    held = pieces(split, _ranges(split, member)).withColumn("_outer", F.col("_from").isNotNull().cast("int"))
    rest = F.when(F.col("_inside"), _outside(True)).otherwise(F.col("value"))
    first = (F.col("_outer") == 1) & (place == F.col("_from"))
    wanted = (F.col("_outer") == 0) | ((place >= F.col("_from")) & (F.col("_to").isNull() | (place < F.col("_to"))))
    text = F.when(first, F.regexp_replace(rest, _opening(member), "")).otherwise(F.regexp_replace("value", r"^[\s,\[\x{feff}]*", ""))
    begins = (~F.col("_inside") | first) & (F.col("_depth") <= F.col("_outer")) & (F.col("_depth") + F.col("_opens") > F.col("_outer")) & text.startswith("{")
    level = F.col("_depth") + F.col("_opens") - F.col("_closes")
    known = held.where(wanted).withColumns({"_begins": begins, "_ends": (F.col("_closes") == 1) & (level == F.col("_outer"))})
    body = F.concat(F.when(F.col("_begins"), text).otherwise(F.col("value")), F.when(F.col("_closed"), "}").otherwise(""))
    known = known.withColumn("_text", body)
    whole = known.where("_begins AND _ends").select(F.col("_file").alias("file"), F.col("_text").alias("record"))
    cut = known.where("NOT (_begins AND _ends) AND (_begins OR _depth > _outer)").select("_file", "_block", "_at", "_begins", "_ends", "_text")
    numbered = _with_sum_before(materialise(cut, "cut"), F.col("_begins").cast("int"), "_n").withColumn("_n", F.col("_n") + F.col("_begins").cast("int")).where("_n > 0")
    joined = (numbered.groupBy("_file", "_n").agg(F.sort_array(F.collect_list(F.struct("_block", "_at", "_text"))).alias("_all"), F.bool_or("_ends").alias("_done"))
              .where("_done").select(F.col("_file").alias("file"), F.array_join(F.transform("_all", lambda x: x["_text"]), "").alias("record")))
    return whole.unionByName(joined)
