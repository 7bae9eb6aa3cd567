from pyspark.sql import functions as F

from veriloom.catalog import streams
from veriloom.streaming import jobs


def test_a_part_is_landed_by_many_tasks_and_keeps_its_range(spark):
    seen = []

    def each(df, batch_id):
        seen.append(tuple(df.withColumn("_f", F.input_file_name()).agg(F.min("id"), F.max("id"), F.count("*"), F.countDistinct("_f")).first()))

    streams._in_parts(spark, spark.range(30_000), "id", "range", lambda s, ck: jobs.drain(s, each, ck))
    assert sum(n for _, _, n, _ in seen) == 30_000 and len(seen) == 3
    assert all(before[1] < after[0] for before, after in zip(seen, seen[1:]))
    assert all(files > 1 for *_, files in seen)
