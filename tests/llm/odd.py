"""Rows that every operator has to take: nulls, empty and long texts, repeated rows, odd characters, and columns whose names clash."""

from pyspark.sql import functions as F

LONG = ("Lorem ipsum, dolor sit amet. " * 40 + "x" * 5000 + "\n") * 60
TEXTS = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, LONG, "a"), (5, "One two, three four five. " * 12, "b"), (5, "One two, three four five. " * 12, "b"),
         (None, "no id here at all " * 20, "b"), (None, None, None), (6, "É!\x1c   <|endoftext|>  a  b,c. 3.14,x _.y 'tis it's\r\n\x0bz ,.", "a"),
         (7, "mail a.b@c-d.org or 10.0.0.255, call +1 (555) 010-9999; 4111 1111 1111 1111 ok " * 6, "c")]


def documents(spark, rows=TEXTS):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    clash = {"lang": F.lit("en"), "n_chars": F.length("text").cast("bigint"), "size": F.lit("s"), "key": F.lit("k"), "_row": F.lit(1), "fp": F.lit(None).cast("int"),
             "_text": F.lit("t"), "n_tokens": F.lit(9), "host": F.lit("h"), "base": F.lit("b"), "_doc": F.lit("d"), "_w0": F.lit(2), "_score": F.lit("x"), "copies": F.lit("c")}
    return df.withColumns(clash)


def empty(spark):
    return documents(spark).limit(0)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
