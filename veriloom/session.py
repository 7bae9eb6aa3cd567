"""Session defaults for local runs, and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "veriloom") -> SparkSession:
    """A session for tests and the benchmark. On a cluster, submit with the cluster's own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_written: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, inside the shared folder named by ``spark.checkpoint.dir``.

    Only in a local session without the setting, as in tests, a temporary folder is chosen; on a cluster its executors
    would each write to a disk of their own, so there a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _written.append(path)
    return path


@contextmanager
def work(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written by what runs inside, once its results have been written elsewhere:
    ``with work(spark): plan(...).write.parquet(out)``."""
    before = len(_written)
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _written[before:]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        del _written[before:]


def materialise(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where one frame feeds several branches: the stored table cuts the lineage and, unlike an
    executor cache, survives the loss of executors.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
