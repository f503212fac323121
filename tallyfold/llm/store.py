"""Tables that cut lineage, kept in the folder that all executors share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.sources.scratch import shared_folder

#: Most rows of narrow keys (a few longs) that are broadcast; beyond it the join is a shuffle.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only where none is set and the session is local, as in tests."""
    return shared_folder(spark)


@contextmanager
def arrow_rows(spark: SparkSession, n: int, n_bytes: int | None = None):
    """Jobs run inside hand ``n`` rows, and ``n_bytes`` at most, at once to Python, where rows are long."""
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": n, "spark.sql.execution.arrow.maxBytesPerBatch": n_bytes}
    before = {key: spark.conf.get(key, None) for key, value in keys.items() if value}
    for key in before:
        spark.conf.set(key, str(keys[key]))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """The shuffle files of queries that are written inside go when the query ends, and not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def settle(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor costs no recomputation before it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallyfold-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.settled_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a settled table of narrow rows, with a broadcast hint if it has ``most`` rows or fewer."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
