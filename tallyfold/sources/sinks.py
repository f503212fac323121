"""Writers. Every path may be a URI of any file system Spark knows."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.replicates import SurveyDesign


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header="true", nullValue="NA").csv(path)


def by_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of a period together, so that tasks don't each write a file for every period. AQE splits a large
    period and joins small ones."""
    return df.hint("rebalance", period)


def write_table(df: DataFrame, path: str, period: str = "week_num", mode: str = "overwrite") -> None:
    """Parquet by period, so that a run reads the weeks it needs."""
    by_period(df, period).write.mode(mode).partitionBy(period).parquet(path)


def overwrite_periods(df: DataFrame, path: str, period: str = "week_num") -> None:
    """Replace only the periods the run holds; a rerun leaves the same table."""
    (
        by_period(df, period).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )


def bucket_by_respondent(df: DataFrame, table: str, buckets: int) -> None:
    """Microdata or weights as a table bucketed on the join keys, so joining them needs no shuffle."""
    keys = ("week", "scram")
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings for the jobs run inside; keys use ``__`` for dots."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def respondent_table(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> str:
    """Name of the table below ``path`` that is partitioned by week and bucketed by respondent.

    The name is made known to this session, as the layout is no part of the files.
    """
    name = f"respondents_{hashlib.md5(path.encode()).hexdigest()[:16]}_{buckets}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"create table {name} ({columns}) using parquet partitioned by (week) clustered by (scram) sorted by (scram)"
                  f" into {buckets} buckets location '{path}'")
        if exists(spark, path):
            spark.sql(f"alter table {name} recover partitions")
    return name


def keep_by_respondent(df: DataFrame, path: str, buckets: int) -> None:
    """Replace the weeks that ``df`` holds in the table below ``path``. A task writes one bucket of each week."""
    spark = df.sparkSession
    name = respondent_table(spark, path, df.schema, buckets)
    rows = df.select(*spark.table(name).columns).repartition(buckets, "scram")
    with settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        rows.write.mode("overwrite").insertInto(name)


def by_respondent(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    return spark.table(respondent_table(spark, path, schema, buckets))


def with_notes(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns with the notes that the schema has for them; Parquet keeps them."""
    notes = {f.name: f.metadata for f in schema}
    return df.select(*[F.col(c).alias(c, metadata=notes[c]) if notes.get(c) else F.col(c) for c in df.columns])


def append_missing(df: DataFrame, path: str, keys: Sequence[str], period: str = "week_num") -> None:
    """Add the rows whose keys the table does not have yet, by period; adding the same rows again changes nothing."""
    spark = df.sparkSession
    if exists(spark, path):
        stored = spark.read.parquet(path).select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        df = df.join(stored, same, "left_anti")
    write_table(df, path, period, mode="append")


MANIFEST = "manifest"


def publish(outputs: Mapping[str, DataFrame], base: str) -> list[str]:
    """Write each named output as CSV into a folder of this run below a base URI; gives the paths.

    The last thing written is the run's entry in the manifest, which readers follow: a run that fails before leaves
    what they see as it was.
    """
    base, paths, spark = base.rstrip("/"), [], None
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    for name, df in outputs.items():
        spark = df.sparkSession
        paths.append(f"{base}/runs/{run}/{name}")
        write_csv(df, paths[-1], mode="error")
    if spark is not None:
        entries = [(run, name) for name in outputs]
        spark.createDataFrame(entries, "run string, name string").coalesce(1).write.mode("append").json(f"{base}/{MANIFEST}")
    return paths


def published_path(spark: SparkSession, base: str, name: str) -> str:
    """Where an output of the last whole run is."""
    base = base.rstrip("/")
    runs = spark.read.schema("run string, name string").json(f"{base}/{MANIFEST}")
    last = runs.where(F.col("run") == runs.select(F.max("run")).scalar())
    found = last.where(F.col("name") == name).first()
    if found is None:
        raise ValueError(f"{name} was not published in the last run")
    return f"{base}/runs/{found['run']}/{name}"


def save_design(df: DataFrame, design: SurveyDesign, path: str) -> None:
    """Keep microdata with its design for later checks."""
    df.write.mode("overwrite").parquet(f"{path}/data")
    df.sparkSession.createDataFrame(
        [(design.weight, list(design.replicates), design.se_factor)],
        "weight string, replicates array<string>, se_factor double",
    ).write.mode("overwrite").parquet(f"{path}/design")
