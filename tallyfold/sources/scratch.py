"""Tables between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where none is set a local session gets one of its own; on a
    cluster that is an error, as no folder of the driver's machine is seen by the executors."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tallyfold-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallyfold-{uuid.uuid4().hex}"


def handed_over(df: DataFrame) -> DataFrame:
    """``df`` written once and read back: what follows sees the same rows in every pass, and a lost executor costs no
    recomputation before it."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
