"""A training corpus from raw documents: quality rules, near duplicates, benchmark leaks, source mix, shards.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame. ``run``
hands over by tables in the shared folder, so a lost executor costs its stage's tasks and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm.decontaminate import decontaminate
from tallyfold.llm.mixing import mix_sources, tempered_rates
from tallyfold.llm.neardup import drop_near_duplicates
from tallyfold.llm.quality import good_documents
from tallyfold.llm.sharding import shard_documents
from tallyfold.llm.store import settle

MIX_POWER, SEED, N_SHARDS = 0.5, 7, 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their sources' rates, in a shuffled order."""
    return mix_sources(docs, tempered_rates(docs, MIX_POWER), SEED).drop("copy", "shuffle_key")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot there."""
    return shard_documents(docs, n_shards=N_SHARDS).shards


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", benchmark_decontamination),
          ("source_mix", source_mix), ("sharding", sharding)]

#: Near duplicates need components of a graph, which the SQL at hand does not express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
