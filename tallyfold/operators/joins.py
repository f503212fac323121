"""Joins of respondents with dimensions and weights, and their safeguards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the declared order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select("*", rank.alias("_rank")).where("_rank = 1").drop("_rank")


def usable_keys(dim: DataFrame, key: str) -> DataFrame:
    """Rows of a dimension with a key; a null key never matches."""
    return dim.where(F.col(key).isNotNull())


def join_dimension(df: DataFrame, dim: DataFrame, left: str, right: str, order: Sequence[str | Column]) -> DataFrame:
    """Left join with a dimension made unique by key, so that no respondent is multiplied.

    Whether the dimension is broadcast is left to Spark, which knows its size.
    """
    unique = keep_first(usable_keys(dim, right), [right], order).withColumnRenamed(right, "_key")
    return df.join(unique, F.col(left) == F.col("_key"), "left").drop("_key")


def join_weights(df: DataFrame, weights: DataFrame, keys: Sequence[str] = ("week", "scram")) -> DataFrame:
    """Left join with the replicate weights on week and respondent.

    Both sides are large. Tables bucketed on the keys join without a shuffle;
    the keys are unique on either side, so they spread evenly.
    """
    clash = [c for c in weights.columns if c in df.columns and c not in keys]
    return df.join(weights.drop(*clash), list(keys), "left")


def fan_out(dim: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row; a join on them would multiply rows."""
    return usable_keys(dim, key).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def row_balance(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with both counts and whether they agree; raise on it where that is wanted."""
    counts = (
        before.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
        .unionByName(after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
        .agg(F.sum("b").alias("n_before"), F.sum("a").alias("n_after"))
    )
    return counts.withColumn("balanced", F.col("n_before") == F.col("n_after"))


def assert_rows_kept(before: DataFrame, after: DataFrame) -> None:
    row = row_balance(before, after).first()
    if not row["balanced"]:
        raise ValueError(f"a join changed the row count from {row['n_before']} to {row['n_after']}")
