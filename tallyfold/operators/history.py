"""Appending a run to the history, ordering and sampling it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.operators.ranking import total_rank


def union_fill(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack by name; a column only one side has is null on the other."""
    return first.unionByName(second, allowMissingColumns=True)


def append_idempotent(history: DataFrame, run: DataFrame, period: str = "week_num", periods: Column | None = None) -> DataFrame:
    """History without the periods of the run, plus the run; loading a run again changes nothing.

    The periods are an array from a scalar subquery, so the history is filtered where it is read and not
    shuffled. ``periods`` gives the array where it is known more cheaply than from the run. A table
    partitioned by the period gets the same result from ``sinks.overwrite_periods``, which reads no history.
    """
    if periods is None:
        periods = run.select(F.collect_set(period)).scalar()
    kept = ~F.coalesce(F.array_contains(periods, F.col(period)), F.lit(False))
    return history.where(kept).unionByName(run)


def week_rank(week_num: str | Column = "week_num") -> Column:
    """Number of a week label that has known dates, else null."""
    week = F.col(week_num) if isinstance(week_num, str) else week_num
    known = [w for w, _ in cb.WEEK_DATES]
    return F.when(week.isin(*known), F.substring(week, 3, 9).try_cast("int"))


def publication_keys() -> list[Column]:
    """Metric, group, geography and week number; unknown weeks come last."""
    return [*[F.asc_nulls_last(c) for c in ("metric", "race_var", "geography")], week_rank().asc_nulls_last()]


def in_publication_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*publication_keys())


def publication_rank(df: DataFrame, name: str = "row_rank") -> DataFrame:
    """Adds each row's number in the published order, so that the order is kept by tables that have none of their own."""
    return total_rank(df, publication_keys(), name)


def seeded_key(seed: str, *keys: str) -> Column:
    """Reproducible pseudo-random order of keys."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))


def sample_without_replacement(df: DataFrame, n: int, seed: str, keys: Sequence[str]) -> DataFrame:
    """``n`` distinct rows in a reproducible random order; a top-n, so no full sort."""
    return df.orderBy(seeded_key(seed, *keys), *keys).limit(n)


def sample_with_replacement(slots: DataFrame, slot: str, values: Sequence[str], seed: str, name: str) -> DataFrame:
    """A reproducible draw from a fixed list for each row of ``slots``."""
    draw = F.conv(F.substring(seeded_key(seed, slot), 1, 8), 16, 10).cast("bigint") % len(values)
    return slots.withColumn(name, F.element_at(F.array(*[F.lit(v) for v in values]), (draw + 1).cast("int")))
