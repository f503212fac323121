"""Bring the questionnaire layouts of different weeks to one set of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.operators.columns import snake_case


def phase_of(week: int) -> Mapping:
    for phase in cb.PHASES:
        first, last = phase["weeks"]
        if first <= week <= last:
            return phase
    raise ValueError(f"no questionnaire layout is known for week {week}")


def phases_of(weeks: Iterable[int]) -> list[tuple[Mapping, list[int]]]:
    """Weeks grouped by layout, in layout order."""
    weeks = sorted(set(weeks))
    for week in weeks:
        phase_of(week)
    grouped = [(p, [w for w in weeks if p["weeks"][0] <= w <= p["weeks"][1]]) for p in cb.PHASES]
    return [(p, ws) for p, ws in grouped if ws]


def harmonise(df: DataFrame, phase: Mapping) -> DataFrame:
    """One select: rename what the layout calls differently, add what it lacks as nulls."""
    df = snake_case(df)
    missing = [c for c in phase["renames"] if c not in df.columns]
    if missing:
        raise ValueError(f"the layout of weeks {phase['weeks']} lacks {missing}")
    absent = set(phase["absent"])
    kept = [
        F.col(c).alias(phase["renames"].get(c, c))
        for c in df.columns
        if phase["renames"].get(c, c) not in absent
    ]
    return df.select(*kept, *[F.lit(None).cast("double").alias(c) for c in phase["absent"]])


def stack_periods(weeks: Iterable[int], read: Callable[[list[int]], DataFrame]) -> DataFrame:
    """Scan many weeks with one read per layout, harmonise each and stack them.

    ``read`` gets the weeks that share a layout. Reads grow with the number of
    layouts, not with the number of weeks.
    """
    parts = [harmonise(read(ws), phase) for phase, ws in phases_of(weeks)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
