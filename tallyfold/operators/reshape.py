"""Wide to long, long to wide, geography tags and the grid of expected cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import codebook as cb


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str = "metric",
                    value: str = "x") -> DataFrame:
    """A row per metric; rows with a null value are kept."""
    return df.unpivot(list(ids), list(metrics), name, value)


def pivot_metrics(df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Sequence[str]) -> DataFrame:
    """A column per listed name, so that no extra pass looks for the names."""
    return df.groupBy(*keys).pivot(name, list(columns)).agg(F.first(value, ignorenulls=True))


def literal_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def stack_geographies(df: DataFrame, state: str = "state", msa: str = "cbsa_title",
                      nation: str | None = None) -> DataFrame:
    """A row per geography a respondent belongs to: the state and, where there is one, the metro area.

    ``nation`` adds the whole under that name.
    """
    def place(geo_type: str, geography: Column) -> Column:
        return F.struct(F.lit(geo_type).alias("geo_type"), geography.alias("geography"))

    places = [place("state", F.col(state)), place("msa", F.col(msa))]
    if nation is not None:
        places.append(place("national", F.lit(nation)))
    present = F.filter(F.array(*places), lambda p: p["geography"].isNotNull())
    return df.select("*", F.inline(present))


def estimate_grid(places: DataFrame, metrics: Sequence[str] = cb.METRICS,
                  groups: Sequence[str] = cb.GROUPS) -> DataFrame:
    """Every metric and group for each row of ``places``; lists are literals, so nothing is joined."""
    return places.select("*", F.explode(literal_array(metrics)).alias("metric")).select(
        "*", F.explode(literal_array(groups)).alias("race_var"))
