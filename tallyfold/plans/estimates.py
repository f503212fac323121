"""Estimate families and their assembly.

One linear plan: microdata -> domains -> rest -> contrasts -> dense grid. Only
the first step grows with the number of respondents.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions.recode import age_cut, group_name
from tallyfold.functions.replicates import SurveyDesign, confidence, significance
from tallyfold.operators.contrast import STATS, contrast
from tallyfold.operators.cube import flat_names, grouped_sums, roll_up, with_rest
from tallyfold.operators.reshape import literal_array

CELL_KEYS = ("week_num", "state", "cbsa_title", "race")
GEO_GROUP, GEO_TOTAL = "geo_by_group", "geo_total"
US_GROUP, US_TOTAL = "national_by_group", "national_total"
FAMILIES = (GEO_GROUP, GEO_TOTAL, US_GROUP, US_TOTAL)
NATIONAL, NATION = "national", "US"


@dataclass(frozen=True)
class EstimateOptions:
    """What to estimate.

    ``null_geo_in_rest``: whether people outside any metro area belong to the
    rest a metro total is compared with. Off by default: the comparison is then
    with the other metro areas.
    """

    metrics: Sequence[str] = cb.METRICS
    groups: Sequence[str] = cb.GROUPS
    removed: Sequence[str] = cb.REMOVED_TOTAL_METRICS
    families: Sequence[str] = FAMILIES
    null_geo_in_rest: bool = False
    #: Week labels that every area has rows for; by default those of which the area has respondents.
    weeks: Sequence[str] | None = None


def latest_weeks(df: DataFrame, count: int = 2, week: str = "week") -> DataFrame:
    """Rows of the latest ``count`` weeks up to the largest; a scalar subquery, no trip to the driver."""
    latest = df.select(F.max(week)).scalar()
    return df.where(F.col(week) > latest - count)


def estimation_input(df: DataFrame) -> DataFrame:
    """Microdata as it is estimated: both income questions as one, the age cut, the short group name."""
    income = (
        F.when(F.col("week") >= cb.INCOME_SPLIT_WEEK, F.col("inc_loss_rv")).otherwise(F.col("inc_loss"))
        if "inc_loss_rv" in df.columns
        else F.col("inc_loss")
    )
    return df.withColumns(
        {
            "inc_loss": income,
            "insured_public": age_cut("insured_public"),
            "uninsured": age_cut("uninsured"),
            "race": group_name(),
        }
    )


def _sets(options: EstimateOptions) -> list[tuple[str, str, list[str]]]:
    """Geography type, kind and keys of each domain set of the wanted families."""
    sets = {
        GEO_GROUP: [("state", "group", ["state", "race"]), ("msa", "group", ["cbsa_title", "race"])],
        GEO_TOTAL: [("state", "total", ["state"]), ("msa", "total", ["cbsa_title"])],
        US_GROUP: [(NATIONAL, "group", ["race"])],
        US_TOTAL: [(NATIONAL, "total", [])],
    }
    return [s for family in FAMILIES if family in set(options.families) for s in sets[family]]


def _named_domains(sums: DataFrame, design: SurveyDesign, options: EstimateOptions) -> DataFrame:
    """Geography, kind and group of each domain in place of the set number."""
    sets = _sets(options)

    def by_set(values: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("set_id"))

    geo_type, kind = by_set([s[0] for s in sets]), by_set([s[1] for s in sets])
    place = F.when(geo_type == NATIONAL, NATION).when(geo_type == "state", F.col("state")).otherwise(F.col("cbsa_title"))
    group = F.when(kind == "total", cb.TOTAL).otherwise(F.col("race"))
    named = sums.withColumns({"geo_type": geo_type, "geography": place, "kind": kind, "race_var": group}).selectExpr(
        "week_num", "metric", "geo_type", "geography", "kind", "race_var", "n", "lo", "hi", *flat_names(len(design.columns)))
    keep_unknown = F.lit(options.null_geo_in_rest)
    return named.where(F.col("geography").isNotNull() | ((F.col("kind") == "total") & keep_unknown))


def domains(df: DataFrame, design: SurveyDesign, options: EstimateOptions = EstimateOptions()) -> DataFrame:
    """Sums of every domain of the wanted families, from one pass over the microdata."""
    sets = [["week_num", *keys] for _, _, keys in _sets(options)]
    return _named_domains(grouped_sums(df, design, options.metrics, CELL_KEYS, sets), design, options)


def domains_of_cube(cube: DataFrame, design: SurveyDesign, options: EstimateOptions = EstimateOptions()) -> DataFrame:
    """The same from a cube kept as a table, as when old weeks are published again."""
    sets = [["week_num", *keys] for _, _, keys in _sets(options)]
    return _named_domains(roll_up(cube, design, CELL_KEYS, sets), design, options)


def contrasts(domain: DataFrame, design: SurveyDesign) -> DataFrame:
    """Groups against the other groups of their area, area totals against the other areas of their type.

    People of unknown group count in the rest of every group. Their own row stays
    too: it shows that the area had respondents.
    """
    grouped = F.col("kind") == "group"
    scoped = domain.withColumns(
        {
            "scope": F.when(grouped, F.col("geography")),
            "item": F.when(grouped, F.col("race_var")).otherwise(F.col("geography")),
        }
    )
    compared = with_rest(scoped, design, ["week_num", "geo_type", "kind", "scope"], "item")
    places = compared.where(F.col("geography").isNotNull()).drop("scope", "item")
    return contrast(places, design, solo=(F.col("geo_type") == NATIONAL) & (F.col("kind") == "total"))


def _cell_key(metric: Column, race: Column) -> Column:
    return F.concat_ws("|", metric, race)


def dense(stats: DataFrame, options: EstimateOptions, places: DataFrame | None = None) -> DataFrame:
    """A row for every metric and group of each area and week.

    With ``options.weeks`` an area has rows for all these weeks, and ``places`` (geo_type, geography) adds areas of a
    dimension that may have no respondents at all. Cells nobody is in get the constants of an empty
    contrast. The lists are literals, looked up in a map of at most metrics x (groups + total) entries
    per area and week, so no grid is joined. National totals are the exception: a metric without answers has no row, a
    removed one a constant row.
    """
    wanted = set(options.families)
    is_us = F.col("geo_type") == NATIONAL
    with_groups = F.when(is_us, F.lit(US_GROUP in wanted)).otherwise(F.lit(GEO_GROUP in wanted))
    with_total = F.when(is_us, F.lit(US_TOTAL in wanted)).otherwise(F.lit(GEO_TOTAL in wanted))
    races = F.concat(
        F.when(with_groups, literal_array(options.groups)).otherwise(F.array().cast("array<string>")),
        F.when(with_total, literal_array([cb.TOTAL])).otherwise(F.array().cast("array<string>")),
    )
    key = _cell_key(F.col("metric"), F.col("race_var"))
    entry = F.when(F.col("race_var").isNotNull(), F.struct(key.alias("key"), F.struct(*STATS).alias("value")))
    area = ("geo_type", "geography")
    weekly = stats.groupBy(*area, "week_num").agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))
    if options.weeks is not None:
        # an area that misses a week, or that only the dimension has, gets empty maps
        found = weekly.select(*area, F.struct("week_num", "cells").alias("week"))
        if places is not None:
            found = found.unionByName(places.select(*area).distinct(), allowMissingColumns=True)
        of_area = found.groupBy(*area).agg(F.map_from_entries(F.collect_list("week")).alias("weeks"))
        none = F.create_map().cast(weekly.schema["cells"].dataType)
        weekly = of_area.select(*area, "weeks", F.explode(literal_array(list(options.weeks))).alias("week_num")).select(
            *area, "week_num", F.coalesce(F.try_element_at("weeks", "week_num"), none).alias("cells"))
    grid = weekly.select("*", F.explode(literal_array(options.metrics)).alias("metric")).select("*", F.explode(races).alias("race_var"))
    us_total = is_us & (F.col("race_var") == cb.TOTAL)
    removed = us_total & F.col("metric").isin(*options.removed)
    found = F.when(~removed, F.try_element_at("cells", key))
    none, zero = F.lit(None).cast("double"), F.lit(0.0)
    constants = {"mean": none, "se": zero, "other_mean": none, "other_se": zero, "diff_mean": zero, "diff_se": zero}
    return (
        grid.withColumn("found", found)
        .where(F.col("found").isNotNull() | removed | ~us_total)
        .select(
            "metric",
            "race_var",
            *[F.when(F.col("found").isNull(), constants[s]).otherwise(F.col(f"found.{s}")).alias(s) for s in STATS],
            "geo_type",
            "geography",
            "week_num",
        )
    )


def areas(df: DataFrame) -> DataFrame:
    """geo_type, geography of all areas that respondents name, in whichever week."""
    kinds = F.array(*[F.struct(F.lit(kind).alias("geo_type"), F.col(c).alias("geography"))
                      for kind, c in (("state", "state"), ("msa", "cbsa_title"))])
    return df.select(F.inline(kinds)).where("geography is not null").distinct()


def estimate(df: DataFrame, design: SurveyDesign, options: EstimateOptions = EstimateOptions(),
             places: DataFrame | None = None) -> DataFrame:
    """Contrast rows of the wanted families from prepared microdata."""
    return dense(contrasts(domains(df, design, options), design), options, places)


def estimate_from_cube(cube: DataFrame, design: SurveyDesign, options: EstimateOptions = EstimateOptions(),
                       places: DataFrame | None = None) -> DataFrame:
    """The same from a cube kept as a table."""
    return dense(contrasts(domains_of_cube(cube, design, options), design), options, places)


def publish_columns(estimates: DataFrame) -> DataFrame:
    """Margins of error, bounds and the significance flag in place of the contrast columns."""
    us_total = (F.col("geo_type") == NATIONAL) & (F.col("race_var") == cb.TOTAL)
    bounds = confidence(F.col("mean"), F.col("se"))
    return estimates.select(
        "geography", "metric", "week_num", "race_var", "mean", "se",
        *[c.alias(k) for k, c in bounds.items()],
        "geo_type",
        F.when(~us_total, significance(F.col("diff_mean"), F.col("diff_se"))).alias("sigdiff"),
    )


def join_week_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Add the displayed dates of each week. The table has one row per known week."""
    return df.join(F.broadcast(dates), "week_num", "left")


def removed_metric_rows(weeks: DataFrame, removed: Iterable[str] = cb.REMOVED_TOTAL_METRICS) -> DataFrame:
    """Constant national total rows of metrics no longer asked, for each row of ``weeks``."""
    none, zero = F.lit(None).cast("double"), F.lit(0.0)
    return weeks.select("week_num", F.explode(literal_array(list(removed))).alias("metric")).select(
        F.lit(NATION).alias("geography"), "metric", "week_num", F.lit(cb.TOTAL).alias("race_var"),
        none.alias("mean"), zero.alias("se"), zero.alias("moe_95"),
        none.alias("moe_95_lb"), none.alias("moe_95_ub"),
        F.lit(NATIONAL).alias("geo_type"), none.alias("sigdiff"),
    )


def feature_output(df: DataFrame, design: SurveyDesign, dates: DataFrame,
                   options: EstimateOptions = EstimateOptions(), places: DataFrame | None = None) -> DataFrame:
    """Published estimates with both income questions under one metric."""
    return join_week_dates(publish_columns(estimate(df, design, options, places)), dates)


def relabel_split_metric(feature: DataFrame, metric: str = "inc_loss", renamed: str = "inc_loss_rv",
                         flagged: Sequence[str] = cb.FLAGGED_REMOVED_METRICS) -> DataFrame:
    """Full output: the metric's rows move to ``renamed``, its own stay as constants; removed ones are flagged."""
    labels = F.when(F.col("metric") == metric, literal_array([metric, renamed])).otherwise(F.array("metric"))
    copies = feature.withColumn("metric", F.explode(labels))
    old = F.col("metric") == metric
    none, zero = F.lit(None).cast("double"), F.lit(0.0)
    emptied = {
        **{c: F.when(old, none).otherwise(F.col(c)) for c in ("mean", "moe_95_lb", "moe_95_ub", "sigdiff")},
        **{c: F.when(old, zero).otherwise(F.col(c)) for c in ("se", "moe_95")},
    }
    return copies.withColumns(emptied).withColumn(
        "var_removed", F.when(F.col("metric").isin(*flagged), 1.0).otherwise(0.0)
    )


def expected_grid_count(estimates: DataFrame, places: DataFrame, weeks: Sequence[str], metrics: Sequence[str] = cb.METRICS,
                        groups: Sequence[str] = cb.GROUPS) -> DataFrame:
    """One row: rows found, rows a complete grid has, and whether they agree.

    Complete means every metric, every group and the total for each area of ``places`` (geo_type, geography) and
    each of the weeks, whoever answered; rows of other areas and weeks are not counted.
    """
    per_place = len(metrics) * (len(groups) + 1) * len(weeks)
    wanted = places.select("geo_type", "geography").distinct()
    found = estimates.where(F.col("week_num").isin(*weeks)).join(wanted, ["geo_type", "geography"], "left_semi")
    expected = wanted.select(F.count(F.lit(1)) * per_place).scalar()
    counts = found.agg(F.count(F.lit(1)).alias("n_found")).withColumn("n_expected", expected)
    return counts.withColumn("complete", F.col("n_found") == F.col("n_expected"))


def assert_complete(estimates: DataFrame, places: DataFrame, weeks: Sequence[str], metrics: Sequence[str] = cb.METRICS) -> None:
    row = expected_grid_count(estimates, places, weeks, metrics).first()
    if not row["complete"]:
        raise ValueError(f"{row['n_found']} estimate rows where {row['n_expected']} are expected")
