"""Item response and missing-value reports on the cleaned microdata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.operators.columns import across, by_prefix, numeric_columns
from tallyfold.operators.reshape import pivot_metrics, unpivot_metrics

TOTAL_LABEL = "Total"


def answered_flags(df: DataFrame, metrics: Sequence[str] = cb.ANSWERED_METRICS) -> DataFrame:
    """1/0 whether each metric has an answer; for tenure a missing code stays null."""
    flags = across(metrics, lambda c: F.when(c.isNull(), 0.0).otherwise(1.0), "answered_{}")
    return df.select("*", *flags, F.when(F.col("tenure") > 0, 1.0).when(F.col("tenure") <= 0, 0.0).alias("answered_tenure"))


def response_rate_by_group(flags: DataFrame) -> DataFrame:
    """Share that answered, by week and group."""
    names = by_prefix(flags, "answered_")
    return flags.groupBy("week_num", "hisp_rrace").agg(*across(names, F.avg))


def _with_total(level: Column) -> Column:
    """Group label, or Total for the rows of the coarser grouping set; a missing group stays null."""
    return F.when(level == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("hisp_rrace"))


def response_rate_with_total(flags: DataFrame) -> DataFrame:
    """The same with a Total row per week, in one pass of grouping sets."""
    names = by_prefix(flags, "answered_")
    week, race = F.col("week_num"), F.col("hisp_rrace")
    sets = flags.groupingSets([[week, race], [week]], week, race).agg(
        F.grouping("hisp_rrace").alias("_level"), *across(names, F.avg)
    )
    return sets.select("week_num", _with_total(F.col("_level")).alias("hisp_rrace"), *names)


def race_mix_of_answerers(flags: DataFrame) -> DataFrame:
    """Which groups those who answered belong to, with the whole sample as one more column."""
    df = flags.withColumn("answered_hisp_rrace", F.when(F.col("hisp_rrace").isNull(), 0.0).otherwise(1.0))
    names = by_prefix(df, "answered_")
    sums = df.groupBy("week_num", "hisp_rrace").agg(*across(names, lambda c: F.coalesce(F.sum(c), F.lit(0.0))))
    week = Window.partitionBy("week_num")
    return sums.select(
        "week_num", "hisp_rrace", *[F.try_divide(F.col(n), F.sum(n).over(week)).alias(n) for n in names]
    )


def outcome_by_answered(flags: DataFrame, outcome: str = "inc_loss") -> DataFrame:
    """Mean outcome among those who did and did not answer each item, by group and in total.

    One row a respondent goes into the sums; the few sums are laid out by answer afterwards.
    """
    names = by_prefix(flags, "answered_")
    week, race, value = F.col("week_num"), F.col("hisp_rrace"), F.col(outcome)
    answers = {"yes": F.lit(1.0), "no": F.lit(0.0), "none": F.lit(None).cast("double")}
    sums = [F.avg(F.when(F.col(n).eqNullSafe(a), value)).alias(f"{n}_{k}") for k, a in answers.items() for n in names]
    means = flags.where(value.isNotNull()).groupingSets([[week, race], [week]], week, race).agg(
        F.grouping("hisp_rrace").alias("_level"), *sums)
    rows = F.array(*[F.struct(a.alias("answered"), *[F.col(f"{n}_{k}").alias(n) for n in names]) for k, a in answers.items()])
    return means.select("week_num", _with_total(F.col("_level")).alias("hisp_rrace"), F.inline(rows)).where(
        F.coalesce(*names).isNotNull())


def missing_share(df: DataFrame, columns: Sequence[str] | None = None, week: str = "week_num") -> DataFrame:
    """Share of nulls per numeric column and week."""
    names = list(columns) if columns is not None else numeric_columns(df, skip=[week])
    return df.groupBy(week).agg(*across(names, lambda c: F.avg(c.isNull().cast("double"))))


def all_missing_count(shares: DataFrame, week: str = "week_num") -> DataFrame:
    """How many columns are missing throughout, per week."""
    names = [c for c in shares.columns if c != week]
    rows = unpivot_metrics(shares, [week], names, "variable", "pct_missing")
    return rows.groupBy(week).agg(F.sum(F.when(F.col("pct_missing") == 1, 1).otherwise(0)).alias("n_all_missing"))


def missing_drift(shares: DataFrame, before: str, after: str, week: str = "week_num") -> DataFrame:
    """Columns missing throughout in one of two weeks but not in the other."""
    names = [c for c in shares.columns if c != week]
    rows = unpivot_metrics(shares.where(F.col(week).isin(before, after)), [week], names, "variable", "pct_missing")
    pair = pivot_metrics(rows, ["variable"], week, "pct_missing", [before, after])
    left, right = F.col(before), F.col(after)
    return pair.where(((left == 1) | (right == 1)) & (left != right))


def drift_report(shares: DataFrame, weeks: Sequence[int]) -> DataFrame:
    """``missing_drift`` of each of the weeks against the one before, in one table."""
    parts = []
    for week in weeks:
        before, after = f"wk{week - 1}", f"wk{week}"
        parts.append(missing_drift(shares, before, after).select(
            F.lit(after).alias("week_num"), F.lit(before).alias("week_before"), "variable",
            F.col(before).alias("share_before"), F.col(after).alias("share")))
    return reduce(DataFrame.union, parts)
