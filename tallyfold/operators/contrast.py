"""Means, replicate errors and group-versus-rest contrasts of packed domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.replicates import SurveyDesign, base, differences, ratios, spread_se

SUMS = ("n", "lo", "hi", "num", "den")
PACKED = (*SUMS, *[f"rest_{c}" for c in SUMS])
STATS = ("mean", "se", "other_mean", "other_se", "diff_mean", "diff_se")


def estimates_of(prefix: str = "") -> Column:
    """Estimate of each weight. Where all answers are alike it is that answer, free of rounding."""
    lo, hi, num, den = (F.col(prefix + c) for c in ("lo", "hi", "num", "den"))
    return F.when(lo == hi, F.array_repeat(lo, F.size(num))).otherwise(ratios(num, den))


def _kept(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in PACKED or c == "n"]


def contrast(packed: DataFrame, design: SurveyDesign, solo: Column | None = None) -> DataFrame:
    """Add mean, se, other_mean, other_se, diff_mean, diff_se; drops the arrays.

    diff is rest minus group, its error comes from per-replicate differences.
    ``other_se`` is left without the error factor, as the intermediate output
    has always had it; it is not published. Where the group or the rest has no
    answers the constants of an empty contrast are given. ``solo`` marks rows
    that are not contrasted at all.
    """
    solo = F.lit(False) if solo is None else solo
    theta, other, diff = F.col("_theta"), F.col("_other"), F.col("_diff")
    frame = packed.withColumns({"_theta": estimates_of(), "_other": estimates_of("rest_")})
    frame = frame.withColumn("_diff", differences(other, theta))
    empty = (F.col("n") == 0) | (~solo & (F.col("rest_n") == 0))
    zero, none = F.lit(0.0), F.lit(None).cast("double")

    def either(if_empty: Column, if_solo: Column | None, value: Column) -> Column:
        out = F.when(empty, if_empty)
        return (out if if_solo is None else out.when(solo, if_solo)).otherwise(value)

    stats = {
        "mean": either(none, None, base(theta)),
        "se": either(zero, None, spread_se(theta, design)),
        "other_mean": either(none, none, base(other)),
        "other_se": either(zero, none, spread_se(other, design, 1.0)),
        "diff_mean": either(zero, none, base(diff)),
        "diff_se": either(zero, none, spread_se(diff, design)),
    }
    return frame.select(*_kept(packed), *[c.alias(k) for k, c in stats.items()])


def weighted_means(packed: DataFrame, design: SurveyDesign) -> DataFrame:
    """Mean and reported error of each domain, without a contrast."""
    theta = F.col("_theta")
    frame = packed.withColumn("_theta", estimates_of())
    return frame.select(*_kept(packed), base(theta).alias("mean"), spread_se(theta, design).alias("se"))


def domain_means(df: DataFrame, weight: str, metrics: list[str], by: list[str]) -> DataFrame:
    """Weighted mean of each metric per domain, nulls left out; the base weight only."""
    sums = [text for m in metrics for text in (
        f"count(`{m}`) as `n_{m}`", f"sum(`{weight}` * `{m}`) as `num_{m}`", f"sum(case when `{m}` is not null then `{weight}` end) as `den_{m}`")]
    # a respondent is one row for all metrics; what is unpivoted has a row per domain
    cells = ", ".join(f"named_struct('metric', '{m}', 'n', `n_{m}`, 'mean', try_divide(`num_{m}`, `den_{m}`))" for m in metrics)
    return df.groupBy(*by).agg(*[F.expr(text) for text in sums]).selectExpr(*[f"`{k}`" for k in by], f"inline(array({cells}))").where("n > 0")
