"""Recodes of coded answers into 0/1/null indicators, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold import codebook as cb


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def recode(source: str | Column, codes: Mapping[tuple[int, ...], float], where: Column | None = None) -> Column:
    """First matching code list gives the value, anything else null.

    ``where`` restricts every branch, as for a question asked of renters only.
    """
    source = col(source)
    out = F.lit(None).cast("double")
    for values, result in reversed(list(codes.items())):
        hit = source.isin(*values)
        out = F.when(hit & where if where is not None else hit, F.lit(float(result))).otherwise(out)
    return out


def recode_at_least(source: str, threshold: int, below: Iterable[int], at_least: float, under: float) -> Column:
    """``at_least`` from ``threshold`` up, ``under`` for the listed codes, else null."""
    source = col(source)
    return F.when(source >= threshold, float(at_least)).when(source.isin(*below), float(under))


def multi_response(chosen: str, options: Iterable[str]) -> Column:
    """1 if the option was ticked, 0 if any option of the question was answered, else null."""
    return F.when(col(chosen) == 1, 1.0).when(any_of(col(o) >= 0 for o in options), 0.0)


def derive_group(race: str = "rrace", hispanic: str = "rhispanic") -> Column:
    """Race label, overridden by Hispanic origin; an unknown origin keeps the race."""
    label = F.lit(None).cast("string")
    for code, text in cb.RACE_LABELS.items():
        label = F.when(col(race) == code, text).otherwise(label)
    return F.when(col(hispanic) == 2, cb.HISPANIC_LABEL).otherwise(label)


def uninsured() -> Column:
    kinds = [col(f"hlthins{n}") for n in range(1, 7)]
    return (
        F.when(any_of(k == 1 for k in kinds), 0.0)
        .when(all_of(k == 2 for k in kinds), 1.0)
        .when(col("hlthins7") == 1, 1.0)
    )


def insured_public() -> Column:
    items = [col(f"hlthins{n}") for n in range(1, 9)]
    return (
        F.when(any_of(col(f"hlthins{n}") == 1 for n in (3, 4, 6)), 1.0)
        .when(all_of(i == -99 for i in items), F.lit(None).cast("double"))
        .when(all_of(i == -88 for i in items), F.lit(None).cast("double"))
        .otherwise(0.0)
    )


def null_skipping_sum(*columns: str | Column) -> Column:
    """Row-wise sum that counts a null as 0."""
    return reduce(lambda a, b: a + b, (F.coalesce(col(c), F.lit(0.0)) for c in columns))


def score_threshold(first: Column, second: Column, threshold: int = 3) -> Column:
    """1 if two scores add up to the threshold; null only if both are missing."""
    return (
        F.when(null_skipping_sum(first, second) >= threshold, 1.0)
        .when(first.isNull() & second.isNull(), F.lit(None).cast("double"))
        .otherwise(0.0)
    )


def either_sign(first: Column, second: Column) -> Column:
    """1 if either flag is 1; null only if both are missing."""
    return (
        F.when((first == 1) | (second == 1), 1.0)
        .when(first.isNull() & second.isNull(), F.lit(None).cast("double"))
        .otherwise(0.0)
    )


def simple_indicators() -> dict[str, Column]:
    """Indicators that read the coded answers directly."""
    not_conf = {(1, 2, 5): 1, (3, 4): 0}
    renter = col("tenure") == 3
    mortgaged = col("tenure") == 2
    options = [f"spndsrc{n}" for n in range(1, 13)]
    frequency = {(1,): 0, (2,): 1, (3,): 2, (4,): 3}
    return {
        "hisp_rrace": derive_group(),
        "uninsured": uninsured(),
        "insured_public": insured_public(),
        "inc_loss": recode("wrkloss", {(1,): 1, (2,): 0}),
        "expect_inc_loss": recode("expctloss", {(1,): 1, (2,): 0}),
        "payment_not_conf": recode("mortconf", not_conf),
        "rent_not_conf": recode("mortconf", not_conf, renter),
        "mortgage_not_conf": recode("mortconf", not_conf, mortgaged),
        "rent_caughtup": recode("rentcur", {(1,): 1, (2,): 0}, renter),
        "mortgage_caughtup": recode("mortcur", {(1,): 1, (2,): 0}, mortgaged),
        "food_insufficient": recode("curfoodsuf", {(3, 4): 1, (1, 2): 0}),
        "spend_credit": multi_response("spndsrc2", options),
        "spend_savings": multi_response("spndsrc3", options),
        "spend_ui": multi_response("spndsrc5", options),
        "spend_stimulus": multi_response("spndsrc6", options),
        "spend_snap": multi_response("spndsrc8", options),
        "anxious_score": recode("anxious", frequency),
        "worry_score": recode("worry", frequency),
        "interest_score": recode("interest", frequency),
        "down_score": recode("down", frequency),
        "expense_dif": recode_at_least("expns_dif", 3, (1, 2), at_least=1, under=0),
        "telework": recode("tw_start", {(1,): 1, (2, 3): 0}),
        "mentalhealth_unmet": recode("mh_notget", {(1,): 1, (2,): 0}),
        "eviction_risk": recode("evict", {(1, 2): 1, (3, 4): 0}),
        "foreclosure_risk": recode("forclose", {(1, 2): 1, (3, 4): 0}),
        "learning_fewer": recode_at_least("tch_hrs", 3, (1, 2), at_least=0, under=1),
    }


def derived_signs() -> dict[str, Column]:
    """Signs built on the four scores, which must already be columns."""
    anxiety = score_threshold(col("anxious_score"), col("worry_score"))
    depression = score_threshold(col("interest_score"), col("down_score"))
    return {
        "anxiety_signs": anxiety,
        "depression_signs": depression,
        "depression_anxiety_signs": either_sign(anxiety, depression),
    }


def group_dummies(label: str = "hisp_rrace") -> dict[str, Column]:
    """0/1 per group; a missing label is 0 in all of them."""
    return {g: F.when(col(label).contains(mark), 1.0).otherwise(0.0) for g, mark in cb.GROUP_MARKS.items()}


def group_name(label: str = "hisp_rrace") -> Column:
    """Short group name of a label, null where the label is missing."""
    out = F.lit(None).cast("string")
    for group, mark in cb.GROUP_MARKS.items():
        out = F.when(col(label).contains(mark), group).otherwise(out)
    return out


def age_cut(metric: str, birth_year: str = "tbirth_year") -> Column:
    """Null out a metric for those born before the cutoff; an unknown year keeps it."""
    return F.when(col(birth_year) < cb.AGE_CUT_BIRTH_YEAR, F.lit(None).cast("double")).otherwise(col(metric))


def one_hot(source: str, values: Iterable[str], prefix: str | None = None) -> dict[str, Column]:
    """0/1 column per listed value; a null source stays null."""
    prefix = source if prefix is None else prefix
    return {
        f"{prefix}_{v}": F.when(col(source).isNotNull(), F.when(col(source) == v, 1).otherwise(0)) for v in values
    }


def week_label(week: str | Column = "week") -> Column:
    return F.concat(F.lit("wk"), col(week).cast("string"))


def padded_week(week: str | Column = "week") -> Column:
    return F.lpad(col(week).cast("string"), 2, "0")


def year_of_week(week: str | Column, starts: tuple = cb.MICRODATA_YEAR_STARTS) -> Column:
    """Year a week is filed under; ``starts`` pairs an exclusive upper week with a year."""
    out = F.lit(starts[-1][1])
    for upper, year in reversed(starts[:-1]):
        out = F.when(col(week) < upper, year).otherwise(out)
    return out


def week_from_name(name: str | Column, pattern: str = r"_(wk[0-9]+)\.") -> Column:
    """Week label inside a file name, null where there is none."""
    return F.nullif(F.regexp_extract(col(name), pattern, 1), F.lit(""))
