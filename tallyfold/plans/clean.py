"""From harmonised answers to the cleaned microdata file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions.recode import derived_signs, simple_indicators, week_label
from tallyfold.operators.joins import join_dimension, join_weights


def add_indicators(df: DataFrame) -> DataFrame:
    """All indicators and the week label."""
    return df.withColumns(simple_indicators()).withColumns(
        {**derived_signs(), "est_msa": F.col("est_msa").cast("string"), "week_num": week_label()}
    )


def clean_microdata(answers: DataFrame, states: DataFrame, metros: DataFrame, weights: DataFrame) -> DataFrame:
    """Indicators, area names and replicate weights for harmonised answers of any weeks."""
    named = join_dimension(add_indicators(answers), states, "est_st", "state_code", ["state"])
    named = join_dimension(named, metros, "est_msa", "cbsa_code", ["cbsa_title", "csa_title"])
    return join_weights(named, weights)


def split_income_question(df: DataFrame) -> DataFrame:
    """Answers from the week the question changed move to inc_loss_rv."""
    new = F.col("week") >= cb.INCOME_SPLIT_WEEK
    return df.withColumns(
        {"inc_loss_rv": F.when(new, F.col("inc_loss")), "inc_loss": F.when(~new, F.col("inc_loss"))}
    )
