"""Published tables in long form: race rows, layouts by table and week, shares."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.operators.columns import text_to_double

VALUES = [f"c{i}" for i in range(1, cb.BENCHMARK_MAX_COLUMNS + 1)]


def race_rows(lines: DataFrame) -> DataFrame:
    """Lines about Hispanic origin and race, without the section header that comes first on a sheet."""
    sheet = Window.partitionBy("table_name", "week", "geography").orderBy("line_no")
    hits = lines.where(F.col("variable").contains("Hispanic"))
    return hits.select("*", F.row_number().over(sheet).alias("_line")).where("_line > 1").drop("_line")


def _ratios(layout: dict) -> str:
    """The layout's shares as SQL text, its columns' names replaced by their positions."""
    position = {name: f"c{i}" for i, name in enumerate(layout["columns"], start=1)}

    def formula(text: str) -> str:
        return "cast(" + re.sub(r"[a-z]\w*", lambda m: position[m.group()], text) + " as double)"

    rows = [f"named_struct('metric', '{metric}', 'numerator', {formula(top)}, 'denominator', {formula(bottom)})"
            for metric, top, bottom in layout["ratios"]]
    return f"array({', '.join(rows)})"


def _applies(layout: dict) -> str:
    first, last = layout["weeks"]
    hit = f"table_name = '{layout['table']}' and week between {first} and {last}"
    return hit if layout["n_cols"] is None else f"{hit} and n_cols = {layout['n_cols']}"


def unknown_lines(lines: DataFrame) -> DataFrame:
    """Race lines whose table, week and width fit no layout."""
    known = " or ".join(f"coalesce({_applies(layout)}, false)" for layout in cb.BENCHMARK_LAYOUTS)
    return race_rows(lines).where(f"not ({known})")


def benchmark_ratios(lines: DataFrame, metro_names: DataFrame) -> DataFrame:
    """Shares of every table in one job: the layout is chosen per row by table, week and width.

    What is no number counts as 0, as the tables leave cells empty for it. A line whose table, week and width fit
    no layout ends the job; ``unknown_lines`` lists such lines.
    """
    rows = race_rows(lines).withColumns(text_to_double(VALUES, fill=0.0))
    cases = " ".join(f"when {_applies(layout)} then {_ratios(layout)}" for layout in cb.BENCHMARK_LAYOUTS)
    unknown = "concat_ws(' ', 'no layout is known for table', table_name, 'of week', cast(week as string), 'with columns:', cast(n_cols as string))"
    ratios = F.expr(f"case {cases} else raise_error({unknown}) end")
    label = F.col("variable")
    race = F.when(label == cb.HISPANIC_LABEL, "hispanic")
    for text, group in zip(cb.RACE_LABELS.values(), ("white", "black", "asian", "other")):
        race = race.when(label == text, group)
    named = rows.join(
        F.broadcast(metro_names), F.col("geography") == F.col("data_table_msa_name"), "left"
    )
    geography = F.when(F.col("geography").contains("Metro_Area"), F.col("msa_name")).otherwise(F.col("geography"))
    return named.select(
        "table_name", "week",
        F.concat(F.lit("wk"), F.col("week")).alias("week_num"),
        geography.alias("geography"),
        race.otherwise(label).alias("race_var"),
        F.inline(ratios),
    ).withColumn("share", F.try_divide("numerator", "denominator"))


def benchmark_shares(ratios: DataFrame) -> DataFrame:
    """One share per week, geography, group and metric: sums first, then the division."""
    return ratios.groupBy("week_num", "geography", "race_var", "metric").agg(
        F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator")
    ).withColumn("benchmark_mean", F.try_divide("numerator", "denominator"))
