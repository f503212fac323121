"""Respondents derived from orders, customers and nations: one per order.

The expressions are SQL text that Spark and the checking database read alike,
so both start from the same respondents. Recodes and statistics are written
separately for either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions.replicates import SurveyDesign
from tallyfold.operators.joins import join_dimension
from tallyfold.plans.clean import add_indicators, split_income_question
from tallyfold.plans.estimates import estimation_input

N_REPLICATES = 80
DESIGN = SurveyDesign.of(N_REPLICATES)
FIRST_WEEK, LAST_WEEK = 13, 47

# the 80 months of the orders as 35 weeks, which cross all questionnaire layouts
WEEK = "13 + cast(floor(((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1) * 35 / 80) as int)"
# the regions as metro areas
REGION_METROS = tuple(m[0] for m in cb.METROS[:5])
METRO_SQL = "case r_regionkey " + " ".join(f"when {i} then '{title}'" for i, title in enumerate(REGION_METROS)) + " end"

# column -> (question number, number of answers, first and last week asked)
QUESTIONS = {
    "wrkloss": (1, 2, 13, 99),
    "expctloss": (2, 2, 13, 33),
    "mortconf": (3, 5, 13, 45),
    "tenure": (4, 4, 13, 99),
    "rentcur": (5, 2, 13, 99),
    "mortcur": (6, 2, 13, 99),
    "curfoodsuf": (7, 4, 13, 99),
    "expns_dif": (8, 4, 13, 99),
    "tw_start": (9, 3, 13, 27),
    "mh_notget": (10, 2, 13, 45),
    "evict": (11, 4, 13, 99),
    "forclose": (12, 4, 13, 99),
    "tch_hrs": (13, 5, 13, 27),
    "anxious": (14, 4, 13, 99),
    "worry": (15, 4, 13, 99),
    "interest": (16, 4, 13, 99),
    "down": (17, 4, 13, 99),
    **{f"hlthins{n}": (17 + n, 2, 13, 99) for n in range(1, 9)},
    **{f"spndsrc{n}": (25 + n, 2, 13, 99) for n in range(1, 9)},
    "spndsrc9": (34, 2, 28, 99),
    **{f"spndsrc{n}": (25 + n, 2, 34, 99) for n in range(10, 13)},
}


def scramble(number: int) -> str:
    return f"(o_orderkey * 7919 + {104729 * number}) % 10007"


def coded_answer(column: str) -> str:
    """Answer code before the weeks a question was not asked are emptied."""
    number, options, _, _ = QUESTIONS[column]
    h = scramble(number)
    answer = f"{h} % {options} + 1"
    if column.startswith("spndsrc"):
        answer = f"case when {answer} = 2 then -99 else 1 end"
    return f"cast(case when {h} % 17 = 0 then -99 when {h} % 19 = 0 then -88 else {answer} end as double)"


def answer(column: str) -> str:
    _, _, first, last = QUESTIONS[column]
    if (first, last) == (13, 99):
        return coded_answer(column)
    return f"case when {WEEK} between {first} and {last} then {coded_answer(column)} end"


UNKNOWN_RACE = f"{scramble(0)} % 50 = 0"
BASE = {
    "scram": "o_orderkey",
    "week": f"cast({WEEK} as int)",
    "est_st": "lpad(cast(n_nationkey as varchar(2)), 2, '0')",
    "est_msa": "case when o_custkey % 3 = 0 then cast(10000 + n_regionkey as varchar(5)) end",
    "tbirth_year": f"cast(1930 + {scramble(40)} % 75 as int)",
    "rrace": f"cast(case when {UNKNOWN_RACE} then -99 when c_mktsegment = 'AUTOMOBILE' then 1 "
             "when c_mktsegment = 'BUILDING' then 2 when c_mktsegment = 'FURNITURE' then 3 "
             "when c_mktsegment = 'HOUSEHOLD' then 4 when c_mktsegment = 'MACHINERY' then 1 end as double)",
    "rhispanic": f"cast(case when {UNKNOWN_RACE} then 1 when c_mktsegment = 'MACHINERY' then 2 else 1 end as double)",
    "pweight": "o_totalprice",
}


def weight_sql(r: int) -> str:
    return f"o_totalprice * case when bit_count(o_orderkey & {r}) % 2 = 0 then 1.5 else 0.5 end"


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).join(
        nations, customers["c_nationkey"] == nations["n_nationkey"]
    )
    # laid out by day, as the weekly run's table is by week; after the joins, whose shuffle would deal the days out again
    return joined.repartitionByRange("o_orderdate")


def _columns(items: dict[str, str]) -> list[str]:
    return [f"{sql} as {name}" for name, sql in items.items()]


def answers(spark: SparkSession, sf_dir: str, weights: bool = False) -> DataFrame:
    """Harmonised answers with the base weight; ``weights`` adds the replicates."""
    items = {**BASE, **{c: answer(c) for c in QUESTIONS}}
    if weights:
        items |= {name: weight_sql(r) for r, name in enumerate(DESIGN.replicates, start=1)}
    return _source(spark, sf_dir).selectExpr(*_columns(items))


def raw_layout(spark: SparkSession, sf_dir: str, phase: dict, weeks: list[int]) -> DataFrame:
    """Answers of one questionnaire layout under that layout's own column names, in capitals as landed."""
    raw_name = {new: old for old, new in phase["renames"].items()}
    asked = {c: coded_answer(c) for c in QUESTIONS if c not in phase["absent"]}
    source = _source(spark, sf_dir).where(F.expr(WEEK).between(min(weeks), max(weeks)))
    base = {k: v for k, v in BASE.items() if k != "pweight"}
    named = {raw_name.get(c, c): sql for c, sql in asked.items()}
    return source.selectExpr(*_columns({n.upper(): sql for n, sql in {**base, **named}.items()}))


def weight_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicate weights as they land: one row per week and respondent."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    items = {"week": BASE["week"], "scram": BASE["scram"], "pweight": BASE["pweight"]}
    items |= {name: weight_sql(r) for r, name in enumerate(DESIGN.replicates, start=1)}
    return orders.selectExpr(*_columns(items))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return nations.select(
        F.col("n_name").alias("state"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("state_code"),
        F.initcap(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("state_name"),
    )


def metros(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = spark.read.parquet(f"{sf_dir}/region.parquet")
    return regions.select(
        (F.col("r_regionkey") + 10000).cast("string").alias("cbsa_code"),
        F.concat("r_name", F.lit(" area")).alias("csa_title"),
        F.expr(METRO_SQL).alias("cbsa_title"),
    )


def indicators(spark: SparkSession, sf_dir: str, weights: bool = False) -> DataFrame:
    """Answers with all indicators."""
    return add_indicators(answers(spark, sf_dir, weights))


def microdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned microdata with area names and replicate weights, income question split."""
    named = join_dimension(
        indicators(spark, sf_dir, weights=True), states(spark, sf_dir), "est_st", "state_code", ["state"]
    )
    named = join_dimension(named, metros(spark, sf_dir), "est_msa", "cbsa_code", ["cbsa_title", "csa_title"])
    return split_income_question(named)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microdata as it is estimated."""
    return estimation_input(microdata(spark, sf_dir))
