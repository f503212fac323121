import pytest
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions import recode as rc
from tallyfold.operators.columns import snake_case, text_to_double
from tallyfold.plans.clean import add_indicators, split_income_question
from tallyfold.sources.microdata import microdata_year


def answers(spark, **given):
    """One respondent with every answer missing but the given ones."""
    base = {"scram": "a", "week": 13, "est_st": "01", "est_msa": "10000", "tbirth_year": 1980,
            **{c: None for c in cb.ANSWER_COLUMNS}}
    values = base | given
    kinds = {"scram": "string", "week": "int", "est_st": "string", "est_msa": "string", "tbirth_year": "int"}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in values)
    row = [float(v) if c in cb.ANSWER_COLUMNS and v is not None else v for c, v in values.items()]
    return spark.createDataFrame([tuple(row)], schema)


def indicator(spark, name, **given):
    return add_indicators(answers(spark, **given)).first()[name]


def insurance(*codes):
    return {f"hlthins{n}": c for n, c in enumerate(codes, start=1)}


CASES = [
    ("hisp_rrace", {"rrace": 2, "rhispanic": 1}, "Black alone, not Hispanic"),
    ("hisp_rrace", {"rrace": 2, "rhispanic": 2}, cb.HISPANIC_LABEL),
    ("hisp_rrace", {"rrace": 3}, "Asian alone, not Hispanic"),
    ("hisp_rrace", {"rrace": -99, "rhispanic": 1}, None),
    ("uninsured", insurance(2, 2, 1, 2, 2, 2, 1, 2), 0.0),
    ("uninsured", insurance(2, 2, 2, 2, 2, 2, 2, 2), 1.0),
    ("uninsured", insurance(-99, 2, 2, 2, 2, 2, 1, 2), 1.0),
    ("uninsured", insurance(-99, 2, 2, 2, 2, 2, 2, 2), None),
    ("insured_public", insurance(2, 2, -99, 1, 2, 2, 2, 2), 1.0),
    ("insured_public", insurance(*[-99] * 8), None),
    ("insured_public", insurance(*[-88] * 8), None),
    ("insured_public", insurance(*[-99] * 4, *[-88] * 4), 0.0),
    ("insured_public", {}, 0.0),
    ("payment_not_conf", {"mortconf": 5}, 1.0),
    ("rent_not_conf", {"mortconf": 5, "tenure": 3}, 1.0),
    ("rent_not_conf", {"mortconf": 4, "tenure": 2}, None),
    ("mortgage_not_conf", {"mortconf": 4, "tenure": 2}, 0.0),
    ("rent_caughtup", {"rentcur": 2, "tenure": 3}, 0.0),
    ("mortgage_caughtup", {"mortcur": 1}, None),
    ("food_insufficient", {"curfoodsuf": 3}, 1.0),
    ("spend_snap", {"spndsrc8": 1}, 1.0),
    ("spend_snap", {"spndsrc8": -99, "spndsrc1": 1}, 0.0),
    ("spend_snap", {"spndsrc8": -99}, None),
    ("expense_dif", {"expns_dif": 4}, 1.0),
    ("expense_dif", {"expns_dif": -99}, None),
    ("learning_fewer", {"tch_hrs": 5}, 0.0),
    ("telework", {"tw_start": 3}, 0.0),
    ("anxiety_signs", {"anxious": 4}, 1.0),
    ("anxiety_signs", {"anxious": 3}, 0.0),
    ("anxiety_signs", {"anxious": -99, "worry": -88}, None),
    ("depression_anxiety_signs", {"anxious": 1, "worry": 1}, 0.0),
    ("depression_anxiety_signs", {"down": 4, "interest": 1}, 1.0),
    ("depression_anxiety_signs", {}, None),
]


def test_indicators_case_by_case(spark):
    frames = [answers(spark, **given, scram=str(i)) for i, (_, given, _) in enumerate(CASES)]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f)
    rows = {r["scram"]: r for r in add_indicators(stacked).collect()}
    wrong = [(name, given, rows[str(i)][name]) for i, (name, given, want) in enumerate(CASES) if rows[str(i)][name] != want]
    assert not wrong


def test_income_question_splits_at_its_week(spark):
    df = split_income_question(add_indicators(
        answers(spark, wrkloss=1, week=27).unionByName(answers(spark, wrkloss=2, week=28))))
    assert [(r["inc_loss"], r["inc_loss_rv"]) for r in df.orderBy("week").collect()] == [(1.0, None), (None, 0.0)]


def test_dummies_of_a_missing_group_are_zero(spark):
    df = spark.createDataFrame([(None,), (cb.HISPANIC_LABEL,)], "hisp_rrace string")
    rows = df.select(*[c.alias(g) for g, c in rc.group_dummies().items()]).collect()
    assert sum(rows[0]) == 0
    assert rows[1]["hispanic"] == 1 and sum(rows[1]) == 1


def test_one_hot_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "g string")
    rows = df.select(*[c.alias(n) for n, c in rc.one_hot("g", ["a", "b"]).items()]).collect()
    assert [tuple(r) for r in rows] == [(1, 0), (None, None)]


def test_labels_years_and_names(spark):
    df = spark.createDataFrame([(21,), (22,), (40,), (41,), (42,)], "week int")
    rows = df.select(rc.year_of_week("week"), rc.year_of_week("week", cb.BENCHMARK_YEAR_STARTS)).collect()
    assert [tuple(r) for r in rows] == [(2020, 2020), (2021, 2021), (2021, 2021), (2022, 2021), (2022, 2022)]
    assert [microdata_year(w) for w in (21, 22, 41)] == [2020, 2021, 2022]
    names = spark.createDataFrame([("x/food2_wk30.xlsx",), ("none",)], "f string")
    assert [r[0] for r in names.select(rc.week_from_name("f")).collect()] == ["wk30", None]


def test_snake_case_refuses_a_clash(spark):
    assert snake_case(spark.range(1).toDF("CBSA Code")).columns == ["cbsa_code"]
    with pytest.raises(ValueError):
        snake_case(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))


def test_text_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("-",), (None,)], "c string")
    assert [r["c"] for r in df.withColumns(text_to_double(["c"])).collect()] == [1.5, None, None]
    assert [r["c"] for r in df.withColumns(text_to_double(["c"], 0.0)).collect()] == [1.5, 0.0, 0.0]
    assert df.select(rc.null_skipping_sum(F.lit(None).cast("double"), F.lit(2.0))).first()[0] == 2.0
