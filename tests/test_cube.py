import math
from itertools import product

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators.cube import _partial_schema, _sum_respondents, cell_cube, flattened, grouped_sums, packed, roll_up, with_rest
from tallyfold.functions.replicates import SurveyDesign
from tests.people import DESIGN, METRICS, frame, people

KEYS = ["week_num", "state", "cbsa_title", "race"]


def as_dict(df, keys):
    return {tuple(r[k] for k in [*keys, "metric"]): r for r in df.collect()}


def expected(rows, keys, metric):
    out = {}
    for p in rows:
        if p[metric] is None:
            continue
        cell = out.setdefault(tuple(p[k] for k in keys), [0, [0.0] * 5, [0.0] * 5, math.inf, -math.inf])
        cell[0] += 1
        for r, w in enumerate(p["w"]):
            cell[1][r] += w * p[metric]
            cell[2][r] += w
        cell[3], cell[4] = min(cell[3], p[metric]), max(cell[4], p[metric])
    return out


def check(found, rows, keys):
    total = 0
    for metric in METRICS:
        for key, (n, num, den, lo, hi) in expected(rows, keys, metric).items():
            row = found[(*key, metric)]
            assert (row["n"], row["lo"], row["hi"]) == (n, lo, hi)
            assert row["num"] == pytest.approx(num)
            assert row["den"] == pytest.approx(den)
            total += 1
    assert total == len(found)


@pytest.mark.parametrize("max_held", [4000, 1])
def test_cells_equal_plain_sums(spark, max_held):
    rows = people()
    df = grouped_sums(frame(spark, rows), DESIGN, METRICS, KEYS, max_held=max_held)
    check(as_dict(packed(df, 5), KEYS), rows, KEYS)


def test_grouping_sets_and_roll_up_agree_with_plain_sums(spark):
    rows = people()
    sets = [["week_num", "race"], ["week_num", "state"], []]
    direct = grouped_sums(frame(spark, rows), DESIGN, METRICS, KEYS, sets)
    rolled = roll_up(cell_cube(frame(spark, rows), DESIGN, METRICS, KEYS), DESIGN, KEYS, sets)
    for df in (packed(direct, 5), packed(rolled, 5)):
        for number, keys in enumerate(sets):
            check(as_dict(df.where(F.col("set_id") == number), keys), rows, keys)


def test_a_missing_weight_counts_as_nothing(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0, 2.0, 2.0, 2.0, 2.0), ("a", 0.0, None, None, None, None, None)],
        "k string, x double, pweight double, pweight1 double, pweight2 double, pweight3 double, pweight4 double",
    )
    row = cell_cube(df, DESIGN, ["x"], ["k"]).first()
    assert row["n"] == 2 and row["num"] == [2.0] * 5 and row["den"] == [2.0] * 5


def test_no_rows_give_no_cells(spark):
    assert cell_cube(frame(spark, people(4)).where("scram < 0"), DESIGN, METRICS, KEYS).count() == 0


def test_rest_is_everybody_else(spark):
    rows = people()
    cells = cell_cube(frame(spark, rows), DESIGN, METRICS, ["week_num", "state", "race"])
    rest = as_dict(with_rest(flattened(cells, 5), DESIGN, ["week_num", "state"], "race"), ["week_num", "state", "race"])
    for week, state, race in product(("wk13", "wk14"), ("AA", "BB", "CC"), ("asian", "black", "white", None)):
        for metric in METRICS:
            row = rest.get((week, state, race, metric))
            if row is None:
                continue
            others = [p for p in rows if (p["week_num"], p["state"]) == (week, state) and p["race"] != race]
            sums = expected(others, [], metric).get((), [0, [0.0] * 5, [0.0] * 5, math.inf, -math.inf])
            assert row["rest_n"] == sums[0]
            assert row["rest_num"] == pytest.approx(sums[1])
            assert row["rest_den"] == pytest.approx(sums[2])
            assert (row["rest_lo"], row["rest_hi"]) == ((sums[3], sums[4]) if sums[0] else (None, None))


def test_a_tiny_rest_keeps_its_digits(spark):
    rows = [("wk1", "big", "m", 3, 0.0, 1.0, [6e15], [9e15]), ("wk1", "small", "m", 2, 0.0, 1.0, [0.1], [0.3])]
    df = spark.createDataFrame(rows, "week_num string, race string, metric string, n bigint, lo double, hi double,"
                                     " num array<double>, den array<double>")
    one = SurveyDesign("pweight", ())
    out = {r["race"]: r for r in with_rest(flattened(df, 1), one, ["week_num"], "race").collect()}
    assert out["big"]["rest_num"] == [0.1] and out["big"]["rest_den"] == [0.3]


def test_a_task_hands_on_its_domains_and_no_more():
    rows = sorted(people(2000), key=lambda p: [(p[k] is not None, p[k] or "") for k in KEYS])
    sets = [["week_num"], ["week_num", "race"], ["week_num", "state", "race"]]
    names, schema = _partial_schema([T.StructField(k, T.StringType()) for k in KEYS], 5)
    task = _sum_respondents(KEYS, ["m_plain", "m_never"], 5, sets, schema, 4000)
    batches = [pa.RecordBatch.from_pydict({
        **{k: pa.array([p[k] for p in rows[i : i + 97]], pa.string()) for k in KEYS}, "w": [p["w"] for p in rows[i : i + 97]],
        "x": pa.array([[p["m_plain"], None] for p in rows[i : i + 97]], pa.list_(pa.float64()))}) for i in range(0, len(rows), 97)]
    handed = [r for batch in task(batches) for r in batch.to_pylist()]
    wanted = sum(len(expected(rows, keys, "m_plain")) for keys in sets)
    assert len(handed) == wanted and sum(r["n"] for r in handed if r["set_id"] == 0) == sum(p["m_plain"] is not None for p in rows)
    assert names.count("num_") == 5


def test_no_python_group_function_in_the_rest(spark):
    cells = flattened(cell_cube(frame(spark, people(50)), DESIGN, METRICS, ["week_num", "race"]), 5)
    plan = with_rest(cells, DESIGN, ["week_num"], "race")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "FlatMapGroups" not in plan


def test_no_task_sorts_its_wide_rows(spark):
    df = grouped_sums(frame(spark, people()), DESIGN, METRICS, KEYS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Sort" not in plan


def test_rows_in_any_order_are_handed_on_once():
    rows = people(2000)
    sets = [["week_num"], ["week_num", "state", "race"]]
    _, schema = _partial_schema([T.StructField(k, T.StringType()) for k in KEYS], 5)
    task = _sum_respondents(KEYS, ["m_plain"], 5, sets, schema, 4000)
    batches = [pa.RecordBatch.from_pydict({
        **{k: pa.array([p[k] for p in rows[i : i + 97]], pa.string()) for k in KEYS}, "w": [p["w"] for p in rows[i : i + 97]],
        "x": pa.array([[p["m_plain"]] for p in rows[i : i + 97]], pa.list_(pa.float64()))}) for i in range(0, len(rows), 97)]
    handed = [r for batch in task(batches) for r in batch.to_pylist()]
    for number, keys in enumerate(sets):
        wanted = expected(rows, keys, "m_plain")
        found = {tuple(r[k] for k in keys): r for r in handed if r["set_id"] == number}
        assert len([r for r in handed if r["set_id"] == number]) == len(found) == len(wanted)
        for key, (n, num, _, lo, hi) in wanted.items():
            assert (found[key]["n"], found[key]["lo"], found[key]["hi"]) == (n, lo, hi)
            assert [found[key][f"num_{i}"] for i in range(5)] == pytest.approx(num)
