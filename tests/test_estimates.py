import math
from dataclasses import replace
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions.replicates import SurveyDesign, confidence, significance
from tallyfold.operators.contrast import STATS, domain_means, weighted_means
from tallyfold.operators.cube import cell_cube
from tallyfold.plans import estimates as es
from tallyfold.plans import qc
from tallyfold.standin import catalog
from tests import brute
from tests.people import DESIGN, GROUPS, METRICS, frame, people

ALL = es.EstimateOptions(metrics=METRICS, groups=GROUPS, removed=("m_never",))


def keyed(df):
    return {(r["week_num"], r["geo_type"], r["geography"], r["race_var"], r["metric"]): r for r in df.collect()}


def wanted(rows, null_geo_in_rest=False):
    out = {}
    for week in ("wk13", "wk14"):
        in_week = [p for p in rows if p["week_num"] == week]
        for geo_type, key, names in (("state", "state", ("AA", "BB", "CC")), ("msa", "cbsa_title", ("North", "South"))):
            for name in names:
                here = [p for p in in_week if p[key] == name]
                there = [p for p in in_week if p[key] != name and (null_geo_in_rest or p[key] is not None)]
                for metric in METRICS:
                    out[week, geo_type, name, "total", metric] = brute.contrast(here, there, metric)
                    for g in GROUPS:
                        out[week, geo_type, name, g, metric] = brute.contrast(
                            [p for p in here if p["race"] == g], [p for p in here if p["race"] != g], metric)
        for metric in METRICS:
            for g in GROUPS:
                out[week, "national", "US", g, metric] = brute.contrast(
                    [p for p in in_week if p["race"] == g], [p for p in in_week if p["race"] != g], metric)
    return out


def same(row, stats):
    for s in STATS:
        if stats[s] is None:
            assert row[s] is None, s
        else:
            assert row[s] == pytest.approx(stats[s], abs=1e-9), s


@pytest.mark.parametrize("null_geo_in_rest", [False, True])
def test_all_families_against_plain_python(spark, null_geo_in_rest):
    rows = people()
    options = es.EstimateOptions(metrics=METRICS, groups=GROUPS, removed=("m_never",),
                                 null_geo_in_rest=null_geo_in_rest)
    found = keyed(es.estimate(frame(spark, rows), DESIGN, options))
    expected = wanted(rows, null_geo_in_rest)
    for key, stats in expected.items():
        same(found.pop(key), stats)
    # what remains are national totals: answered metrics and the removed one, in both weeks
    for (week, _, geography, race, metric), row in found.items():
        assert (geography, race) == ("US", "total")
        here = brute.thetas([p for p in rows if p["week_num"] == week], metric)
        if metric == "m_never":
            assert row["mean"] is None and row["se"] == 0
        else:
            assert row["mean"] == pytest.approx(here[0])
            assert row["se"] == pytest.approx(brute.spread(here))
            assert row["diff_mean"] is None
    assert {k[4] for k in found} == set(METRICS)


def test_from_a_kept_cube_comes_the_same(spark, tmp_path):
    df = frame(spark, people())
    cell_cube(df, DESIGN, METRICS, es.CELL_KEYS).write.parquet(str(tmp_path / "cube"))
    again = keyed(es.estimate_from_cube(spark.read.parquet(str(tmp_path / "cube")), DESIGN, ALL))
    for key, row in keyed(es.estimate(df, DESIGN, ALL)).items():
        same(again.pop(key), row)
    assert not again


def test_four_replicates_by_hand(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, 2.0, 1.0, 1.0, 1.0), ("a", 0.0, 1.0, 1.0, 2.0, 1.0, 3.0)],
        "k string, x double, pweight double, pweight1 double, pweight2 double, pweight3 double, pweight4 double",
    )
    row = weighted_means(cell_cube(df, DESIGN, ["x"], ["k"]), DESIGN).first()
    # estimates 1/2; 2/3, 1/3, 1/2, 1/4
    assert row["mean"] == 0.5
    assert row["se"] == pytest.approx(2 * math.sqrt((2 * (1 / 6) ** 2 + (1 / 4) ** 2) / 4))


def test_twice_the_root_is_the_published_formula():
    design = SurveyDesign.of(80)
    assert design.se_factor**2 * design.scale == pytest.approx(4 / 80)


def test_replicates_equal_to_the_base_have_no_error(spark):
    rows = [{**p, "w": [p["w"][0]] * 5} for p in people()]
    assert es.estimate(frame(spark, rows), DESIGN, ALL).where("abs(se) > 1e-12").count() == 0


def test_flags_and_bounds(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (0.2, 0.0), (0.2, 0.1), (-0.2, 0.1), (0.1, 0.1), (None, None)], "d double, s double")
    assert [r[0] for r in df.select(significance(F.col("d"), F.col("s"))).collect()] == [None, 1.0, 1.0, 1.0, 0.0, None]
    bounds = confidence(F.lit(0.5), F.lit(0.1))
    row = df.limit(1).select(*[c.alias(k) for k, c in bounds.items()]).first()
    assert (row["moe_95"], row["moe_95_lb"], row["moe_95_ub"]) == pytest.approx((0.196, 0.304, 0.696))


def test_constant_metric_is_not_significant_and_empty_side_is_null(spark):
    out = keyed(es.publish_columns(es.estimate(frame(spark, people()), DESIGN, ALL)))
    constant = out["wk13", "state", "AA", "white", "m_constant"]
    assert (constant["mean"], constant["se"], constant["sigdiff"]) == (1.0, 0.0, None)
    empty = out["wk13", "state", "CC", "asian", "m_plain"]
    assert (empty["mean"], empty["se"], empty["moe_95"], empty["moe_95_lb"], empty["sigdiff"]) == (None, 0.0, 0.0, None, None)


def test_relabel_moves_the_income_metric(spark):
    feature = spark.createDataFrame(
        [("US", "inc_loss", "wk46", "black", 0.4, 0.1, 0.2, 0.2, 0.6, "national", 1.0, "d"),
         ("US", "telework", "wk46", "black", 0.3, 0.1, 0.2, 0.1, 0.5, "national", 0.0, "d")],
        "geography string, metric string, week_num string, race_var string, mean double, se double, moe_95 double,"
        " moe_95_lb double, moe_95_ub double, geo_type string, sigdiff double, date_int string")
    rows = {r["metric"]: r for r in es.relabel_split_metric(feature).collect()}
    assert set(rows) == {"inc_loss", "inc_loss_rv", "telework"}
    assert (rows["inc_loss"]["mean"], rows["inc_loss"]["se"], rows["inc_loss"]["var_removed"]) == (None, 0.0, 1.0)
    assert (rows["inc_loss_rv"]["mean"], rows["inc_loss_rv"]["sigdiff"], rows["inc_loss_rv"]["var_removed"]) == (0.4, 1.0, 0.0)
    assert (rows["telework"]["mean"], rows["telework"]["var_removed"]) == (0.3, 1.0)


def test_complete_grid_passes_and_a_gap_raises(spark):
    rows = [p for p in people() if not (p["state"] == "CC" and p["week_num"] == "wk14")]
    weeks = ["wk13", "wk14"]
    df = frame(spark, rows)
    places = es.areas(df).union(spark.createDataFrame([("state", "DD")], "geo_type string, geography string"))
    n = len(METRICS) * 4 * 6 * 2  # four states, one of them empty and one missing in a week, and two metros
    whole = es.estimate(df, DESIGN, replace(ALL, weeks=weeks, families=(es.GEO_GROUP, es.GEO_TOTAL)), places)
    row = es.expected_grid_count(whole, places, weeks, METRICS, GROUPS).first()
    assert (row["n_found"], row["n_expected"], row["complete"]) == (n, n, True)
    empty = whole.where("geography = 'CC' and week_num = 'wk14'").collect()
    assert len(empty) == len(METRICS) * 4 and all(r["mean"] is None and r["se"] == 0 for r in empty)
    # without the list of weeks and places the gaps are found
    gaps = es.estimate(df, DESIGN, replace(ALL, families=(es.GEO_GROUP, es.GEO_TOTAL)))
    row = es.expected_grid_count(gaps, places, weeks, METRICS, GROUPS).first()
    assert row["n_found"] < row["n_expected"] == n and not row["complete"]
    with pytest.raises(ValueError):
        es.assert_complete(gaps, places, weeks, METRICS)


def test_latest_weeks(spark):
    df = spark.createDataFrame([(w,) for w in (13, 40, 46, 47, 47)], "week int")
    assert sorted(r[0] for r in es.latest_weeks(df).collect()) == [46, 47, 47]


def test_income_questions_meet_and_age_cut(spark):
    df = spark.createDataFrame(
        [(27, 1.0, None, 1950, 1.0, 1.0, cb.HISPANIC_LABEL), (28, None, 0.0, None, 1.0, 0.0, None)],
        "week int, inc_loss double, inc_loss_rv double, tbirth_year int, uninsured double, insured_public double,"
        " hisp_rrace string")
    old, new = es.estimation_input(df).orderBy("week").collect()
    assert (old["inc_loss"], old["uninsured"], old["race"]) == (1.0, None, "hispanic")
    assert (new["inc_loss"], new["uninsured"], new["race"]) == (0.0, 1.0, None)


def test_regression_and_manual_formula_agree_with_the_contrasts(spark):
    df = frame(spark, people())
    options = es.EstimateOptions(metrics=METRICS, groups=GROUPS, families=(es.GEO_GROUP, es.US_GROUP))
    sides = qc.respondent_sides(df, DESIGN, ("state", "msa", "national"), METRICS, GROUPS)
    estimates = es.estimate(df, DESIGN, options)
    for checked in (qc.regression_check(sides, estimates, DESIGN),
                    qc.manual_check(qc.manual_contrasts(sides, DESIGN), estimates)):
        flags = [r["agree"] for r in checked.collect()]
        assert flags and all(flags)
    opposite = qc.regression_check(sides, estimates, DESIGN).where("abs(slope + diff_mean) > 1e-9")
    assert opposite.count() == 0


def test_checks_find_a_wrong_cube(spark):
    df = frame(spark, people())
    options = es.EstimateOptions(metrics=METRICS, groups=GROUPS, families=(es.GEO_GROUP, es.US_GROUP))
    sides = qc.respondent_sides(df, DESIGN, ("state", "msa", "national"), METRICS, GROUPS)
    domain = es.domains(df, DESIGN, options)
    shifted = domain.withColumns({f"num_{i}": F.when(F.col("race_var") == "black", F.col(f"num_{i}") * 1.01).otherwise(F.col(f"num_{i}"))
                                  for i in range(len(DESIGN.columns))})
    wrong = es.dense(es.contrasts(shifted, DESIGN), options)
    for checked in (qc.regression_check(sides, wrong, DESIGN), qc.manual_check(qc.manual_contrasts(sides, DESIGN), wrong)):
        flags = {(r["metric"], r["race_var"]): r["agree"] for r in checked.where("geo_type = 'national'").collect()}
        assert not flags["m_plain", "black"]


def test_group_versus_total_by_hand(spark):
    rows = people()
    found = keyed(qc.manual_contrasts(qc.respondent_sides(frame(spark, rows), DESIGN, ("national",), METRICS, GROUPS), DESIGN))
    here = [p for p in rows if p["week_num"] == "wk13"]
    total, own = brute.thetas(here, "m_plain"), brute.thetas([p for p in here if p["race"] == "black"], "m_plain")
    diff = [t - o for t, o in zip(total, own)]
    row = found["wk13", "national", "US", "black", "m_plain"]
    assert row["total_group"] == pytest.approx(diff[0])
    assert row["total_group_se"] == pytest.approx(brute.spread(diff))


def test_respondents_are_not_multiplied_for_their_sums(spark):
    df = frame(spark, people())
    for out in (qc.respondent_sides(df, DESIGN, ("state", "msa", "national"), METRICS, GROUPS),
                domain_means(df, "pweight", list(METRICS), ["week_num", "race"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # the lowest lines are the respondents: nothing unpivots them before they are added up
        below = plan[max(plan.rfind("MapInArrow"), plan.rfind("Aggregate")) :]
        assert "Generate" not in below and "Expand" not in below


def test_sides_equal_plain_sums_in_chunks_of_any_size(spark):
    rows = people()
    rows[5]["w"][2] = None
    areas = {"state": "state", "msa": "cbsa_title", "national": None}
    task = qc._area_sums(tuple(areas), METRICS, pa.schema(
        [*[(k, pa.string()) for k in ("week_num", "metric", "geo_type", "geography", "race")], ("n", pa.int64()),
         *[(f"{kind}_{i}", pa.float64()) for kind in ("num", "den") for i in range(5)]]))
    texts = ("week_num", "state", "cbsa_title", "race")
    batches = [pa.RecordBatch.from_pydict({**{k: pa.array([p[k] for p in part], pa.string()) for k in texts}, "w": [p["w"] for p in part],
               "x": pa.array([[p[m] for m in METRICS] for p in part], pa.list_(pa.float64()))}) for part in (rows[:150], rows[150:])]
    wanted = {}
    for p in rows:
        for (kind, column), metric in product(areas.items(), METRICS):
            place = "US" if column is None else p[column]
            if place is not None and p[metric] is not None:
                cell = wanted.setdefault((p["week_num"], metric, kind, place, p["race"]), np.zeros(11))
                w = np.array([x or 0.0 for x in p["w"]])
                cell += np.concatenate([[1], w * p[metric], w])
    # together, and a batch at a time: the sums of the parts are those of the whole
    for parts in ([batches], [[b] for b in batches]):
        found = {}
        for r in (r for part in parts for batch in task(part) for r in batch.to_pylist()):
            values = list(r.values())
            found[tuple(values[:5])] = found.get(tuple(values[:5]), 0) + np.array(values[5:])
        assert found.keys() == wanted.keys()
        assert all(found[k] == pytest.approx(wanted[k]) for k in wanted)
    assert not list(task([])) and not list(task([batches[0].slice(0, 0)]))


def test_means_leave_out_what_has_no_answers(spark):
    rows = people()
    rows[3]["w"][0] = None
    found = {(r["week_num"], r["race"], r["metric"]): r for r in domain_means(frame(spark, rows), "pweight", list(METRICS), ["week_num", "race"]).collect()}
    wanted = {}
    for p, metric in product(rows, METRICS):
        if p[metric] is not None:
            w = p["w"][0]
            cell = wanted.setdefault((p["week_num"], p["race"], metric), [0, 0.0, 0.0])
            cell[:] = cell[0] + 1, cell[1] + (w or 0.0) * p[metric], cell[2] + (w or 0.0)
    assert found.keys() == wanted.keys()
    for key, (n, num, den) in wanted.items():
        assert found[key]["n"] == n and found[key]["mean"] == pytest.approx(num / den)


def test_history_and_run_are_summed_once(spark, sf):
    plan = catalog.append_idempotent(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Hispanic" not in plan
