import pytest
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.operators import benchmark as bm
from tallyfold.operators import history as hs
from tallyfold.plans import qc
from tallyfold.plans import response as rp
from tallyfold.sources import literals, microdata, sinks


@pytest.fixture
def flags(spark):
    names = list(cb.ANSWERED_METRICS)
    rows = [("wk13", "A", 2.0, 1.0, 1.0), ("wk13", "A", None, None, 0.0), ("wk13", None, -99.0, None, 1.0),
            ("wk28", "B", 1.0, None, None)]
    df = spark.createDataFrame(rows, "week_num string, hisp_rrace string, tenure double, telework double, inc_loss double")
    extra = {n: F.lit(1.0) for n in names if n not in ("telework", "inc_loss")}
    return rp.answered_flags(df.withColumns(extra))


def test_flags_and_rates(flags):
    assert [r["answered_tenure"] for r in flags.collect()] == [1.0, None, 0.0, 1.0]
    rates = {(r["week_num"], r["hisp_rrace"]): r for r in rp.response_rate_with_total(flags).collect()}
    assert len(rates) == 5
    assert rates["wk13", "A"]["answered_telework"] == 0.5
    assert rates["wk13", None]["answered_telework"] == 0.0
    assert rates["wk13", "Total"]["answered_telework"] == pytest.approx(1 / 3)
    assert rates["wk13", "A"]["answered_tenure"] == 1.0


def test_mix_of_a_question_nobody_answered_is_null(flags):
    mix = {(r["week_num"], r["hisp_rrace"]): r for r in rp.race_mix_of_answerers(flags).collect()}
    assert mix["wk28", "B"]["answered_telework"] is None
    assert mix["wk13", "A"]["answered_telework"] == 1.0
    assert mix["wk13", None]["answered_hisp_rrace"] == 0.0


def test_outcome_among_answerers_and_others(flags):
    rows = {(r["hisp_rrace"], r["answered"]): r for r in rp.outcome_by_answered(flags).collect()}
    assert rows["A", 1.0]["answered_telework"] == 1.0 and rows["A", 0.0]["answered_telework"] == 0.0
    assert rows["Total", 0.0]["answered_telework"] == 0.5
    assert rows["A", None]["answered_tenure"] == 0.0


def test_missing_reports(spark):
    df = spark.createDataFrame([("wk42", 1.0, None), ("wk42", None, None), ("wk43", None, 2.0)],
                               "week_num string, a double, b double")
    shares = rp.missing_share(df)
    assert {r["week_num"]: (r["a"], r["b"]) for r in shares.collect()} == {"wk42": (0.5, 1.0), "wk43": (1.0, 0.0)}
    assert {r["week_num"]: r["n_all_missing"] for r in rp.all_missing_count(shares).collect()} == {"wk42": 1, "wk43": 1}
    assert {r["variable"] for r in rp.missing_drift(shares, "wk42", "wk43").collect()} == {"a", "b"}


def test_loading_a_run_twice_changes_nothing(spark, tmp_path):
    history = spark.createDataFrame([("wk13", 1), ("wk14", 2)], "week_num string, v int")
    run = spark.createDataFrame([("wk14", 3), ("wk15", 4)], "week_num string, v int")
    once = hs.append_idempotent(history, run)
    twice = hs.append_idempotent(once, run)
    want = [("wk13", 1), ("wk14", 3), ("wk15", 4)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want
    path = str(tmp_path / "history")
    sinks.write_table(history, path)
    for _ in range(2):
        sinks.overwrite_periods(run, path)
    assert sorted((r["week_num"], r["v"]) for r in spark.read.parquet(path).collect()) == want


def test_order_puts_weeks_by_number_and_unknown_last(spark):
    df = spark.createDataFrame(
        [("m", "r", "g", w) for w in ("wk9", "wk40", "wk13", None)] + [("a", "r", None, "wk14"), ("a", "r", "g", "wk15")],
        "metric string, race_var string, geography string, week_num string")
    found = [(r["metric"], r["week_num"]) for r in hs.in_publication_order(df).collect()]
    assert found[:4] == [("a", "wk15"), ("a", "wk14"), ("m", "wk13"), ("m", "wk40")]
    assert set(found[4:]) == {("m", "wk9"), ("m", None)}


def test_samples_repeat_and_differ_by_seed(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    def draw(seed):
        return [r["k"] for r in hs.sample_without_replacement(df, 10, seed, ["k"]).collect()]
    assert draw("a") == draw("a") != draw("b")
    assert len(set(draw("a"))) == 10
    drawn = hs.sample_with_replacement(df, "k", ["x", "y"], "s", "pick")
    assert {r["pick"] for r in drawn.collect()} == {"x", "y"}


def line(table, week, geography, number, variable, *values):
    cells = [str(v) if v is not None else None for v in values]
    cells += [None] * (cb.BENCHMARK_MAX_COLUMNS - len(cells))
    return (table, week, geography, number, len(values), variable, *cells)


@pytest.fixture
def ratios(spark):
    black = "Black alone, not Hispanic"
    lines = [
        line("food2", 30, "AL", 1, "Total", 100, 1, 1, 1, 1, 1),
        line("food2", 30, "AL", 2, "Hispanic origin and Race", None),
        line("food2", 30, "AL", 3, cb.HISPANIC_LABEL, 10, 5, 1, "2", "1", "-"),
        line("food2", 30, "AL", 4, black, 100, 50, 10, 20, 10, 10),
        line("housing1b", 39, "Boston_Metro_Area", 8, "Hispanic header", None),
        line("housing1b", 39, "Boston_Metro_Area", 9, black, 100, 20, 40, 30, 10, 0),
        line("housing1b", 40, "Boston_Metro_Area", 8, "Hispanic header", None),
        line("housing1b", 40, "Boston_Metro_Area", 9, black, 100, 40, 30, 10, 20, 0),
        line("housing2a", 40, "US", 8, "Hispanic header", None),
        line("housing2a", 40, "US", 9, black, 100, 10, 20, 10, 5, 5, 5, 45, 7, 0),
        line("employ1", 34, "US", 8, "Hispanic header", None),
        line("employ1", 34, "US", 9, black, 100, 20, 60, 20),
        line("health3", 34, "US", 8, "Hispanic header", None),
        line("health3", 34, "US", 9, black, 80, 1, 20, 20, 0),
        line("transport1", 20, "US", 8, "Hispanic header", None),
        line("transport1", 20, "US", 9, black, 5, 0, 0, 0, 5),
    ]
    df = spark.createDataFrame(lines, microdata.benchmark_schema())
    return bm.benchmark_ratios(df, literals.benchmark_metro_names(spark))


def test_published_shares_by_layout(ratios):
    found = {(r["table_name"], r["week"], r["geography"], r["race_var"], r["metric"]): r["share"] for r in ratios.collect()}
    boston = "Boston-Cambridge-Newton, MA-NH"
    assert found["food2", 30, "AL", "hispanic", "food_insufficient"] == pytest.approx(0.3)
    assert found["food2", 30, "AL", "black", "food_insufficient"] == pytest.approx(30 / 90)
    assert found["food2", 30, "AL", "black", "food_answered"] == pytest.approx(0.9)
    assert found["housing1b", 39, boston, "black", "rent_caughtup"] == pytest.approx(40 / 70)
    assert found["housing1b", 40, boston, "black", "rent_caughtup"] == pytest.approx(40 / 70)
    assert found["housing2a", 40, "US", "black", "mortgage_not_conf"] == pytest.approx(35 / 45)
    assert found["employ1", 34, "US", "black", "inc_loss"] == pytest.approx(20 / 80)
    assert found["health3", 34, "US", "black", "uninsured"] == pytest.approx(0.2)
    assert found["transport1", 20, "US", "black", "telework"] is None
    assert len(found) == 11


def test_lines_without_a_layout_end_the_job(spark):
    def line(table, week, n_cols, no):
        return (table, week, "US", no, n_cols, "Hispanic or Latino (may be of any race)", *["1"] * cb.BENCHMARK_MAX_COLUMNS)

    lines = [line("food2", 30, 7, 1), line("food2", 30, 7, 2), line("food2", 49, 7, 1), line("food2", 49, 7, 2),
             line("housing2a", 30, 3, 1), line("housing2a", 30, 3, 2)]
    table = spark.createDataFrame(lines, microdata.benchmark_schema())
    odd = {(r["table_name"], r["week"]) for r in bm.unknown_lines(table).collect()}
    assert ("food2", 49) in odd and ("housing2a", 30) in odd and ("food2", 30) not in odd
    names = spark.createDataFrame([], "msa_name string, data_table_msa_name string")
    with pytest.raises(Exception, match="no layout is known for table"):
        bm.benchmark_ratios(table.where("week = 49"), names).collect()


def test_comparison_flags_what_is_out_of_tolerance(spark, ratios):
    estimates = spark.createDataFrame(
        [("AL", "food_insufficient", "wk30", "black", 0.3360), ("AL", "food_insufficient", "wk30", "hispanic", 0.3060),
         ("US", "telework", "wk20", "black", 0.1), ("US", "inc_loss", "wk34", "black", None),
         ("US", "uninsured", "wk34", "black", 0.9)],
        "geography string, metric string, week_num string, race_var string, mean double")
    compared = qc.compare_with_benchmark(estimates, bm.benchmark_shares(ratios))
    assert {r["race_var"]: r["within"] for r in compared.collect()} == {"black": True, "hispanic": False}
    with pytest.raises(ValueError):
        qc.assert_within(compared)
    qc.assert_within(compared.where("race_var = 'black'"))
