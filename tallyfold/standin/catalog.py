"""Registered queries: every operator on the whole stand-in tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions import recode as rc
from tallyfold.functions.replicates import base, confidence, tidy
from tallyfold.operators import benchmark as bm
from tallyfold.operators import history as hs
from tallyfold.operators import joins as jn
from tallyfold.operators import reshape as rh
from tallyfold.operators.columns import across, snake
from tallyfold.operators.contrast import STATS, domain_means, estimates_of, weighted_means
from tallyfold.operators.cube import cell_cube
from tallyfold.operators.harmonise import phases_of, stack_periods
from tallyfold.plans import estimates as es
from tallyfold.plans import qc
from tallyfold.plans import response as rp
from tallyfold.plans.clean import split_income_question
from tallyfold.sources import literals, scratch, sheets
from tallyfold.standin import respondents as rs
from tallyfold.standin import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PUBLISHED = ("mean", "se", "moe_95", "moe_95_lb", "moe_95_ub")
SPEND = [f"spndsrc{n}" for n in range(1, 13)]
WEEKS = range(rs.FIRST_WEEK, rs.LAST_WEEK + 1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: tidy(F.col(n)) for n in names})


def _one_row_per_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    phases = dict((tuple(ws), p) for p, ws in phases_of(WEEKS))
    return stack_periods(WEEKS, lambda ws: rs.raw_layout(spark, sf_dir, phases[tuple(ws)], ws))


# scans and schema ----------------------------------------------------------

@query
def scan_multi_period(spark, d):
    df = _one_row_per_layout(spark, d)
    return df.groupBy("week").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("wrkloss").alias("n_wrkloss"),
        F.count("expctloss").alias("n_expctloss"), F.count("spndsrc12").alias("n_spndsrc12"),
    )


@query
def harmonise_phases(spark, d):
    return _one_row_per_layout(spark, d).select(*[c for c in rs.BASE if c != "pweight"], *rs.QUESTIONS)


@query
def latest_two_weeks(spark, d):
    return es.latest_weeks(rs.answers(spark, d).select("scram", "week", "wrkloss", "pweight"))


# joins ---------------------------------------------------------------------

@query
def join_state_dim(spark, d):
    df = rs.answers(spark, d).select("scram", "week", "est_st")
    return jn.join_dimension(df, rs.states(spark, d), "est_st", "state_code", ["state"])


@query
def join_msa_dim(spark, d):
    df = rs.answers(spark, d).select("scram", "week", "est_msa")
    return jn.join_dimension(df, rs.metros(spark, d), "est_msa", "cbsa_code", ["cbsa_title"])


@query
def join_replicate_weights(spark, d):
    df = rs.answers(spark, d).select("scram", "week", "wrkloss", "pweight")
    return jn.join_weights(df, rs.weight_table(spark, d))


@query
def join_week_dates(spark, d):
    df = rs.answers(spark, d).select("scram", rc.week_label().alias("week_num"))
    return es.join_week_dates(df, literals.week_dates(spark))


@query
def join_fanout_check(spark, d):
    return jn.fan_out(spark.read.parquet(f"{d}/customer.parquet"), "c_nationkey")


@query
def join_row_balance(spark, d):
    df = rs.answers(spark, d).select("scram", "week", "est_st")
    joined = jn.join_dimension(df, rs.states(spark, d), "est_st", "state_code", ["state"])
    return jn.row_balance(df, joined)


@query
def dedupe_keep_first(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet")
    return jn.keep_first(customers.select("c_nationkey", "c_mktsegment", "c_custkey"),
                         ["c_nationkey", "c_mktsegment"], ["c_custkey"])


@query
def estimate_grid(spark, d):
    places = rh.stack_geographies(rs.microdata(spark, d)).select("week_num", "geo_type", "geography").distinct()
    return rh.estimate_grid(places)


# recodes -------------------------------------------------------------------

def _indicators(spark, d, *names):
    return rs.indicators(spark, d).select("scram", "week_num", *names)


@query
def recode_codes(spark, d):
    return _indicators(spark, d, "inc_loss", "expect_inc_loss", "payment_not_conf", "food_insufficient", "expense_dif",
                       "telework", "mentalhealth_unmet", "eviction_risk", "foreclosure_risk", "learning_fewer")


@query
def derive_group(spark, d):
    return _indicators(spark, d, "hisp_rrace")


@query
def recode_any_all(spark, d):
    return _indicators(spark, d, "uninsured", "insured_public")


@query
def recode_conditional(spark, d):
    return _indicators(spark, d, "rent_not_conf", "mortgage_not_conf", "rent_caughtup", "mortgage_caughtup")


@query
def recode_multi_response(spark, d):
    return _indicators(spark, d, "spend_credit", "spend_savings", "spend_ui", "spend_stimulus", "spend_snap")


@query
def score_threshold(spark, d):
    return _indicators(spark, d, "anxious_score", "worry_score", "interest_score", "down_score", "anxiety_signs",
                       "depression_signs", "depression_anxiety_signs")


@query
def answered_flags(spark, d):
    flags = rp.answered_flags(rs.indicators(spark, d))
    return flags.select("scram", "week_num", *[c for c in flags.columns if c.startswith("answered_")])


@query
def split_metric_by_period(spark, d):
    return split_income_question(rs.indicators(spark, d)).select("scram", "week_num", "inc_loss", "inc_loss_rv")


@query
def denominator_cut(spark, d):
    df = rs.indicators(spark, d)
    return df.select("scram", "tbirth_year", rc.age_cut("uninsured").alias("uninsured"),
                     rc.age_cut("insured_public").alias("insured_public"))


@query
def group_dummies(spark, d):
    df = rs.indicators(spark, d)
    return df.select("scram", "hisp_rrace", *[c.alias(g) for g, c in rc.group_dummies().items()])


@query
def regex_extract_label(spark, d):
    names = rs.answers(spark, d).select(
        "scram", F.concat(F.lit("tables/food_"), rc.week_label(), F.lit(".xlsx")).alias("file_name")
    )
    return names.withColumn("week_num", rc.week_from_name("file_name"))


@query
def week_labels(spark, d):
    return rs.answers(spark, d).select(
        "scram", rc.week_label().alias("week_num"), rc.padded_week().alias("padded"),
        rc.year_of_week("week").alias("file_year"),
        rc.year_of_week("week", cb.BENCHMARK_YEAR_STARTS).alias("table_year"),
    )


@query
def one_hot(spark, d):
    df = rs.microdata(spark, d)
    flags = rc.one_hot("cbsa_title", rs.REGION_METROS)
    return df.select("scram", "cbsa_title", *[c.alias(snake(n)) for n, c in flags.items()])


@query
def stack_geographies(spark, d):
    return rh.stack_geographies(rs.microdata(spark, d)).select("scram", "week_num", "geo_type", "geography")


# reshape and response ------------------------------------------------------

@query
def unpivot_metrics(spark, d):
    return rh.unpivot_metrics(rs.indicators(spark, d), ["scram", "week_num"], cb.METRICS)


@query
def pivot_metrics(spark, d):
    means = domain_means(rs.indicators(spark, d), "pweight", list(cb.METRICS), ["week_num", "hisp_rrace"])
    return rounded(rh.pivot_metrics(means, ["week_num", "hisp_rrace"], "metric", "mean", cb.METRICS), *cb.METRICS)


def _flags(spark, d):
    return rp.answered_flags(rs.indicators(spark, d))


def _rates(df):
    return rounded(df, *[c for c in df.columns if c.startswith("answered_")])


@query
def response_rate_by_group(spark, d):
    return _rates(rp.response_rate_by_group(_flags(spark, d)))


@query
def response_rate_with_total(spark, d):
    return _rates(rp.response_rate_with_total(_flags(spark, d)))


@query
def race_mix_of_answerers(spark, d):
    return _rates(rp.race_mix_of_answerers(_flags(spark, d)))


@query
def outcome_by_answered(spark, d):
    return _rates(rp.outcome_by_answered(_flags(spark, d)))


def _shares(spark, d):
    df = rs.answers(spark, d).withColumn("week_num", rc.week_label())
    return rp.missing_share(df.drop("scram", "week"))


@query
def missing_share(spark, d):
    df = _shares(spark, d)
    return rounded(df, *[c for c in df.columns if c != "week_num"])


@query
def all_missing_count(spark, d):
    return rp.all_missing_count(_shares(spark, d))


@query
def missing_drift(spark, d):
    return rp.missing_drift(_shares(spark, d), "wk33", "wk34")


@query
def drift_report(spark, d):
    """What the layouts of weeks 43 and 46 changed."""
    return rounded(rp.drift_report(_shares(spark, d), (43, 46)), "share_before", "share")


# history -------------------------------------------------------------------

def _weekly(spark, d):
    means = domain_means(rs.indicators(spark, d), "pweight", list(cb.METRICS), ["week", "week_num", "hisp_rrace"])
    return rounded(means, "mean")


@query
def union_fill(spark, d):
    weekly = _weekly(spark, d)
    old = weekly.where("week < 28").drop("n", "week")
    return hs.union_fill(old, weekly.where("week >= 28").drop("week"))


@query
def append_idempotent(spark, d):
    # history and run are parts of one table, which is summed once
    weekly = scratch.handed_over(_weekly(spark, d))
    week = rs.answers(spark, d).select("week")
    last = week.select(F.max("week")).scalar()
    run = weekly.where(F.col("week") > last - 2).drop("week")
    periods = week.select(F.array(*[F.concat(F.lit("wk"), F.max("week") - k) for k in (0, 1)])).scalar()
    history = weekly.drop("week").withColumn("mean", F.lit(-1.0))
    once = hs.append_idempotent(history, run, periods=periods)
    return hs.append_idempotent(once, run, periods=periods)


@query
def publication_order(spark, d):
    weekly = _weekly(spark, d).select(
        "metric", "week_num", rc.group_name().alias("race_var"), F.lit("US").alias("geography"), "mean"
    )
    return hs.publication_rank(weekly).withColumn("week_rank", hs.week_rank())


@query
def seeded_sample(spark, d):
    places = rh.stack_geographies(rs.microdata(spark, d)).select("geo_type", "geography").distinct()
    chosen = hs.sample_without_replacement(places, 10, "qc", ["geo_type", "geography"])
    drawn = hs.sample_with_replacement(chosen, "geography", cb.METRICS, "metric", "metric")
    return hs.sample_with_replacement(drawn, "geography", cb.GROUPS, "group", "race_var")


# estimates -----------------------------------------------------------------

@query
def weighted_mean(spark, d):
    df = rs.survey(spark, d)
    return rounded(domain_means(df, "pweight", list(cb.METRICS), ["week_num", "state", "race"]), "mean")


@query
def replicate_means(spark, d):
    cube = cell_cube(rs.survey(spark, d), rs.DESIGN, cb.METRICS, ["week_num"])
    rows = cube.select("week_num", "metric", F.posexplode(estimates_of()).alias("replicate", "mean"))
    return rounded(rows, "mean")


@query
def replicate_se(spark, d):
    cube = cell_cube(rs.survey(spark, d), rs.DESIGN, cb.METRICS, ["week_num", "race"])
    return rounded(weighted_means(cube, rs.DESIGN).select("week_num", "race", "metric", "n", "mean", "se"),
                   "mean", "se")


def _estimate(spark, d, *families, **options):
    return es.estimate(rs.survey(spark, d), rs.DESIGN, es.EstimateOptions(families=families, **options))


def _published(estimates):
    return rounded(es.publish_columns(estimates), *PUBLISHED)


@query
def contrast_group_vs_rest(spark, d):
    return rounded(_estimate(spark, d, es.US_GROUP), *STATS)


@query
def contrast_empty_domain(spark, d):
    return rounded(_estimate(spark, d, es.GEO_GROUP).where("mean is null"), *STATS)


@query
def estimate_geo_by_group(spark, d):
    return rounded(_estimate(spark, d, es.GEO_GROUP), *STATS)


@query
def estimate_geo_total(spark, d):
    return rounded(_estimate(spark, d, es.GEO_TOTAL), *STATS)


@query
def estimate_geo_total_all_others(spark, d):
    return rounded(_estimate(spark, d, es.GEO_TOTAL, null_geo_in_rest=True), *STATS)


@query
def estimate_national_by_group(spark, d):
    return _published(_estimate(spark, d, es.US_GROUP))


@query
def estimate_national_total(spark, d):
    df = _estimate(spark, d, es.US_TOTAL, removed=()).where(~F.col("metric").isin(*cb.REMOVED_TOTAL_METRICS))
    return rounded(df.select("week_num", "geography", "race_var", "mean", "se", "metric"), "mean", "se")


@query
def confidence_interval(spark, d):
    cube = cell_cube(rs.survey(spark, d), rs.DESIGN, cb.METRICS, ["week_num", "state"])
    means = weighted_means(cube, rs.DESIGN)
    bounds = means.select("week_num", "state", "metric", "mean", "se",
                          *[c.alias(k) for k, c in confidence(F.col("mean"), F.col("se")).items()])
    return rounded(bounds, *PUBLISHED)


@query
def significance_flag(spark, d):
    return es.publish_columns(_estimate(spark, d, es.GEO_TOTAL, es.US_GROUP)).select(
        "geo_type", "geography", "metric", "week_num", "race_var", "sigdiff"
    )


@query
def cube_roll_up(spark, d):
    """Estimates from the cube of the finest domains as a run keeps it, without the respondents."""
    cube = scratch.handed_over(cell_cube(rs.survey(spark, d), rs.DESIGN, cb.METRICS, es.CELL_KEYS))
    options = es.EstimateOptions(families=(es.GEO_TOTAL, es.US_GROUP))
    return rounded(es.estimate_from_cube(cube, rs.DESIGN, options), *STATS)


@query
def removed_metric_rows(spark, d):
    return es.removed_metric_rows(rs.answers(spark, d).select(rc.week_label().alias("week_num")).distinct())


def _feature(spark, d):
    return es.feature_output(rs.survey(spark, d), rs.DESIGN, literals.week_dates(spark))


@query
def assemble_estimates(spark, d):
    return rounded(_feature(spark, d), *PUBLISHED)


@query
def relabel_split_metric(spark, d):
    feature = es.join_week_dates(
        es.publish_columns(_estimate(spark, d, es.US_GROUP, es.US_TOTAL)), literals.week_dates(spark)
    )
    return rounded(es.relabel_split_metric(feature), *PUBLISHED)


@query
def expected_grid_count(spark, d):
    weeks = [f"wk{w}" for w in WEEKS]
    places = rs.states(spark, d).select(F.lit("state").alias("geo_type"), F.col("state").alias("geography")).union(
        rs.metros(spark, d).select(F.lit("msa"), "cbsa_title"))
    options = es.EstimateOptions(families=(es.GEO_GROUP, es.GEO_TOTAL), weeks=weeks)
    return es.expected_grid_count(es.estimate(rs.survey(spark, d), rs.DESIGN, options, places), places, weeks)


# checks --------------------------------------------------------------------

@query
def benchmark_race_rows(spark, d):
    return bm.race_rows(tb.benchmark_lines(spark, d)).select(
        "table_name", "week", "geography", "line_no", "variable",
        *[tidy(F.col(c).try_cast("double"), 2).alias(c) for c in bm.VALUES],
    )


@query
def scan_sheets(spark, d):
    """The tables landed as one CSV file a sheet, with title and blank lines, and read back by position."""
    folder = scratch.new_path(spark)
    tb.land_sheets(tb.benchmark_lines(spark, d), folder)
    return bm.race_rows(sheets.read_table_sheets(spark, folder)).select(
        "table_name", "week", "geography", "line_no", "n_cols", "variable",
        *[tidy(F.col(c).try_cast("double"), 2).alias(c) for c in bm.VALUES],
    )


def _ratios(spark, d):
    return bm.benchmark_ratios(tb.benchmark_lines(spark, d), literals.benchmark_metro_names(spark))


@query
def benchmark_ratios(spark, d):
    return _ratios(spark, d).select(
        "table_name", "week_num", "geography", "race_var", "metric",
        tidy(F.col("numerator"), 2).alias("numerator"), tidy(F.col("denominator"), 2).alias("denominator"),
        tidy(F.col("share")).alias("share"),
    )


def _compared(spark, d):
    estimates = es.publish_columns(_estimate(spark, d, es.GEO_GROUP, es.US_GROUP, metrics=tuple(cb.COMPARED_METRICS)))
    return qc.compare_with_benchmark(estimates, bm.benchmark_shares(_ratios(spark, d)))


@query
def qc_benchmark_compare(spark, d):
    return _compared(spark, d)


@query
def qc_tolerance(spark, d):
    return qc.failing(_compared(spark, d))


def _sides_and_estimates(spark, d, *areas):
    """Sums from the respondents, and the estimates to be checked, which come from the cube."""
    df = rs.survey(spark, d)
    families = [es.US_GROUP if a == es.NATIONAL else es.GEO_GROUP for a in areas]
    options = es.EstimateOptions(families=tuple(dict.fromkeys(families)))
    return qc.respondent_sides(df, rs.DESIGN, areas), es.estimate(df, rs.DESIGN, options)


@query
def qc_weighted_regression(spark, d):
    sides, estimates = _sides_and_estimates(spark, d, "state", "msa")
    df = qc.regression_check(sides, estimates, rs.DESIGN)
    return rounded(df, "slope", "slope_se", "diff_mean", "diff_se")


MANUAL = ("group_rest", "group_rest_se", "diff_mean", "diff_se")


@query
def qc_manual_se(spark, d):
    sides, estimates = _sides_and_estimates(spark, d, es.NATIONAL)
    df = qc.manual_check(qc.manual_contrasts(sides, rs.DESIGN), estimates)
    return rounded(df.select(*qc.SIDE_KEYS, *MANUAL, "agree"), *MANUAL)


@query
def qc_manual_geo(spark, d):
    sides, estimates = _sides_and_estimates(spark, d, "state", "msa")
    df = qc.manual_check(qc.manual_contrasts(sides, rs.DESIGN), estimates)
    # a t value is the ratio of two rounded numbers here, so that engines agree on it
    t = F.try_divide(tidy(F.col("total_group")), tidy(F.col("total_group_se")))
    kept = df.select(*qc.SIDE_KEYS, *MANUAL, "agree", F.when(tidy(F.col("total_group_se")) > 1e-3, t).alias("total_group_t"))
    return rounded(kept, *MANUAL).withColumn("total_group_t", F.round("total_group_t", 4) + 0.0)


def _drawn_and_estimates(spark, d):
    """Drawn cells, their sums from the respondents, and the estimates to be checked."""
    df = rs.survey(spark, d)
    weeks = [f"wk{w}" for w in range(rs.LAST_WEEK - 1, rs.LAST_WEEK + 1)]
    drawn = qc.draw_cells(es.areas(df), weeks, "qc").unionByName(qc.draw_national(spark, weeks, "qc"))
    latest = df.where(F.col("week_num").isin(weeks))
    options = es.EstimateOptions(families=(es.GEO_GROUP, es.US_GROUP))
    return qc.drawn_sides(latest, rs.DESIGN, drawn), es.estimate(latest, rs.DESIGN, options)


@query
def qc_sampled_regression(spark, d):
    """Ten drawn areas and ten draws for the nation, as the weekly run checks; the draw is the feature."""
    sides, estimates = _drawn_and_estimates(spark, d)
    return rounded(qc.regression_check(sides, estimates, rs.DESIGN), "slope", "slope_se", "diff_mean", "diff_se")


@query
def qc_sampled_manual(spark, d):
    sides, estimates = _drawn_and_estimates(spark, d)
    df = qc.manual_check(qc.manual_contrasts(sides, rs.DESIGN), estimates)
    return rounded(df.select(*qc.SIDE_KEYS, *MANUAL, "agree"), *MANUAL)


@query
def contrast_group_vs_total(spark, d):
    sides = qc.respondent_sides(rs.survey(spark, d), rs.DESIGN, ("state", "msa", es.NATIONAL))
    df = qc.manual_contrasts(sides, rs.DESIGN)
    return rounded(df.select(*qc.SIDE_KEYS, "total_group", "total_group_se"), "total_group", "total_group_se")
