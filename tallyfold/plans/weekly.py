"""The weekly run from landed files to published tables.

Each step writes a table by week and the next reads it back, so no step is computed twice, a lost executor costs one
stage, and a rerun of a week replaces that week only. What a run keeps below its folder:

``landed_answers``, ``landed_weights``: harmonised lines of the files, partitioned by week and bucketed by respondent
``rejected``: lines that were set aside; ``microdata``; the reports; ``cube``: sums of the finest domains
``contrasts``: estimates with the contrasts behind their flags; ``estimates_feature``, ``estimates``: what is published
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions.replicates import SurveyDesign
from tallyfold.operators import benchmark as bm
from tallyfold.operators import history as hs
from tallyfold.operators.cube import cell_cube
from tallyfold.operators.joins import assert_rows_kept
from tallyfold.plans import estimates as es
from tallyfold.plans import qc
from tallyfold.plans import response as rp
from tallyfold.plans.clean import clean_microdata, split_income_question
from tallyfold.sources import literals, sheets, sinks
from tallyfold.sources import microdata as md

#: Buckets of the landed tables: about one for every 256 MB that a run lands, and the same from run to run.
BUCKETS = 64


@dataclass(frozen=True)
class Landing:
    """Landed files: path templates with {year} and {week}, and two dimension files.

    ``metro_titles`` is the number of title lines above the header line of the metro list, as its publisher exports it;
    without it the file has the dimension's own columns.
    """

    answers: str
    weights: str
    states: str
    metros: str
    metro_titles: int | None = None


RESPONSE_REPORTS = {
    "response_rates": rp.response_rate_with_total,
    "response_outcome": rp.outcome_by_answered,
    "response_mix": rp.race_mix_of_answerers,
}
MISSING_REPORTS = ("missing_shares", "missing_counts", "missing_drift")
ESTIMATE_KEYS = ("geography", "metric", "week_num", "race_var", "geo_type")


def _metros(spark: SparkSession, landing: Landing) -> DataFrame:
    if landing.metro_titles is None:
        return md.read_dimension(spark, landing.metros, md.METRO_SCHEMA)
    return sheets.read_titled_dimension(spark, landing.metros, sheets.METRO_COLUMNS, landing.metro_titles)


def land_weeks(spark: SparkSession, landing: Landing, weeks: Iterable[int], out: str, reject: bool = False, buckets: int = BUCKETS) -> None:
    """Files -> landed tables. A bad line ends the job; with ``reject`` it goes to a table of its own instead."""
    weeks = sorted(set(weeks))
    scans = {"answers": md.scan_answers(spark, landing.answers, weeks), "weights": md.scan_weights(spark, landing.weights, weeks)}
    for kind, scan in scans.items():
        sinks.keep_by_respondent(md.good_rows(scan, strict=not reject), f"{out}/landed_{kind}", buckets)
    if reject:
        bad = [md.rejected_rows(scan).withColumn("kind", F.lit(kind)) for kind, scan in scans.items()]
        run = F.lit("_".join(f"wk{w}" for w in weeks)).alias("run")
        sinks.overwrite_periods(reduce(DataFrame.unionByName, bad).select("*", run), f"{out}/rejected", "run")


def _landed(spark: SparkSession, out: str, kind: str, weeks: Sequence[int], buckets: int) -> DataFrame:
    schema = spark.read.parquet(f"{out}/landed_{kind}").schema
    return sinks.by_respondent(spark, f"{out}/landed_{kind}", schema, buckets).where(F.col("week").isin(list(weeks)))


#: Lets buckets of the respondent alone serve a join on week and respondent.
BUCKETED_JOIN = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}


def clean_landed(spark: SparkSession, landing: Landing, weeks: Iterable[int], out: str, verify: bool = True, buckets: int = BUCKETS) -> None:
    """Landed tables -> cleaned microdata by week, and the reports.

    The rows before and after the joins are counted by the job that writes them. Only counts that differ, as those of
    a job with lost executors may, are taken again from the tables, and raise if they still do.
    """
    weeks = sorted(set(weeks))
    before, after = Observation("before"), Observation("after")
    count = F.count(F.lit(1)).alias("n")
    with sinks.settings(spark, **BUCKETED_JOIN):
        answers = _landed(spark, out, "answers", weeks, buckets)
        clean = clean_microdata(answers.observe(before, count), md.read_dimension(spark, landing.states, md.STATE_SCHEMA),
                                _metros(spark, landing), _landed(spark, out, "weights", weeks, buckets))
        sinks.overwrite_periods(split_income_question(clean).observe(after, count), f"{out}/microdata", "week")
    stored = spark.read.parquet(f"{out}/microdata").where(F.col("week").isin(weeks))
    if verify and before.get["n"] != after.get["n"]:
        assert_rows_kept(answers.select("scram"), stored.select("scram"))
    # the reports look at the income question before it is split
    flags = rp.answered_flags(stored.withColumn("inc_loss", F.coalesce("inc_loss", "inc_loss_rv")))
    for name, report in RESPONSE_REPORTS.items():
        sinks.overwrite_periods(report(flags), f"{out}/{name}")
    missing_reports(spark, out, weeks)


def missing_reports(spark: SparkSession, out: str, weeks: Sequence[int]) -> None:
    """Share of nulls of every numeric column by week, columns that are null throughout, and how they differ from the week before."""
    stored = spark.read.parquet(f"{out}/microdata").where(F.col("week").isin(list(weeks)))
    sinks.overwrite_periods(rp.missing_share(stored.drop("week")), f"{out}/missing_shares")
    shares = spark.read.parquet(f"{out}/missing_shares")
    sinks.overwrite_periods(rp.all_missing_count(shares.where(F.col("week_num").isin([f"wk{w}" for w in weeks]))), f"{out}/missing_counts")
    sinks.overwrite_periods(rp.drift_report(shares, weeks), f"{out}/missing_drift")


def clean_weeks(spark: SparkSession, landing: Landing, weeks: Iterable[int], out: str, verify: bool = True, reject: bool = False,
                buckets: int = BUCKETS) -> None:
    """Land -> cleaned microdata by week, and the reports. ``clean_landed`` alone repeats the second half."""
    weeks = sorted(set(weeks))
    land_weeks(spark, landing, weeks, out, reject, buckets)
    clean_landed(spark, landing, weeks, out, verify, buckets)


def estimate_weeks(spark: SparkSession, out: str, design: SurveyDesign, count: int = 2,
                   options: es.EstimateOptions = es.EstimateOptions(), verify: bool = True) -> None:
    """The cube of the latest weeks, and from it their estimates into the two histories: with one income metric, and with two."""
    microdata = spark.read.parquet(f"{out}/microdata")
    last = microdata.agg(F.max("week")).first()[0]
    latest = es.estimation_input(microdata.where(F.col("week") > last - count))
    sinks.overwrite_periods(cell_cube(latest, design, options.metrics, es.CELL_KEYS), f"{out}/cube")
    publish_weeks(spark, out, design, [f"wk{w}" for w in range(last - count + 1, last + 1)], options, verify)


def publish_weeks(spark: SparkSession, out: str, design: SurveyDesign, weeks: Sequence[str],
                  options: es.EstimateOptions = es.EstimateOptions(), verify: bool = True) -> None:
    """Estimates of weeks whose cube is kept; reads no microdata.

    There are rows for every area that the cube has in any week. Their number is observed by the job that writes them;
    one that differs from the complete grid's is counted again, and raises if it still does.
    """
    options = replace(options, weeks=list(weeks))
    cube = spark.read.parquet(f"{out}/cube")
    places = es.areas(cube)
    found = Observation("rows")
    contrasts = es.estimate_from_cube(cube.where(F.col("week_num").isin(*weeks)), design, options, places)
    sinks.overwrite_periods(contrasts, f"{out}/contrasts")
    stored = spark.read.parquet(f"{out}/contrasts").where(F.col("week_num").isin(*weeks))
    feature = es.join_week_dates(es.publish_columns(stored), literals.week_dates(spark))
    in_area = F.count(F.when(F.col("geo_type") != es.NATIONAL, 1)).alias("n")
    sinks.overwrite_periods(sinks.with_notes(feature, md.estimate_schema()).observe(found, in_area), f"{out}/estimates_feature")
    feature = spark.read.parquet(f"{out}/estimates_feature").where(F.col("week_num").isin(*weeks))
    if verify and found.get["n"] != places.count() * len(options.metrics) * (len(options.groups) + 1) * len(weeks):
        es.assert_complete(feature, places, weeks, options.metrics)
    sinks.overwrite_periods(sinks.with_notes(es.relabel_split_metric(feature), md.estimate_schema(full=True)), f"{out}/estimates")


def load_history(spark: SparkSession, out: str, feature: str, full: str) -> None:
    """Published histories into the two tables. What a table or an earlier line of a file has stays; loading again changes nothing.

    An older file without the flag of removed metrics gets it from the list of these.
    """
    flag = F.when(F.col("metric").isin(*cb.FLAGGED_REMOVED_METRICS), 1.0).otherwise(0.0)
    for name, path, is_full in (("estimates_feature", feature, False), ("estimates", full, True)):
        schema = md.estimate_schema(is_full)
        rows = md.read_history(spark, path, schema, ESTIMATE_KEYS)
        if is_full:
            rows = rows.withColumn("var_removed", F.coalesce("var_removed", flag))
        sinks.append_missing(sinks.with_notes(rows, schema), f"{out}/{name}", ESTIMATE_KEYS)


def _latest(spark: SparkSession, df: DataFrame, count: int) -> Column:
    weeks = sorted((r["week_num"] for r in df.select("week_num").distinct().collect()), key=lambda w: int(w[2:]))
    return F.col("week_num").isin(weeks[-count:])


def outputs(spark: SparkSession, out: str, count: int = 2) -> Mapping[str, DataFrame]:
    """What gets published, by name: all weeks, and the estimates of the latest ``count`` weeks alone."""
    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}")

    estimates, feature = stored("estimates"), stored("estimates_feature")
    latest = _latest(spark, feature, count)
    return {
        "microdata": stored("microdata"),
        "estimates": hs.in_publication_order(estimates),
        "estimates_feature": hs.in_publication_order(feature),
        "estimates_run": hs.in_publication_order(estimates.where(latest)),
        "estimates_feature_run": hs.in_publication_order(feature.where(latest)),
        **{name: stored(name) for name in (*RESPONSE_REPORTS, *MISSING_REPORTS)},
        "indicator_dictionary": literals.indicator_dictionary(spark),
        "response_dictionary": literals.response_dictionary(spark),
        "estimate_dictionary": literals.estimate_dictionary(spark),
        "metro_short_names": literals.metro_short_names(spark),
    }


def publish(spark: SparkSession, out: str, target: str) -> list[str]:
    return sinks.publish(outputs(spark, out), target)


def check_published(spark: SparkSession, out: str, tables: str) -> DataFrame:
    """Rows of the estimates that differ from the published tables, a long file or a folder of sheet exports; empty when all is well."""
    lines = md.read_benchmark(spark, tables) if tables.endswith(".csv") else sheets.read_table_sheets(spark, tables)
    shares = bm.benchmark_shares(bm.benchmark_ratios(lines, literals.benchmark_metro_names(spark)))
    return qc.failing(qc.compare_with_benchmark(spark.read.parquet(f"{out}/estimates_feature"), shares))


def check_errors(spark: SparkSession, out: str, design: SurveyDesign, seed: str, count: int = 2,
                 options: es.EstimateOptions = es.EstimateOptions()) -> DataFrame:
    """Drawn cells of the latest weeks, derived again from their respondents: by regression and by the plain formula.

    A row for each drawn cell that has both sides and each check, with ``agree``. Only respondents of drawn weeks and areas are read into the sums.
    """
    microdata = spark.read.parquet(f"{out}/microdata")
    last = microdata.agg(F.max("week")).first()[0]
    weeks = [f"wk{w}" for w in range(last - count + 1, last + 1)]
    contrasts = spark.read.parquet(f"{out}/contrasts").where(F.col("week_num").isin(*weeks))
    rows = es.estimation_input(microdata.where(F.col("week") > last - count))
    drawn = qc.draw_cells(es.areas(rows), weeks, seed, metrics=options.metrics, groups=options.groups).unionByName(
        qc.draw_national(spark, weeks, seed, metrics=options.metrics, groups=options.groups))
    sides = qc.drawn_sides(rows, design, drawn, options.metrics)
    checks = {"regression": qc.regression_check(sides, contrasts, design),
              "formula": qc.manual_check(qc.manual_contrasts(sides, design), contrasts)}
    parts = [df.select(F.lit(name).alias("check_name"), *qc.SIDE_KEYS, "diff_mean", "diff_se", "agree") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def assert_errors(checked: DataFrame) -> None:
    bad = checked.where(~F.coalesce(F.col("agree"), F.lit(False))).limit(5).collect()
    if bad:
        raise ValueError(f"estimates differ from what their respondents give, for example {bad}")
