import pytest
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.plans import estimates as es
from tallyfold.plans import weekly
from tallyfold.sources import microdata as md
from tallyfold.sources import sinks
from tests.people import DESIGN
from tests.test_sources import land

BUCKETS = 4


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Three weeks landed, cleaned and estimated, and then the last two of them again."""
    folder = tmp_path_factory.mktemp("weekly")
    for week in (45, 46, 47):
        land(folder, week, [(f"p{i}", 1 + i % 2) for i in range(12)])
    (folder / "states.csv").write_text("state,state_code,state_name\nAL,01,Alabama\n")
    (folder / "metros.csv").write_text("List 1. Areas\nas of 2020\nCBSA Code,CBSA Title,CSA Title\n10000,m,c\n\nNote: none\n")
    for week, cells in ((47, "10,9,1,0,0,0"), (46, "10,0,0,9,1,0")):
        sheet = folder / "tables" / f"food1_wk{week}.xlsx" / "US.csv"
        sheet.parent.mkdir(parents=True)
        sheet.write_text("t\n\nt\nt\nt\nTotal,10\n\nHispanic origin and Race\n" + f'"White alone, not Hispanic",{cells}\n')
    root, out = str(folder / "{year}"), str(folder / "out")
    landing = weekly.Landing(root + "/answers_{week:02d}.csv", root + "/weights_{week:02d}.csv",
                             str(folder / "states.csv"), str(folder / "metros.csv"), metro_titles=2)
    counts = []
    for weeks in ([45, 46, 47], [46, 47]):
        weekly.clean_weeks(spark, landing, weeks, out, buckets=BUCKETS)
        weekly.estimate_weeks(spark, out, DESIGN)
        counts.append([spark.read.parquet(f"{out}/{t}").count() for t in (
            "landed_answers", "microdata", *weekly.RESPONSE_REPORTS, *weekly.MISSING_REPORTS, "cube", "contrasts", "estimates_feature", "estimates")])
    return folder, landing, out, counts


def test_a_rerun_leaves_the_same_tables(spark, run):
    _, _, out, counts = run
    assert counts[0] == counts[1]
    rows = 2 * 2 * len(cb.METRICS) * 6
    assert counts[0][:2] == [36, 36] and counts[0][-2:] == [rows, rows + 2 * 2 * 6]
    feature = spark.read.parquet(f"{out}/estimates_feature")
    white = feature.where("geography = 'US' and week_num = 'wk47' and race_var = 'white' and metric = 'food_insufficient'").first()
    assert (white["mean"], white["se"], white["date_int"]) == (0.0, 0.0, dict(cb.WEEK_DATES)["wk47"])
    assert feature.schema["sigdiff"].metadata["comment"].startswith("1 if the cell differs")


def test_missing_reports(spark, run):
    _, _, out, _ = run
    drift = {(r["week_num"], r["variable"]): r for r in spark.read.parquet(f"{out}/missing_drift").collect()}
    # what week 46 no longer asks; mortconf and mh_notget fall out
    assert {v for w, v in drift if w == "wk46"} >= {"mortconf", "mh_notget", "mentalhealth_unmet"}
    row = drift["wk46", "mortconf"]
    assert (row["week_before"], row["share_before"], row["share"]) == ("wk45", 0.0, 1.0)
    assert not [v for w, v in drift if w == "wk47"]
    counts = {r["week_num"]: r["n_all_missing"] for r in spark.read.parquet(f"{out}/missing_counts").collect()}
    assert counts["wk46"] == counts["wk47"] > counts["wk45"]


def test_published_tables_are_compared_by_sheet(spark, run):
    folder, _, out, _ = run
    wrong = weekly.check_published(spark, out, str(folder / "tables")).collect()
    assert [(r["week_num"], r["race_var"]) for r in wrong] == [("wk46", "white")]


def test_the_join_with_the_weights_of_a_rerun_shuffles_nothing(spark, run):
    _, _, out, _ = run
    with sinks.settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", **weekly.BUCKETED_JOIN):
        answers, weights = (weekly._landed(spark, out, kind, [46, 47], BUCKETS) for kind in ("answers", "weights"))
        from tallyfold.operators.joins import join_weights

        plan = join_weights(answers, weights)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and f"Bucketed: true" in plan
    assert join_weights(answers, weights).where(F.col("pweight").isNotNull()).count() == 24


def test_counts_come_from_the_job_and_still_raise(spark, run, monkeypatch):
    folder, landing, out, _ = run
    scans = []
    monkeypatch.setattr(weekly, "assert_rows_kept", lambda *a: scans.append(a))
    weekly.clean_landed(spark, landing, [46, 47], out, buckets=BUCKETS)
    assert not scans
    monkeypatch.undo()
    # a join that multiplies rows: the dimension is not unique
    monkeypatch.setattr(weekly, "clean_microdata", lambda answers, states, metros, weights: weekly_clean(answers, states, metros, weights))

    def weekly_clean(answers, states, metros, weights):
        from tallyfold.plans.clean import clean_microdata
        return clean_microdata(answers, states, metros, weights.union(weights))

    with pytest.raises(ValueError, match="changed the row count"):
        weekly.clean_landed(spark, landing, [47], str(out), buckets=BUCKETS)
    monkeypatch.undo()
    weekly.clean_landed(spark, landing, [46, 47], out, buckets=BUCKETS)


def test_an_incomplete_grid_raises(spark, run, monkeypatch):
    _, _, out, _ = run
    whole = es.estimate_from_cube
    monkeypatch.setattr(es, "estimate_from_cube", lambda *a, **k: whole(*a, **k).where("metric <> 'uninsured' or geo_type = 'national'"))
    with pytest.raises(ValueError, match="estimate rows"):
        weekly.publish_weeks(spark, out, DESIGN, ["wk46", "wk47"])
    monkeypatch.undo()
    weekly.publish_weeks(spark, out, DESIGN, ["wk46", "wk47"])


def test_publishing_again_reads_no_microdata(spark, run, tmp_path):
    _, _, out, _ = run
    import shutil

    shutil.copytree(f"{out}/cube", tmp_path / "cube")  # nothing else is there
    weekly.publish_weeks(spark, str(tmp_path), DESIGN, ["wk46", "wk47"])
    for name in ("estimates_feature", "estimates"):
        old, new = (spark.read.parquet(f"{base}/{name}") for base in (out, tmp_path))
        assert new.count() == old.count() and new.exceptAll(old).count() == 0


def test_drawn_cells_agree_and_a_wrong_cube_is_found(spark, run):
    _, _, out, _ = run
    checked = weekly.check_errors(spark, out, DESIGN, "seed")
    rows = checked.collect()
    assert {r["check_name"] for r in rows} == {"regression", "formula"} and all(r["agree"] for r in rows)
    weekly.assert_errors(checked)
    contrasts = spark.read.parquet(f"{out}/contrasts")
    path = out + "_wrong"
    contrasts.withColumn("diff_mean", F.col("diff_mean") + 0.01).write.partitionBy("week_num").parquet(f"{path}/contrasts")
    spark.read.parquet(f"{out}/microdata").write.partitionBy("week").parquet(f"{path}/microdata")
    with pytest.raises(ValueError, match="respondents"):
        weekly.assert_errors(weekly.check_errors(spark, path, DESIGN, "seed"))


def test_a_run_that_fails_leaves_the_published_set(spark, run, tmp_path, monkeypatch):
    _, _, out, _ = run
    target = str(tmp_path / "public")
    first = weekly.publish(spark, out, target)
    assert len(first) == 15
    path = sinks.published_path(spark, target, "estimates")
    assert path in first
    write, done = sinks.write_csv, []

    def failing(df, path, mode="overwrite"):
        if len(done) == 4:
            raise OSError("no room")
        done.append(path)
        write(df, path, mode)

    monkeypatch.setattr(sinks, "write_csv", failing)
    with pytest.raises(OSError):
        weekly.publish(spark, out, target)
    monkeypatch.undo()
    assert len(done) == 4 and sinks.published_path(spark, target, "estimates") == path
    second = weekly.publish(spark, out, target)
    now = sinks.published_path(spark, target, "estimates")
    assert now in second and now != path
    rows = md.read_history(spark, now, md.estimate_schema(full=True))
    assert rows.count() == spark.read.parquet(f"{out}/estimates").count()
    run_rows = md.read_history(spark, sinks.published_path(spark, target, "estimates_run"), md.estimate_schema(full=True))
    assert {r["week_num"] for r in run_rows.select("week_num").distinct().collect()} == {"wk46", "wk47"}
    with pytest.raises(ValueError):
        sinks.published_path(spark, target, "nothing")


def test_bad_lines_of_a_run_are_set_aside(spark, run, tmp_path):
    folder, landing, _, _ = run
    land(tmp_path, 47, [("p1", 1), ("p2", 2)])
    file = tmp_path / "2022" / "answers_47.csv"
    file.write_text(file.read_text() + "p3,47,01\n")
    bad = weekly.Landing(str(tmp_path / "{year}") + "/answers_{week:02d}.csv", str(tmp_path / "{year}") + "/weights_{week:02d}.csv",
                         landing.states, landing.metros, 2)
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="answers_47.csv"):
        weekly.clean_weeks(spark, bad, [47], out, buckets=BUCKETS)
    weekly.clean_weeks(spark, bad, [47], out, reject=True, buckets=BUCKETS)
    (row,) = spark.read.parquet(f"{out}/rejected").collect()
    assert (row["line_no"], row["line"], row["kind"], row["run"]) == (4, "p3,47,01", "answers", "wk47")
    assert spark.read.parquet(f"{out}/microdata").count() == 2


HEADER = "geography,metric,week_num,race_var,mean,se,moe_95,moe_95_lb,moe_95_ub,geo_type,sigdiff,date_int"


def test_an_old_history_is_loaded_once(spark, run, tmp_path):
    _, _, out, _ = run
    import shutil

    here = str(tmp_path / "out")
    shutil.copytree(f"{out}/cube", f"{here}/cube")
    rows = ['US,uninsured,wk13,total,0.1,0.01,0.0196,0.08,0.12,national,NA,a', 'US,uninsured,wk13,total,0.9,0.01,0.0196,0.08,0.12,national,NA,a',
            '"Chicago, IL",telework,wk13,white,NA,0,0,NA,NA,msa,NA,a', 'US,uninsured,wk46,total,0.7,0,0,0,0,national,NA,a']
    (tmp_path / "old.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    old = str(tmp_path / "old.csv")
    weekly.load_history(spark, here, old, old)
    weekly.publish_weeks(spark, here, DESIGN, ["wk46", "wk47"])

    def state():
        return {name: sorted(map(tuple, spark.read.parquet(f"{here}/{name}").collect()), key=str) for name in ("estimates", "estimates_feature")}

    once = state()
    weekly.load_history(spark, here, old, old)
    assert state() == once
    full = {(r["geography"], r["metric"], r["week_num"]): r for r in spark.read.parquet(f"{here}/estimates").where("race_var in ('total', 'white')").collect()}
    assert full["US", "uninsured", "wk13"]["mean"] == 0.1 and full["US", "uninsured", "wk13"]["var_removed"] == 0.0
    assert full["Chicago, IL", "telework", "wk13"]["var_removed"] == 1.0 and full["Chicago, IL", "telework", "wk13"]["mean"] is None
    # the run's week 46 is the run's
    assert full["US", "uninsured", "wk46"]["mean"] != 0.7
