import pytest
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.operators import joins as jn
from tallyfold.operators.harmonise import harmonise, phase_of, phases_of
from tallyfold.plans.clean import clean_microdata
from tallyfold.sources import literals, microdata, sinks
from tests.people import DESIGN, frame, people

COMMON = [c for c in cb.ANSWER_COLUMNS if not c.startswith("spndsrc") and c != "wrkloss"]


def land(folder, week, rows):
    """Write one week's answers under the column names of its layout."""
    phase = phase_of(week)
    old = {new: name for name, new in phase["renames"].items()}
    names = [c for c in ("wrkloss", *COMMON, *[f"spndsrc{n}" for n in range(1, 13)]) if c not in phase["absent"]]
    header = ["SCRAM", "WEEK", "EST_ST", "EST_MSA", "TBIRTH_YEAR", *[old.get(c, c).upper() for c in names]]
    lines = [",".join(header)]
    for i, (scram, code) in enumerate(rows):
        # owners with a mortgage and renters in turn
        given = [2 + i // 2 % 2 if c == "tenure" else code for c in names]
        lines.append(",".join([scram, str(week), "01", "NA", "1980", *map(str, given)]))
    year = microdata.microdata_year(week)
    (folder / str(year)).mkdir(exist_ok=True)
    (folder / str(year) / f"answers_{week:02d}.csv").write_text("\n".join(lines) + "\n")
    weights = ["SCRAM,WEEK," + ",".join(["PWEIGHT", *[f"PWEIGHT{r}" for r in range(1, 5)]])]
    weights += [f"{s},{week},1.5,1,2,1,2" for s, _ in rows]
    (folder / str(year) / f"weights_{week:02d}.csv").write_text("\n".join(weights) + "\n")


@pytest.fixture
def landed(tmp_path):
    for week in (13, 14, 30, 35, 47):
        land(tmp_path, week, [("p1", 1), ("p2", 2)])
    return str(tmp_path / "{year}")


def test_weeks_of_four_layouts_become_one_table(spark, landed):
    weeks = [13, 14, 30, 35, 47]
    answers = microdata.read_answers(spark, landed + "/answers_{week:02d}.csv", weeks)
    rows = {(r["week"], r["scram"]): r for r in answers.collect()}
    assert len(rows) == 10
    assert rows[30, "p2"]["wrkloss"] == rows[47, "p2"]["wrkloss"] == 2.0
    assert rows[13, "p1"]["spndsrc9"] is None and rows[35, "p1"]["spndsrc12"] == 1.0
    assert rows[30, "p1"]["tw_start"] is None and rows[14, "p1"]["tw_start"] == 1.0
    assert rows[47, "p1"]["mortconf"] is None and rows[13, "p1"]["est_msa"] is None


def test_the_same_respondent_key_in_two_weeks_is_two_people(spark, landed):
    weeks = [13, 30]
    answers = microdata.read_answers(spark, landed + "/answers_{week:02d}.csv", weeks)
    weights = microdata.read_weights(spark, landed + "/weights_{week:02d}.csv", weeks)
    states = spark.createDataFrame([("AL", "01", "Alabama"), ("XX", "01", "Double"), ("ZZ", None, "Null")],
                                   microdata.STATE_SCHEMA)
    metros = spark.createDataFrame([("10000", "c", "m"), (None, "n", "n")], microdata.METRO_SCHEMA)
    clean = clean_microdata(answers, states, metros, weights)
    jn.assert_rows_kept(answers, clean)
    rows = clean.collect()
    assert len(rows) == 4
    assert {r["state"] for r in rows} == {"AL"} and {r["cbsa_title"] for r in rows} == {None}
    assert {r["pweight2"] for r in rows} == {2.0}


def test_fan_out_and_lost_rows_are_found(spark):
    dim = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(r) for r in jn.fan_out(dim, "k").collect()] == [("a", 2)]
    with pytest.raises(ValueError):
        jn.assert_rows_kept(dim, dim.where("k = 'a'"))


def test_unknown_weeks_and_layouts_are_refused(spark):
    with pytest.raises(ValueError):
        phases_of([49])
    with pytest.raises(ValueError):
        harmonise(spark.createDataFrame([(1,)], "wrkloss int"), phase_of(30))


def test_week_from_the_file_name(spark, landed):
    path = (landed + "/answers_{week:02d}.csv").format(year=2020, week=14)
    df = microdata.week_from_file(spark.read.options(header="true").csv(path).select("SCRAM"))
    assert {r["week"] for r in df.collect()} == {14}


def test_publish_and_read_back(spark, tmp_path):
    rows = [("US", "m", "wk13", "total", 0.5, 0.1, 0.2, 0.3, 0.7, "national", None, None)]
    df = spark.createDataFrame(rows, microdata.estimate_schema())
    paths = sinks.publish({"estimates": df, "notes": literals.estimate_dictionary(spark),
                           "indicators": literals.indicator_dictionary(spark),
                           "response": literals.response_dictionary(spark),
                           "metros": literals.metro_short_names(spark)}, str(tmp_path))
    assert [tuple(r) for r in microdata.read_history(spark, paths[0], microdata.estimate_schema()).collect()] == rows
    assert literals.metro_short_names(spark).count() == 15 and literals.week_dates(spark).count() == 35


def test_design_is_kept_with_its_data(spark, tmp_path):
    sinks.save_design(frame(spark, people(20)), DESIGN, str(tmp_path))
    df, design = microdata.load_design(spark, str(tmp_path))
    assert design == DESIGN and df.count() == 20


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = frame(spark, people(40))
    sinks.bucket_by_respondent(df.select("week", "scram", "m_plain"), "answers_b", 4)
    sinks.bucket_by_respondent(df.select("week", "scram", *DESIGN.columns), "weights_b", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = jn.join_weights(spark.table("answers_b"), spark.table("weights_b"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.where(F.col("pweight").isNotNull()).count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table answers_b")
        spark.sql("drop table weights_b")


def test_weeks_prune_to_their_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(frame(spark, people(40)), path)
    plan = spark.read.parquet(path).where("week_num = 'wk13'").select("scram")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_num" in plan


def _write(folder, name, header, *rows):
    (folder / name).write_text("\n".join([header, *rows]) + "\n")
    return str(folder / name)


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    one = _write(tmp_path, "weights_46.csv", "SCRAM,WEEK,PWEIGHT,PWEIGHT1,PWEIGHT2", "a,46,1,10,20")
    two = _write(tmp_path, "weights_47.csv", "PWEIGHT2,SCRAM,PWEIGHT,WEEK,PWEIGHT1", "21,b,2,47,11")
    rows = {r["scram"]: r.asDict() for r in microdata.read_weights(spark, str(tmp_path / "weights_{week:02d}.csv"), [46, 47]).collect()}
    assert rows["a"] == {"scram": "a", "week": 46, "pweight": 1.0, "pweight1": 10.0, "pweight2": 20.0}
    assert rows["b"] == {"scram": "b", "week": 47, "pweight": 2.0, "pweight1": 11.0, "pweight2": 21.0}
    assert one != two


def test_extra_and_missing_columns_raise_or_are_null(spark, tmp_path):
    _write(tmp_path, "weights_46.csv", "SCRAM,WEEK,PWEIGHT", "a,46,1")
    _write(tmp_path, "weights_47.csv", "SCRAM,WEEK,NEW,PWEIGHT", "b,47,5,2")
    template = str(tmp_path / "weights_{week:02d}.csv")
    with pytest.raises(ValueError, match="new"):
        microdata.read_weights(spark, template, [46, 47])
    scan = microdata.read_weights(spark, template, (46, 47), allow_extra=True)
    assert {(r["scram"], r["new"], r["pweight"]) for r in scan.collect()} == {("a", None, 1.0), ("b", 5.0, 2.0)}
    _write(tmp_path, "weights_45.csv", "")
    with pytest.raises(ValueError, match="header"):
        microdata.read_weights(spark, template, [45])


def test_a_period_has_few_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "concat('wk', id % 5) as week_num").repartition(16)
    sinks.write_table(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("part-*.parquet"))) <= 2 * 5


def test_bad_lines_end_the_job_or_are_set_aside(spark, tmp_path):
    _write(tmp_path, "weights_46.csv", "SCRAM,WEEK,PWEIGHT,PWEIGHT1", "a,46,1,10", "", "short,46,1", "long,46,1,2,3", "text,46,1,x", "b,46,NA,7")
    _write(tmp_path, "weights_47.csv", "PWEIGHT,SCRAM,WEEK,PWEIGHT1", "2,c,47,5", "2,d,47,6")
    template = str(tmp_path / "weights_{week:02d}.csv")
    with pytest.raises(Exception, match="weights_46.csv"):
        microdata.read_weights(spark, template, [46, 47]).collect()
    scan = microdata.scan_weights(spark, template, [46, 47])
    good = microdata.good_rows(scan, strict=False)
    assert sorted((r["scram"], r["pweight"], r["pweight1"]) for r in good.collect()) == [("a", 1.0, 10.0), ("b", None, 7.0), ("c", 2.0, 5.0), ("d", 2.0, 6.0)]
    bad = {r["line_no"]: r for r in microdata.rejected_rows(scan).collect()}
    assert {n: (r["problem"], r["line"]) for n, r in bad.items()} == {
        4: ("not 4 cells", "short,46,1"), 5: ("not 4 cells", "long,46,1,2,3"), 6: ("no number in pweight1", "text,46,1,x")}
    assert all(r["file"].endswith("/weights_46.csv") for r in bad.values())
    assert microdata.rejected_rows(microdata.scan_weights(spark, template, [47])).collect() == []


def test_line_numbers_of_a_file_read_in_parts(spark, tmp_path):
    rows = [f"p{i},46,{i},{i if i % 701 else 'x'}" for i in range(1, 5001)]
    _write(tmp_path, "weights_46.csv", "SCRAM,WEEK,PWEIGHT,PWEIGHT1", *rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        scan = microdata.scan_weights(spark, str(tmp_path / "weights_{week:02d}.csv"), [46])
        assert scan.rdd.getNumPartitions() > 3
        found = sorted((r["line_no"], r["line"]) for r in microdata.rejected_rows(scan).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [(i + 1, f"p{i},46,{i},x") for i in range(701, 5001, 701)]
