import pytest

from tallyfold.operators import benchmark as bm
from tallyfold.sources import sheets

TITLES = ['"Table 1. Food, by', 'area"', "", "Source: a survey,,,", "", "Select characteristics,Total,Enough"]


def write(folder, name, lines, end="\n"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(end.join(lines).encode())


def lines_of(spark, path, *args, **kwargs):
    return sorted(tuple(r) for r in sheets.sheet_lines(spark, path, *args, **kwargs).select("line_no", "n_cells", "cells").collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_positions_survive_titles_blanks_and_quotes(spark, tmp_path, end):
    write(tmp_path, "s.csv", ["﻿title", "", "a,1,,", "", ',"x, ""y""",2', '"two', 'lines",3', ",,,", " last , 4 ", ""], end)
    got = lines_of(spark, str(tmp_path), 1, width=4)
    assert got == [(3, 2, ["a", "1", None, None]), (5, 3, [None, 'x, "y"', "2", None]), (6, 2, ["two lines", "3", None, None]),
                   (8, 2, ["last", "4", None, None])]


def test_wider_lines_are_counted_whole(spark, tmp_path):
    write(tmp_path, "s.csv", ["a,1,2,3,4,5"])
    assert lines_of(spark, str(tmp_path), width=2) == [(1, 6, ["a", "1"])]


def table(folder, name, *rows):
    write(folder, name, ["t1", "t2", "", "t4", "Characteristic,Total", "Total,99,1", "Hispanic origin and Race", *rows, "* a note"])


def test_tables_by_name_week_and_sheet(spark, tmp_path):
    table(tmp_path, "food1_wk47.xlsx/US.csv", '"White alone, not Hispanic",10,9,1,0,0,0')
    table(tmp_path, "food1_wk47.xlsx/New.York_Metro_Area.csv", '"White alone, not Hispanic",10,0,0,9,1,-')
    table(tmp_path, "housing2a_week08/District of Columbia.csv", '"White alone, not Hispanic",1,2,3,4,5,6,7,8,9,10')
    rows = bm.race_rows(sheets.read_table_sheets(spark, str(tmp_path))).collect()
    got = {(r["table_name"], r["week"], r["geography"]): r for r in rows}
    assert set(got) == {("food1", 47, "US"), ("food1", 47, "New.York_Metro_Area"), ("housing2a", 8, "District of Columbia")}
    us = got["food1", 47, "US"]
    assert (us["line_no"], us["n_cols"], us["variable"], us["c1"], us["c6"], us["c7"]) == (8, 6, "White alone, not Hispanic", "10", "0", None)
    assert got["food1", 47, "New.York_Metro_Area"]["c6"] == "-"
    assert got["housing2a", 8, "District of Columbia"]["n_cols"] == 10


def test_ragged_lines_have_the_width_of_their_sheet(spark, tmp_path):
    table(tmp_path, "housing2a_wk20/US.csv", '"White alone, not Hispanic",1,2', '"Black alone, not Hispanic",1,2,3,4,5,6,7,8,9')
    rows = bm.race_rows(sheets.read_table_sheets(spark, str(tmp_path))).collect()
    assert [r["n_cols"] for r in rows] == [9, 9] and rows[0]["c3"] is None


def test_shares_from_sheets(spark, tmp_path):
    from tallyfold.sources import literals

    table(tmp_path, "food1_wk47/Chicago_Metro_Area.csv", '"White alone, not Hispanic",10,5,1,2,1,1')
    lines = sheets.read_table_sheets(spark, str(tmp_path))
    share = bm.benchmark_ratios(lines, literals.benchmark_metro_names(spark)).where("metric = 'food_insufficient'").first()
    assert share["geography"].startswith("Chicago-Naperville") and share["race_var"] == "white" and share["share"] == 3 / 9


def test_a_name_without_a_week_ends_the_job(spark, tmp_path):
    table(tmp_path, "food1/US.csv", '"White alone, not Hispanic",1')
    with pytest.raises(Exception, match="no table, week and sheet"):
        sheets.read_table_sheets(spark, str(tmp_path)).collect()


CODES = {"CBSA Code": "cbsa_code", "CSA Title": "csa_title", "CBSA Title": "cbsa_title"}


def test_a_dimension_below_its_titles(spark, tmp_path):
    write(tmp_path, "m.csv", ["List 1. Areas", '"as of, 2020"', "CBSA Code,Division,CBSA Title,CSA Title", "10100,,\"Aberdeen, SD\",",
                              "10100,x,\"Aberdeen, SD\",", "10140,,\"Aberdeen, WA\",Grays", "", "Note: one line of text", "Source: b"])
    got = sheets.read_titled_dimension(spark, str(tmp_path), CODES)
    assert got.columns == ["cbsa_code", "csa_title", "cbsa_title"]
    assert sorted(map(tuple, got.collect()), key=str) == [("10100", None, "Aberdeen, SD"), ("10140", "Grays", "Aberdeen, WA")]


def test_a_dimension_without_a_column_ends_the_job(spark, tmp_path):
    write(tmp_path, "m.csv", ["t", "t", "CBSA Code,CBSA Title", "1,a"])
    with pytest.raises(Exception, match="CSA Title"):
        sheets.read_titled_dimension(spark, str(tmp_path), CODES).collect()


def test_no_shuffle_in_a_scan_of_sheets(spark, tmp_path):
    table(tmp_path, "food1_wk47/US.csv", '"White alone, not Hispanic",1')
    plan = sheets.read_table_sheets(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
