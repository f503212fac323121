"""Published tables in long form, derived from the stand-in respondents.

Each cell is a weighted count of an answer, by week, area and group, laid out
by position as the real tables are: a total line, the section header and a
line per group. One metro area's food table is shifted by 0.01 in one week, so
that comparing has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.operators.reshape import stack_geographies
from tallyfold.sources.sheets import TABLE_TITLE_LINES
from tallyfold.standin import respondents as rs

SHIFTED = ("msa", 20, rs.REGION_METROS[2], 0.01)
HEADER = "Hispanic origin and Race"
GROUP_LABELS = (cb.HISPANIC_LABEL, *cb.RACE_LABELS.values())


def _codes(column: str, **codes: int) -> dict[str, str]:
    return {name: f"{column} = {code}" for name, code in codes.items()}


CONFIDENCE = {
    **_codes("mortconf", no_confidence=1, slight_confidence=2, moderate_confidence=3, high_confidence=4,
             payment_deferred=5),
    "did_not_respond_conf": "mortconf < 0",
}
# table -> (who is in it, column -> who is counted in that column)
CONTENT: dict[str, tuple[str, dict[str, str]]] = {
    "employ1": ("1 = 1", {
        "total": "1 = 1", **_codes("wrkloss", income_loss=1, no_income_loss=2),
        "did_not_report_loss": "wrkloss < 0", "did_not_report": "wrkloss < 0",
        **_codes("expctloss", income_loss_next_4_wks=1, no_income_next_4_wks=2),
        "did_not_report_next_4_wks": "expctloss < 0"}),
    "food": ("1 = 1", {
        "total": "1 = 1",
        **_codes("curfoodsuf", enough=1, enough_but_not_wanted=2, sometimes_not_enough=3, often_not_enough=4),
        "did_not_report": "curfoodsuf < 0"}),
    "housing2a": ("tenure = 2", {
        "total": "1 = 1", "owned_free_clear": "1 = 0", **CONFIDENCE, "renter_occupied": "1 = 0",
        "did_not_respond_tenure": "1 = 0"}),
    "housing2b": ("tenure = 3", {
        "total": "1 = 1", "occup_no_rent": "1 = 0", **CONFIDENCE, "owner_occupied": "1 = 0",
        "did_not_respond_tenure": "1 = 0"}),
    "housing1b": ("tenure in (3, 4)", {
        "total": "1 = 1", "occup_no_rent": "tenure = 4",
        "payment_caughtup_yes": "tenure = 3 and rentcur = 1", "payment_caughtup_no": "tenure = 3 and rentcur = 2",
        "did_not_report": "tenure = 3 and rentcur < 0", "did_not_report_tenure": "1 = 0"}),
    "health2a": ("1 = 1", {
        **{f"{c}_{n}": f"{c} = {i}" for c in ("anxious", "worry")
           for i, n in enumerate(("not_at_all", "several", "halfmore", "nearlyall"), start=1)},
        **{f"{c}_no_response": f"{c} < 0" for c in ("anxious", "worry")}}),
    "health2b": ("1 = 1", {
        **{f"{c}_{n}": f"{c} = {i}" for c in ("interest", "down")
           for i, n in enumerate(("not_at_all", "several", "halfmore", "nearlyall"), start=1)},
        **{f"{c}_no_response": f"{c} < 0" for c in ("interest", "down")}}),
    "health3": ("1 = 1", {
        "total_insured": "hlthins1 = 1 or hlthins3 = 1", "private": "hlthins1 = 1", "public": "hlthins3 = 1",
        "uninsured": "hlthins1 = 2 and hlthins3 = 2", "not_reported": "hlthins1 < 0"}),
    "housing3b": ("1 = 1", {
        "total": "1 = 1",
        **_codes("evict", very_likely=1, somewhat_likely=2, not_very_likely=3, not_likely=4),
        "did_not_report": "evict < 0"}),
    "transport1": ("tw_start is not null", {
        "total": "1 = 1", **_codes("tw_start", telework_start_yes=1, telework_start_no=2, no_change=3),
        "did_not_report": "tw_start < 0"}),
}


def layouts() -> list[dict]:
    """Layouts in use in the stand-in weeks: of two widths, the narrow form before week 20."""
    out = []
    for layout in cb.BENCHMARK_LAYOUTS:
        first, last = layout["weeks"]
        if layout["n_cols"] == 9:
            last = 19
        elif layout["n_cols"] == 10:
            first = 20
        if first <= rs.LAST_WEEK:
            out.append({**layout, "weeks": (first, min(last, rs.LAST_WEEK))})
    return out


def content(table: str) -> tuple[str, dict[str, str]]:
    return CONTENT["food" if table.startswith("food") else table]


def cells_sql() -> dict[str, str]:
    """Every weighted count any table needs: name -> summed expression.

    Weights count in hundredths, as whole numbers, so that the counts add up
    exactly like published ones do.
    """
    out = {}
    for layout in layouts():
        who, columns = content(layout["table"])
        for name in layout["columns"]:
            out[f"{layout['table']}_{name}"] = f"case when ({who}) and ({columns[name]}) then round(pweight * 100) else 0 end"
    return out


def benchmark_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables as they would land, values as text."""
    cells = cells_sql()
    placed = stack_geographies(rs.microdata(spark, sf_dir), nation="US")
    summed = placed.groupBy("week", "geo_type", "geography", "hisp_rrace").agg(
        *[F.expr(f"sum({sql}) as {name}") for name, sql in cells.items()]
    )
    # a sheet per week and area, with a title and a header line above its groups
    labels = ", ".join(f"'{t}'" for t in GROUP_LABELS)
    line = f"named_struct('line_no', cast(array_position(array({labels}), hisp_rrace) as int) + 2, 'variable', hisp_rrace, " + ", ".join(
        f"'{c}', {c}" for c in cells) + ")"
    sheets = summed.groupBy("week", "geo_type", "geography").agg(
        F.expr(f"collect_list(case when hisp_rrace is not null then {line} end) as groups"))
    blank = ", ".join(f"'{c}', cast(null as double)" for c in cells)
    heads = ", ".join(f"named_struct('line_no', {n}, 'variable', '{text}', {blank})" for n, text in ((1, "Total"), (2, HEADER)))
    written = sheets.where(F.size("groups") > 0).selectExpr("week", "geo_type", "geography", f"inline(concat(array({heads}), groups))")
    width = cb.BENCHMARK_MAX_COLUMNS
    candidates = []
    for layout in layouts():
        values = [f"cast({layout['table']}_{c} as string)" for c in layout["columns"]]
        values += ["cast(null as string)"] * (width - len(values))
        cells_of = ", ".join(f"'c{i}', {v}" for i, v in enumerate(values, start=1))
        first, last = layout["weeks"]
        candidates.append(f"case when week between {first} and {last} then named_struct('table_name', '{layout['table']}',"
                          f" 'n_cols', {len(layout['columns'])}, {cells_of}) end")
    values = [f"c{i}" for i in range(1, width + 1)]
    lines = written.selectExpr("week", "geo_type", "geography", "variable", "line_no",
                               f"inline(filter(array({', '.join(candidates)}), line -> line is not null))")
    geo_type, week, geography, shift = SHIFTED
    moved = (F.col("table_name").startswith("food") & (F.col("geo_type") == geo_type) & (F.col("week") == week)
             & (F.col("geography") == geography) & (F.col("line_no") > 2))
    # metro areas under the names the tables have for them
    names = F.create_map(*[F.lit(x) for title, _, name in cb.METROS for x in (title, name)])
    return lines.withColumn(
        "c4", F.when(moved, (F.col("c4").cast("double") + shift * F.col("c1").cast("double")).cast("string"))
        .otherwise(F.col("c4"))
    ).withColumn("geography", F.coalesce(F.try_element_at(names, "geography"), "geography")).select(
        "table_name", "week", "geography", "line_no", "n_cols", "variable", *values)


def land_sheets(lines: DataFrame, folder: str) -> None:
    """Write the tables as exports of their sheets: a CSV file for each, title lines first, blank lines where a group
    has none of its own."""
    cells = ["variable", *[f"c{i}" for i in range(1, cb.BENCHMARK_MAX_COLUMNS + 1)]]
    written = F.to_csv(F.struct(*cells), {"nullValue": "", "emptyValue": ""})
    titles = F.array(F.concat(F.lit('"Table '), F.col("table_name"), F.lit(', by area"')), F.lit(""), F.lit("Source: stand-in"), F.lit(""),
                     F.lit("Characteristic,Total"))
    assert TABLE_TITLE_LINES == 5
    sheets = lines.groupBy("table_name", "week", "geography").agg(
        F.map_from_entries(F.collect_list(F.struct("line_no", written.alias("line")))).alias("by_number"), F.max("line_no").alias("last"))
    body = F.transform(F.sequence(F.lit(1), F.col("last")), lambda i: F.coalesce(F.try_element_at("by_number", i), F.lit("")))
    files = sheets.select(
        F.concat("table_name", F.lit("_wk"), "week", F.lit(".xlsx")).alias("workbook"), F.col("geography").alias("sheet"),
        F.array_join(F.concat(titles, body), "\n").alias("value"))
    # a small file each, so many tasks write them
    files.repartition(64, "workbook", "sheet").write.mode("overwrite").partitionBy("workbook", "sheet").text(folder)
