"""Scans of spreadsheet exports that keep positions: which file and sheet a line is from and its number there.

An export has one CSV file for each sheet, below a folder or name that tells the workbook. Sheets start with title
lines, may have blank lines and quoted line breaks, and their lines may leave out empty cells at the end. None of that
survives a CSV scan, which drops blank lines and numbers nothing, so each file is read as one text, as bounded as a
sheet is, and cut into lines and cells by SQL expressions. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import codebook as cb

#: Cells of a line that are kept; those to the right are counted only.
SHEET_WIDTH = 40
TABLE_TITLE_LINES, DIMENSION_TITLE_LINES = 5, 2
#: Where a path has the table, the week and the sheet: .../food1_wk47.xlsx/US.csv, with or without column names in
#: the folders and with the sheet's name as file or as folder.
TABLE_PATH = r"([A-Za-z0-9]+)_w(?:ee)?k0*([0-9]+)(?:\.xlsx?)?/(?:sheet=)?([^/]+?)(?:\.csv|/part-[^/]*)$"
#: Columns of the list of metro areas, by the names in its header line.
METRO_COLUMNS = {"CBSA Code": "cbsa_code", "CSA Title": "csa_title", "CBSA Title": "cbsa_title"}


def _lines(text: Column) -> Column:
    """Lines of a CSV text; a line break within quotes becomes a space."""
    unquoted = F.transform(F.split(text, '"', -1), lambda part, i: F.when(i % 2 == 1, F.regexp_replace(part, r"\r?\n", " ")).otherwise(part))
    return F.split(F.regexp_replace(F.array_join(unquoted, '"'), r"\r?\n$", ""), r"\r?\n", -1)


def _n_cells(line: Column) -> Column:
    """Cells of a line up to the last that is not empty."""
    plain = F.regexp_replace(F.regexp_replace(line, '"[^"]+"', "q"), r"[,\s]+$", "")
    return F.when(plain == "", 0).otherwise(F.size(F.split(plain, ",", -1)))


def _cells(line: Column, width: int) -> Column:
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"nullValue": "", "escape": '"', "ignoreLeadingWhiteSpace": "true",
                                                                      "ignoreTrailingWhiteSpace": "true"})
    return F.array(*[parsed[n] for n in names])


def _files(spark: SparkSession, path: str) -> DataFrame:
    """file, lines: a row for each file below a path or pattern."""
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    # a name in a URI has its odd characters escaped
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return texts.select(name.alias("file"), _lines(F.ltrim(F.col("value"), F.lit("﻿"))).alias("lines"))


def sheet_lines(spark: SparkSession, path: str, title_lines: int = 0, width: int = SHEET_WIDTH) -> DataFrame:
    """file, line_no, n_cells and cells of every line that is not blank, behind the title lines.

    Lines are numbered from 1 at the top of their file, title and blank lines included.
    """
    rows = _files(spark, path).select("file", F.posexplode("lines").alias("at", "line"))
    return rows.where((F.col("at") >= title_lines) & (_n_cells(F.col("line")) > 0)).select(
        "file", (F.col("at") + 1).alias("line_no"), _n_cells(F.col("line")).alias("n_cells"), _cells(F.col("line"), width).alias("cells"))


def read_table_sheets(spark: SparkSession, path: str, title_lines: int = TABLE_TITLE_LINES, name: str = TABLE_PATH) -> DataFrame:
    """Published tables in long form (as ``microdata.benchmark_schema``) from the exports of their sheets.

    Table, week and area come from the path. A sheet's width is that of its widest line, as the lines may be ragged;
    a file whose path tells no week ends the job.
    """
    lines = F.slice("lines", title_lines + 1, F.greatest(F.size("lines") - title_lines, F.lit(0)))
    widest = F.array_max(F.transform(lines, _n_cells))
    files = _files(spark, path).select("file", "lines", F.coalesce(widest, F.lit(0)).alias("widest"))
    rows = files.select("file", "widest", F.posexplode("lines").alias("at", "line")).where(
        (F.col("at") >= title_lines) & (_n_cells(F.col("line")) > 0))
    cells = rows.select("*", _cells(F.col("line"), cb.BENCHMARK_MAX_COLUMNS + 1).alias("cells"))
    week = F.regexp_extract("file", name, 2)
    unknown = F.raise_error(F.concat(F.lit("no table, week and sheet in the name "), F.col("file"))).cast("int")
    return cells.select(
        F.regexp_extract("file", name, 1).alias("table_name"),
        F.when(week == "", unknown).otherwise(week.try_cast("int")).alias("week"),
        F.regexp_extract("file", name, 3).alias("geography"),
        (F.col("at") + 1).alias("line_no"),
        F.greatest(F.col("widest") - 1, F.lit(0)).alias("n_cols"),
        F.col("cells")[0].alias("variable"),
        *[F.col("cells")[i].alias(f"c{i}") for i in range(1, cb.BENCHMARK_MAX_COLUMNS + 1)],
    )


def read_titled_dimension(spark: SparkSession, path: str, columns: Mapping[str, str], title_lines: int = DIMENSION_TITLE_LINES,
                          width: int = SHEET_WIDTH) -> DataFrame:
    """A dimension exported with title lines above its header line: the named columns under new names, each row once.

    Columns are found by the header line's names, wherever they stand; one that is not there ends the job. Lines
    that have none of them but the first, as footnotes do, are left out.
    """
    files = _files(spark, path)
    header = F.transform(_cells(F.get("lines", F.lit(title_lines)), width), lambda c: F.trim(c))
    rows = files.select(header.alias("header"), F.posexplode("lines").alias("at", "line")).where(
        (F.col("at") > title_lines) & (_n_cells(F.col("line")) > 0)).select("header", _cells(F.col("line"), width).alias("cells"))

    def named(old: str) -> Column:
        place = F.array_position("header", old).cast("int")
        missing = F.raise_error(F.lit(f"the header line has no column {old}")).cast("string")
        return F.when(F.coalesce(place, F.lit(0)) == 0, missing).otherwise(F.get("cells", place - 1))

    found = rows.select(*[named(old).alias(new) for old, new in columns.items()])
    first, *others = columns.values()
    given = F.coalesce(*others).isNotNull() if others else F.col(first).isNotNull()
    return found.where(given).distinct()
