"""Scans of landed microdata, replicate weights and dimensions."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import codebook as cb
from tallyfold.functions.replicates import SurveyDesign
from tallyfold.operators.columns import snake
from tallyfold.operators.harmonise import stack_periods
from tallyfold.operators.joins import keep_first

CSV_OPTIONS = {"header": "true", "nullValue": "NA"}


def microdata_year(week: int, starts: Sequence = cb.MICRODATA_YEAR_STARTS) -> int:
    return next(year for upper, year in starts if upper is None or week < upper)


def period_path(template: str, week: int) -> str:
    """Path of one week's file; the template may use root-relative {year}, {week} and {week:02d}."""
    return template.format(year=microdata_year(week), week=week)


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of a file; reads no more than that."""
    line = spark.read.text(file).head()
    return tuple(next(csv.reader([line["value"].lstrip("\ufeff")]))) if line else ()


#: Columns of a scan that tell where a line stands, what is wrong with it, and the line.
LINE_FIELDS = ("_file", "_block", "_at", "_line", "_problem")


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Lines of files with their place: the block of the file that a task reads, and a number that grows within it."""
    text = spark.read.text(list(files))
    return text.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_at"), F.ltrim(F.col("value"), F.lit("\ufeff")).alias("_line"))


def _parsed(spark: SparkSession, header: tuple[str, ...], files: Sequence[str], types: Mapping[str, str], default: str) -> DataFrame:
    """Typed columns of the files that share a header line, and LINE_FIELDS; bad cells are null."""
    names = [snake(c) for c in header]
    if len(set(names)) < len(names):
        raise ValueError(f"columns meet in one name: {sorted({n for n in names if names.count(n) > 1})}")
    raw = ", ".join(f"`{n}` string" for n in [*names, "_short_or_long"])
    options = {"nullValue": "NA", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_short_or_long"}
    lines = _lines(spark, files).where((F.trim("_line") != "") & (F.col("_line") != _header_line(spark, files[0])))
    rows = lines.select("*", F.from_csv("_line", raw, options).alias("_raw"))
    cells = {n: F.col("_raw")[n] for n in names}
    kinds = {n: types.get(n, default) for n in names}
    typed = {n: c if kinds[n] == "string" else c.try_cast(kinds[n]) for n, c in cells.items()}
    odd = F.filter(F.array(*[F.when(cells[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in names]), lambda n: n.isNotNull())
    problem = F.when(F.col("_raw")["_short_or_long"].isNotNull(), F.concat(F.lit("not "), F.lit(len(names)).cast("string"), F.lit(" cells"))).when(
        F.size(odd) > 0, F.concat(F.lit("no number in "), F.array_join(odd, ", ")))
    return rows.select(*[c.alias(n) for n, c in typed.items()], *LINE_FIELDS[:4], problem.alias("_problem"))


def _header_line(spark: SparkSession, file: str) -> str:
    return spark.read.text(file).head()["value"].lstrip("\ufeff")


def _scan(spark: SparkSession, paths: Sequence[str], types: Mapping[str, str], default: str, allow_extra: bool = False) -> DataFrame:
    """Typed columns by the names in each file's own header line, and LINE_FIELDS.

    There is one scan for each distinct header, so files may order their columns differently. Files of one scan must have
    the same columns; ``allow_extra`` lets some have more, which are null for the others. Files without a line have no rows.
    """
    files = [f for path in paths for f in spark.read.text(path).inputFiles()]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        if header := header_of(spark, file):
            by_header.setdefault(header, []).append(file)
    if not by_header:
        raise ValueError(f"no header line in {list(paths)}")
    scans = [_parsed(spark, header, same, types, default) for header, same in by_header.items()]
    common = set.intersection(*[set(scan.columns) for scan in scans])
    odd = sorted({c for scan in scans for c in scan.columns} - common)
    if odd and not allow_extra:
        raise ValueError(f"these columns are not in all files of one layout: {odd}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def good_rows(scanned: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of a scan without a problem. ``strict``: a line with one ends the job, which names it."""
    problem = F.concat(F.col("_problem"), F.lit(" in "), F.col("_file"), F.lit(": "), F.col("_line"))
    good = F.when(F.col("_problem").isNull(), True).otherwise(F.raise_error(problem) if strict else F.lit(False))
    return scanned.where(good.cast("boolean")).drop(*LINE_FIELDS)


def rejected_rows(scanned: DataFrame) -> DataFrame:
    """file, line_no, problem and line of what a scan rejects.

    A line's number is its place in the part of the file that a task read, behind the lines of the parts before. Those
    are counted per part, of files that have a rejected line.
    """
    spark = scanned.sparkSession
    bad = scanned.where(F.col("_problem").isNotNull()).select(*LINE_FIELDS)
    files = [r["_file"] for r in bad.select("_file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], "file string, line_no long, problem string, line string")
    # each file in a scan of its own order, so that both passes number it alike
    counted = _lines(spark, sorted(files)).groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_block")) - F.col("_n")
    parts = counted.select("_file", "_block", "_first", before.alias("_before"))
    placed = _lines(spark, sorted(files)).join(bad.select("_file", "_line", "_problem").distinct(), ["_file", "_line"])
    return placed.join(parts, ["_file", "_block"]).select(
        F.url_decode("_file").alias("file"), (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line_no"),
        F.col("_problem").alias("problem"), F.col("_line").alias("line"))


ANSWER_TYPES = {"scram": "string", "week": "int", "est_st": "string", "est_msa": "string", "tbirth_year": "int"}
WEIGHT_TYPES = {"scram": "string", "week": "int"}


def scan_answers(spark: SparkSession, template: str, weeks: Iterable[int], allow_extra: bool = False) -> DataFrame:
    """Answers of many weeks with LINE_FIELDS, one scan per questionnaire layout and header, harmonised and stacked."""
    def read(same_layout: list[int]) -> DataFrame:
        return _scan(spark, [period_path(template, w) for w in same_layout], ANSWER_TYPES, "double", allow_extra)

    return stack_periods(weeks, read)


def scan_weights(spark: SparkSession, template: str, weeks: Iterable[int], allow_extra: bool = False) -> DataFrame:
    """Replicate weights of many weeks with LINE_FIELDS, one scan per header."""
    return _scan(spark, [period_path(template, w) for w in sorted(set(weeks))], WEIGHT_TYPES, "double", allow_extra)


def read_answers(spark: SparkSession, template: str, weeks: Iterable[int], allow_extra: bool = False) -> DataFrame:
    """Coded answers of many weeks; a line with too few or too many cells, or with text for a number, ends the job."""
    return good_rows(scan_answers(spark, template, weeks, allow_extra))


def read_weights(spark: SparkSession, template: str, weeks: Iterable[int], allow_extra: bool = False) -> DataFrame:
    return good_rows(scan_weights(spark, template, weeks, allow_extra))


def week_from_file(df: DataFrame, pattern: str = r"_([0-9]{2})\.[a-z]+$") -> DataFrame:
    """Week number of each row from the name of the file it came from."""
    return df.withColumn("week", F.regexp_extract(F.input_file_name(), pattern, 1).try_cast("int"))


STATE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("state", "state_code", "state_name")]
)
METRO_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("cbsa_code", "csa_title", "cbsa_title")]
)


def read_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path).distinct()


def read_history(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """A published CSV by its header line, with its declared columns; those an older file lacks are null.

    With ``keys``, of rows with equal keys the first in the file stays.
    """
    types = {f.name: f.dataType.simpleString() for f in schema}
    rows = _scan(spark, [path], types, "string", allow_extra=True)
    if keys:
        rows = keep_first(rows, keys, LINE_FIELDS[:3])
    rows = good_rows(rows)
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def estimate_schema(full: bool = False) -> T.StructType:
    """Columns of published estimates, each with its note."""
    notes = {name: note for name, _, note in cb.ESTIMATE_DICTIONARY}
    text = ("geography", "metric", "week_num", "race_var", "geo_type", "date_int")
    order = ("geography", "metric", "week_num", "race_var", "mean", "se", "moe_95", "moe_95_lb", "moe_95_ub",
             "geo_type", "sigdiff", "date_int", *(("var_removed",) if full else ()))
    return T.StructType(
        [
            T.StructField(c, T.StringType() if c in text else T.DoubleType(), True, {"comment": notes.get(c, "")})
            for c in order
        ]
    )


def benchmark_schema() -> T.StructType:
    """Long form of published tables: one row per sheet line, values by position as text."""
    return T.StructType(
        [
            T.StructField("table_name", T.StringType()),
            T.StructField("week", T.IntegerType()),
            T.StructField("geography", T.StringType()),
            T.StructField("line_no", T.IntegerType()),
            T.StructField("n_cols", T.IntegerType()),
            T.StructField("variable", T.StringType()),
            *[T.StructField(f"c{i}", T.StringType()) for i in range(1, cb.BENCHMARK_MAX_COLUMNS + 1)],
        ]
    )


def read_benchmark(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(benchmark_schema()).options(**CSV_OPTIONS).csv(path)


def load_design(spark: SparkSession, path: str) -> tuple[DataFrame, SurveyDesign]:
    """Microdata and its design as kept by ``sinks.save_design``."""
    row = spark.read.parquet(f"{path}/design").first()
    design = SurveyDesign(row["weight"], tuple(row["replicates"]), row["se_factor"])
    return spark.read.parquet(f"{path}/data"), design
