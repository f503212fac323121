"""Small fixed tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold import codebook as cb


def week_dates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(cb.WEEK_DATES), "week_num string, date_int string")


def metro_short_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([m[:2] for m in cb.METROS], "cbsa_title string, cbsa_title_short string")


def benchmark_metro_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m[2], m[0]) for m in cb.METROS], "data_table_msa_name string, msa_name string")


def estimate_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(cb.ESTIMATE_DICTIONARY), "variable_name string, variable_type string, definition string"
    )


def indicator_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(cb.INDICATOR_NOTES), "col_name string, description string")


def response_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(cb.RESPONSE_NOTES), "col_name string, description string")
