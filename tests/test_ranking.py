import random

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import history as hs
from tallyfold.operators.ranking import total_rank


@pytest.mark.parametrize("rows", [0, 1, 2000])
def test_rank_counts_on_over_all_partitions(spark, rows):
    rng = random.Random(rows)
    # one key holds a third of the rows, some are null
    data = [(i, rng.choice(["hot", None, *"abcdefghij"]) if i % 3 else "hot") for i in range(rows)]
    df = spark.createDataFrame(data, "id long, key string").repartition(7)
    ranked = total_rank(df, [F.asc_nulls_last("key"), F.desc("id")])
    wanted = sorted(data, key=lambda r: (r[1] is None, r[1] or "", -r[0]))
    assert [(r["id"], r["key"]) for r in ranked.orderBy("rank").collect()] == wanted
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, rows + 1))
    assert ranked.columns == ["id", "key", "rank"]


def test_rank_without_a_window_over_all_rows(spark):
    plan = total_rank(spark.range(1000).repartition(5), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan  # the counts of the ranges
    assert plan.count("Window") == 1 and "sum(_n" in plan


def test_publication_rank_puts_unknown_weeks_last(spark):
    rows = [("a", "x", "US", "wk9"), ("a", "x", "US", "wk20"), ("a", "x", "US", "wk13"), ("a", None, "US", "wk13"), (None, "x", "US", "wk13")]
    df = spark.createDataFrame(rows, "metric string, race_var string, geography string, week_num string")
    got = hs.publication_rank(df).orderBy("row_rank").collect()
    assert [tuple(r)[:4] for r in got] == [rows[2], rows[1], rows[0], rows[3], rows[4]]
