"""Checks of the estimates: external tables, regression, the plain variance formula."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import codebook as cb
from tallyfold.functions.replicates import SurveyDesign, base, spread_se
from tallyfold.operators.history import sample_with_replacement, sample_without_replacement
from tallyfold.operators.reshape import literal_array


SIDE_KEYS = ("week_num", "metric", "geo_type", "geography", "race_var")


def within_tolerance(left: Column, right: Column, tolerance: float = cb.COMPARE_TOLERANCE) -> Column:
    return left.between(right - tolerance, right + tolerance)


def compare_with_benchmark(estimates: DataFrame, shares: DataFrame) -> DataFrame:
    """Estimates beside external shares for the compared metrics and weeks, both rounded to 4.

    Rows where either side has no value are left out; ``within`` tells whether
    the two agree.
    """
    week = F.substring("week_num", 3, 9).cast("int")
    compared = F.lit(False)
    for metric, (first, last) in cb.COMPARED_METRICS.items():
        compared = compared | ((F.col("metric") == metric) & week.between(first, last))
    joined = estimates.where(compared).join(
        shares.select("week_num", "geography", "race_var", "metric", "benchmark_mean"),
        ["week_num", "geography", "race_var", "metric"],
        "left",
    )
    rounded = joined.withColumns(
        {"mean": F.bround("mean", 4), "benchmark_mean": F.bround("benchmark_mean", 4)}
    ).where(F.col("mean").isNotNull() & F.col("benchmark_mean").isNotNull())
    return rounded.select(
        "metric", "week_num", "geography", "race_var", "mean", "benchmark_mean",
        within_tolerance(F.col("mean"), F.col("benchmark_mean")).alias("within"),
    )


def failing(compared: DataFrame) -> DataFrame:
    return compared.where(~F.col("within"))


def assert_within(compared: DataFrame) -> None:
    bad = failing(compared).limit(5).collect()
    if bad:
        raise ValueError(f"estimates differ from the published tables, for example {bad}")


#: Respondents that a task adds up at once; 0.8 kB each with 21 metrics and 81 weights.
CHUNK_ROWS = 50000


def _runs(keys: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """An order that puts rows of equal keys together, where they start in it, and the keys there; a null is a key."""
    number = keys.groupby(list(keys.columns), dropna=False, sort=False).ngroup().to_numpy()
    order = np.argsort(number, kind="stable")
    starts = np.flatnonzero(np.diff(number[order], prepend=-1))
    return order, starts, keys.iloc[order[starts]].reset_index(drop=True)


def _area_sums(areas: Sequence[str], metrics: Sequence[str], schema: pa.Schema) -> Callable:
    """Task function: respondents in, sums by week, metric, area and race out, added up a chunk of respondents at a time."""
    def add_up(chunk: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        order, starts, cells = _runs(chunk.select(["week_num", "state", "cbsa_title", "race"]).to_pandas())
        weight, value = (chunk.column(c).flatten().to_numpy(zero_copy_only=False).reshape(chunk.num_rows, -1)[order] for c in ("w", "x"))
        weight = np.nan_to_num(weight, nan=0.0)
        given = ~np.isnan(value)
        x = np.stack([np.where(given, value, 0.0), given], axis=1)
        # the finest cells first, so that respondents are not doubled for the kinds of areas
        n = np.add.reduceat(given.astype(np.int64), starts, axis=0)
        sums = np.stack([np.tensordot(x[p:q], weight[p:q], (0, 0)) for p, q in zip(starts, [*starts[1:], len(order)])])
        for kind in areas:
            area = "US" if kind == "national" else cells["state" if kind == "state" else "cbsa_title"]
            placed = pd.DataFrame({"week_num": cells["week_num"], "geography": area, "race": cells["race"]})
            known = np.flatnonzero(placed["geography"].notna())
            if not len(known):
                continue
            order, starts, named = _runs(placed.iloc[known])
            order = known[order]
            for i, metric in enumerate(metrics):
                count = np.add.reduceat(n[order, i], starts)
                some = np.flatnonzero(count)
                both = np.add.reduceat(sums[order, :, i].reshape(len(order), -1), starts, axis=0)[some]
                keys = {"week_num": named["week_num"], "metric": metric, "geo_type": kind, "geography": named["geography"], "race": named["race"]}
                texts = [pa.array([v] * len(some) if isinstance(v, str) else v.iloc[some], pa.string(), from_pandas=True) for v in keys.values()]
                yield pa.RecordBatch.from_arrays([*texts, pa.array(count[some]), *[pa.array(c) for c in np.ascontiguousarray(both.T)]], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                yield from add_up(pa.concat_batches(held))
                held = []
        if any(b.num_rows for b in held):
            yield from add_up(pa.concat_batches(held))

    return run


def respondent_sides(df: DataFrame, design: SurveyDesign, areas: Sequence[str], metrics: Sequence[str] = cb.METRICS,
                     groups: Sequence[str] = cb.GROUPS) -> DataFrame:
    """Sums of each known group and of its rest, both non-empty, added up from respondents.

    ``areas`` are the geography types: state, msa, national. Nothing is shared with the cube: tasks add up products of weights
    and answers by area, Spark adds up what tasks hand on; the rest is what the whole has beside the group, not two frames. SQL
    sums, 162 over a row per answer or 63 over a row per weight, took longer.
    """
    keys = ("week_num", "metric", "geo_type", "geography")
    each = [(i, w) for i, w in enumerate(design.columns)]
    names = [f"{kind}_{i}" for kind in ("num", "den") for i, _ in each]
    texts = (*keys, "race")
    schema = pa.schema([*[(k, pa.string()) for k in texts], ("n", pa.int64()), *[(k, pa.float64()) for k in names]])
    columns = ", ".join([*[f"{k} string" for k in texts], "n bigint", *[f"{k} double" for k in names]])
    answers = ", ".join(f"cast({m} as double)" for m in metrics)
    weights = ", ".join(f"cast({w} as double)" for w in design.columns)
    rows = df.selectExpr("week_num", "state", "cbsa_title", "race", f"array({weights}) as w", f"array({answers}) as x")
    placed = rows.mapInArrow(_area_sums(areas, metrics, schema), columns)
    # one exchange serves the sums of the groups and those of their areas
    by_race = placed.repartition(*keys).groupBy(*keys, "race").agg(*[F.expr(f"sum({k}) as {k}") for k in ("n", *names)])
    area = f"over (partition by {', '.join(keys)})"
    whole = by_race.selectExpr("*", *[f"sum({k}) {area} as all_{k}" for k in ("n", *names)])
    both = whole.where(F.col("race").isin(*groups)).where("n > 0 and all_n > n")
    arrays = [f"array({', '.join(f'all_{kind}_{i} - {kind}_{i}' if left else f'{kind}_{i}' for i, _ in each)}) as {prefix}{kind}"
              for left, prefix in ((False, ""), (True, "rest_")) for kind in ("num", "den")]
    return both.selectExpr(*keys, "race as race_var", "n", "all_n - n as rest_n", *arrays)


#: Areas of each type that a check draws, and draws for the nation.
DRAWN_AREAS, DRAWN_NATIONAL = {"state": 7, "msa": 3}, 10


def draw_cells(places: DataFrame, weeks: Sequence[str], seed: str, areas: Mapping[str, int] = DRAWN_AREAS, metrics: Sequence[str] = cb.METRICS,
               groups: Sequence[str] = cb.GROUPS) -> DataFrame:
    """Areas of ``places`` (geo_type, geography) without replacement, each with a week, a group and a metric drawn for it."""
    keys = ["geo_type", "geography"]
    kinds = [sample_without_replacement(places.where(F.col("geo_type") == kind), n, seed, keys) for kind, n in areas.items()]
    return _with_draws(reduce(DataFrame.union, kinds).select(*keys), "geography", weeks, seed, metrics, groups)


def draw_national(spark: SparkSession, weeks: Sequence[str], seed: str, n: int = DRAWN_NATIONAL, metrics: Sequence[str] = cb.METRICS,
                  groups: Sequence[str] = cb.GROUPS) -> DataFrame:
    slots = spark.range(n).select(F.lit("national").alias("geo_type"), F.lit("US").alias("geography"), F.concat(F.lit("US"), "id").alias("slot"))
    return _with_draws(slots, "slot", weeks, seed, metrics, groups).distinct()


def _with_draws(slots: DataFrame, slot: str, weeks: Sequence[str], seed: str, metrics: Sequence[str], groups: Sequence[str]) -> DataFrame:
    for name, values in (("week_num", weeks), ("race_var", groups), ("metric", metrics)):
        slots = sample_with_replacement(slots, slot, values, f"{seed}|{name}", name)
    return slots.select(*SIDE_KEYS)


def drawn_sides(df: DataFrame, design: SurveyDesign, drawn: DataFrame, metrics: Sequence[str] = cb.METRICS) -> DataFrame:
    """As ``respondent_sides`` for the drawn cells alone: only respondents of a drawn week and area are added up, and of
    their answers only the drawn one. ``drawn`` has as many rows as were drawn, so it is broadcast."""
    place = {"state": F.col("state"), "msa": F.col("cbsa_title"), "national": F.lit("US")}
    kinds = F.array(*[F.struct(F.lit(k).alias("geo_type"), c.alias("geography")) for k, c in place.items()])
    wanted = drawn.withColumn("_at", F.array_position(literal_array(metrics), F.col("metric")).cast("int") - 1)
    rows = df.select("week_num", "race", F.array(*[F.col(m).cast("double") for m in metrics]).alias("_x"), *design.columns, F.inline(kinds))
    met = rows.join(F.broadcast(wanted), ["week_num", "geo_type", "geography"]).select(
        *SIDE_KEYS, F.col("race").eqNullSafe(F.col("race_var")).alias("own"), F.get("_x", F.col("_at")).alias("x"), *design.columns)
    sums = {f"{kind}_{i}": F.sum(F.col(w) * F.col("x") if kind == "num" else F.col(w))
            for i, w in enumerate(design.columns) for kind in ("num", "den")}
    by_side = met.where("x is not null").groupBy(*SIDE_KEYS, "own").agg(F.count("x").alias("n"), *[c.alias(k) for k, c in sums.items()])
    packed = by_side.select(*SIDE_KEYS, "own", "n", *[F.array(*[f"{kind}_{i}" for i in range(len(design.columns))]).alias(kind) for kind in ("num", "den")])
    sides = [F.first(F.when(F.col("own") if own else ~F.col("own"), F.col(c)), ignorenulls=True).alias(prefix + c)
             for own, prefix in ((True, ""), (False, "rest_")) for c in ("n", "num", "den")]
    return packed.groupBy(*SIDE_KEYS).agg(*sides).where("n > 0 and rest_n > 0")


def weighted_regression(sides: DataFrame, design: SurveyDesign) -> DataFrame:
    """Weighted least squares of the metric on the group dummy, from weighted sums.

    The slope of each weight set is cov(d, x) / var(d); the error follows from
    the spread of the replicate slopes.
    """
    def slope(s: Column) -> Column:
        w, x = s["den"] + s["rest_den"], s["num"] + s["rest_num"]
        return F.try_divide(w * s["num"] - s["den"] * x, w * s["den"] - s["den"] * s["den"])

    slopes = F.transform(F.arrays_zip("num", "den", "rest_num", "rest_den"), slope)
    frame = sides.select(*SIDE_KEYS, slopes.alias("_slopes"))
    return frame.select(
        *SIDE_KEYS, base(F.col("_slopes")).alias("slope"), spread_se(F.col("_slopes"), design).alias("slope_se")
    )


def regression_check(sides: DataFrame, estimates: DataFrame, design: SurveyDesign, digits: int = 4) -> DataFrame:
    """Regression slope against the published contrast: absolute values and errors."""
    fitted = weighted_regression(sides, design)
    reported = estimates.where(F.col("race_var") != cb.TOTAL).select(*SIDE_KEYS, "diff_mean", "diff_se")
    joined = fitted.join(reported, list(SIDE_KEYS), "left")
    return joined.withColumn(
        "agree", _agree(F.col("slope"), F.col("slope_se"), digits)
    )


def _agree(diff: Column, se: Column, digits: int) -> Column:
    """Difference (sign aside) and error equal the reported ones to ``digits`` decimals."""
    tolerance = 10.0**-digits
    return (F.abs(F.abs(diff) - F.abs("diff_mean")) < tolerance) & (F.abs(se - F.col("diff_se")) < tolerance)


def manual_contrasts(sides: DataFrame, design: SurveyDesign) -> DataFrame:
    """Group minus rest and total minus group from replicates in long form.

    A row per replicate, and the variance as 4/R times the sum of squared
    distances. With the sides of ``respondent_sides`` nothing comes from the
    cube that is checked. The number of rows does not grow with the respondents.
    """
    first = {c: F.get(c, F.lit(0)) for c in ("num", "den", "rest_num", "rest_den")}

    def group_rest(num: Column, den: Column, rest_num: Column, rest_den: Column) -> Column:
        return F.try_divide(num, den) - F.try_divide(rest_num, rest_den)

    def total_group(num: Column, den: Column, rest_num: Column, rest_den: Column) -> Column:
        return F.try_divide(num + rest_num, den + rest_den) - F.try_divide(num, den)

    sums = ("num", "den", "rest_num", "rest_den")
    rows = sides.select(
        *SIDE_KEYS,
        group_rest(*first.values()).alias("group_rest"),
        total_group(*first.values()).alias("total_group"),
        F.posexplode(F.arrays_zip(*sums)).alias("r", "s"),
    )
    parts = [F.col(f"s.{c}") for c in sums]
    squared = rows.where("r > 0").select(
        *SIDE_KEYS, "group_rest", "total_group",
        ((group_rest(*parts) - F.col("group_rest")) ** 2).alias("_gr"),
        ((total_group(*parts) - F.col("total_group")) ** 2).alias("_tg"),
    )
    k = F.lit(4.0 / len(design.replicates))
    out = squared.groupBy(*SIDE_KEYS).agg(
        F.any_value("group_rest").alias("group_rest"),
        F.sqrt(k * F.sum("_gr")).alias("group_rest_se"),
        F.any_value("total_group").alias("total_group"),
        F.sqrt(k * F.sum("_tg")).alias("total_group_se"),
    )
    return out.withColumns(
        {
            "group_rest_t": F.try_divide("group_rest", "group_rest_se"),
            "total_group_t": F.try_divide("total_group", "total_group_se"),
        }
    )


def manual_check(manual: DataFrame, estimates: DataFrame, digits: int = 8) -> DataFrame:
    """Manual contrasts beside the published ones, agreeing at ``digits`` decimals."""
    reported = estimates.where(F.col("race_var") != cb.TOTAL).select(*SIDE_KEYS, "diff_mean", "diff_se")
    joined = manual.join(reported, list(SIDE_KEYS), "left")
    return joined.withColumn("agree", _agree(F.col("group_rest"), F.col("group_rest_se"), digits))
