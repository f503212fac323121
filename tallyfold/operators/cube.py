"""The additive cell cube: one pass over the microdata feeds every estimate.

A row of the cube holds, for one combination of keys and one metric, the number of answers, their extremes, and for
each weight the sums of w*x and of w over the answers. All of it adds up, so coarser domains come from the cube and
the microdata is read once.

The sums are 2 x metrics x weights per respondent (3402 with 21 and 81). As SQL sums they took up to 7 times as long
as a matrix product per run of equal keys, which is why a task's own rows are added up in Python, sorted by key a chunk at a time. What
tasks hand on are flat doubles, which Spark's aggregation adds up; the rest of a group is a sum over two window frames.
Between steps sums are flat columns (``flat_names``); ``packed`` makes arrays of them, as in a kept cube.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.replicates import SurveyDesign

# Sums held by a task before they are passed on; 27 kB each with 21 metrics and 81 weights.
MAX_HELD = 8000
# Respondents that a task sorts by their keys at once; 0.8 kB each with 21 metrics and 81 weights.
CHUNK_ROWS = 20000
# Rows of 1.3 kB per batch passed on.
OUT_ROWS = 4000


def flat_names(width: int, prefix: str = "") -> list[str]:
    return [f"{prefix}{side}_{i}" for side in ("num", "den") for i in range(width)]


def _array(names: Iterable[str]) -> str:
    return f"array({', '.join(names)})"


def packed(df: DataFrame, width: int, prefixes: Sequence[str] = ("",)) -> DataFrame:
    """Flat sums as the arrays num and den, for each prefix."""
    gone = {n for p in prefixes for n in flat_names(width, p)}
    arrays = [f"{_array(f'{p}{side}_{i}' for i in range(width))} as {p}{side}" for p in prefixes for side in ("num", "den")]
    return df.selectExpr(*[f"`{c}`" for c in df.columns if c not in gone], *arrays)


def flattened(df: DataFrame, width: int) -> DataFrame:
    """Arrays num and den as flat sums."""
    flat = [f"get({side}, {i}) as {side}_{i}" for side in ("num", "den") for i in range(width)]
    return df.selectExpr(*[f"`{c}`" for c in df.columns if c not in ("num", "den")], *flat)


def _added_up(width: int) -> list[Column]:
    """The sums as SQL text: hundreds of columns are named by one call each."""
    return [F.expr(text) for text in ("sum(n) as n", "min(lo) as lo", "max(hi) as hi", *[f"sum({c}) as {c}" for c in flat_names(width)])]


def chunks(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to ``n`` rows or a little more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= n:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def runs(batch: pa.RecordBatch, keys: Sequence[str]) -> tuple[np.ndarray, list[tuple[int, int, tuple]]]:
    """An order in which rows of equal keys are neighbours, and (start, end, key) of each of their runs in it."""
    n = batch.num_rows
    if not n:
        return np.zeros(0, np.int64), []
    if not keys:
        return np.arange(n), [(0, n, ())]
    codes = []
    for name in keys:
        column = batch.column(name).dictionary_encode()
        codes.append(column.indices.fill_null(len(column.dictionary)).to_numpy(zero_copy_only=False))
    order = np.lexsort(codes[::-1])
    opens = np.zeros(n, bool)
    opens[0] = True
    for code in codes:
        opens[1:] |= np.diff(code[order]) != 0
    starts = np.flatnonzero(opens)
    firsts = batch.select(list(keys)).take(pa.array(order[starts]))
    rows = list(zip(*[firsts.column(k).to_pylist() for k in keys]))
    return order, list(zip(starts.tolist(), [*starts[1:].tolist(), n], rows))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An array column of fixed width as a matrix, nulls as NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Sums:
    """Running sums of one domain: a row per metric."""

    __slots__ = ("n", "lo", "hi", "both")

    def __init__(self, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, both: np.ndarray):
        self.n, self.lo, self.hi, self.both = n.copy(), lo.copy(), hi.copy(), both.copy()

    def add(self, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, both: np.ndarray) -> None:
        self.n += n
        np.fmin(self.lo, lo, out=self.lo)
        np.fmax(self.hi, hi, out=self.hi)
        self.both += both


def _batches(held: dict, metrics: Sequence[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    per_batch = max(1, OUT_ROWS // len(metrics))
    items = list(held.items())
    for start in range(0, len(items), per_batch):
        chunk = items[start : start + per_batch]
        n = np.concatenate([s.n for _, s in chunk])
        where = np.flatnonzero(n > 0)
        # sums by column: what Arrow takes without a copy
        both = np.concatenate([s.both for _, s in chunk], axis=1)[:, where]
        sums = both.transpose(0, 2, 1).reshape(-1, len(where))
        place, metric = np.divmod(where, len(metrics))
        keys = [pa.array([chunk[p][0][k] for p in place.tolist()], type=schema.field(k).type) for k in range(len(chunk[0][0]))]
        yield pa.RecordBatch.from_arrays([
            *keys, pa.array([metrics[m] for m in metric.tolist()], pa.string()), pa.array(n[where]),
            *[pa.array(np.concatenate([getattr(s, side) for _, s in chunk])[where]) for side in ("lo", "hi")],
            *[pa.array(column) for column in np.ascontiguousarray(sums)]], schema=schema)


def _sum_respondents(keys: Sequence[str], metrics: Sequence[str], n_weights: int, sets: Sequence[Sequence[str]],
                     schema: pa.Schema, max_held: int) -> Callable:
    """Task function: respondents in any order in, sums of the domains of every grouping set out.

    Only the domains of the sets are held. Those of a leading key that a whole chunk of respondents does not have are handed
    on, if all sets have it: rows laid out by it have passed them.
    """
    shape = [[k in names for k in keys] for names in sets]
    leading = all(s[0] for s in shape) if keys else False

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Sums] = {}
        for batch in chunks(batches, CHUNK_ROWS):
            order, found = runs(batch, keys)
            if leading:
                present = {key[0] for _, _, key in found}
                passed = {domain: sums for domain, sums in held.items() if domain[1] not in present}
                yield from _batches(passed, metrics, schema)
                held = {domain: sums for domain, sums in held.items() if domain[1] in present}
            weight = np.nan_to_num(matrix(batch.column("w"), n_weights), nan=0.0)[order]
            value = matrix(batch.column("x"), len(metrics))[order]
            given = ~np.isnan(value)
            # numerators and denominators in one product: first x (0 if not given), then given
            left = np.concatenate([np.where(given, value, 0.0), given], axis=1)
            low, high = np.where(given, value, np.inf), np.where(given, value, -np.inf)
            for start, end, key in found:
                if len(held) > max_held:
                    yield from _batches(held, metrics, schema)
                    held = {}
                rows = slice(start, end)
                sums = (given[rows].sum(0), low[rows].min(0), high[rows].max(0),
                        (left[rows].T @ weight[rows]).reshape(2, len(metrics), n_weights))
                for number, kept in enumerate(shape):
                    domain = (number, *[v if keep else None for v, keep in zip(key, kept)])
                    if domain in held:
                        held[domain].add(*sums)
                    else:
                        held[domain] = Sums(*sums)
        yield from _batches(held, metrics, schema)

    return run


def _partial_schema(key_fields: Sequence[T.StructField], width: int) -> tuple[str, pa.Schema]:
    """Names and types of what tasks hand on, for Spark and for Arrow."""
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    fields = [("set_id", "int"), *[(f.name, f.dataType.simpleString()) for f in key_fields], ("metric", "string"), ("n", "bigint"),
              *[(c, "double") for c in ("lo", "hi", *flat_names(width))]]
    return ", ".join(f"`{n}` {t}" for n, t in fields), pa.schema([pa.field(n, kinds[t]) for n, t in fields])


def grouped_sums(df: DataFrame, design: SurveyDesign, metrics: Sequence[str], keys: Sequence[str],
                 sets: Sequence[Sequence[str]] | None = None, max_held: int = MAX_HELD) -> DataFrame:
    """Flat sums of every metric for each grouping set of the keys.

    ``set_id`` numbers the sets in the order given; keys outside a set are null. Every task adds up its own respondents
    first, a chunk at a time, so the shuffle carries the domains that a task has respondents of, and a hot key is no larger
    than any other. No task sorts or holds its wide rows, so its memory is that of a chunk and of ``max_held`` sums. Tasks have
    fewest domains where the microdata is laid out by the first key; beyond ``max_held`` a domain is handed on more than once.
    """
    sets = [list(keys)] if sets is None else [list(s) for s in sets]
    width = len(design.columns)
    names, schema = _partial_schema([df.schema[k] for k in keys], width)
    rows = df.selectExpr(*[f"`{k}`" for k in keys], f"{_array(design.columns)} as w", f"{_array(metrics)} as x")
    partial = rows.mapInArrow(_sum_respondents(list(keys), list(metrics), width, sets, schema, max_held), names)
    return partial.groupBy("set_id", *keys, "metric").agg(*_added_up(width))


def cell_cube(df: DataFrame, design: SurveyDesign, metrics: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Cube at the finest keys, with its sums in arrays, fit to be kept as a table."""
    return packed(grouped_sums(df, design, metrics, keys).drop("set_id"), len(design.columns))


def roll_up(cube: DataFrame, design: SurveyDesign, keys: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Cube rows added up to grouping sets of their keys, as ``grouped_sums`` gives them."""
    width = len(design.columns)
    flat = flattened(cube.select(*keys, "metric", "n", "lo", "hi", "num", "den"), width)
    summed = flat.groupingSets([[F.col(c) for c in (*names, "metric")] for names in sets], *keys, "metric").agg(
        F.grouping_id().alias("_gaps"), *_added_up(width))
    number = None
    for i, names in enumerate(sets):
        # a bit for each key that the set leaves out, the last one for the metric
        gaps = sum(1 << (len(keys) - at) for at, k in enumerate(keys) if k not in names)
        number = (F if number is None else number).when(F.col("_gaps") == gaps, i)
    return summed.withColumn("set_id", number).selectExpr("set_id", *[f"`{k}`" for k in keys], "metric", "n", "lo", "hi", *flat_names(width))


def with_rest(domains: DataFrame, design: SurveyDesign, within: Sequence[str], item: str) -> DataFrame:
    """Add ``rest_*``: the sums over all other items with the same ``within``; all sums become arrays.

    The rest is what comes before plus what comes after the item, two window frames. Subtracting the item from the
    total instead would lose the digits of a small rest. Both frames grow by a row at a time, so the work is linear; a
    window has one row per population group or geography.
    """
    width = len(design.columns)
    names, flat = ["n", "lo", "hi"], flat_names(width)
    how = {"lo": ("min", "least"), "hi": ("max", "greatest")}
    keys = ", ".join(f"`{c}`" for c in (*within, "metric"))
    frames = [f"over (partition by {keys} order by `{item}` {order} rows between unbounded preceding and 1 preceding)" for order in ("asc", "desc")]
    sides = domains.selectExpr("*", *[f"{how.get(c, ('sum',))[0]}({c}) {frame} as _{i}_{c}" for i, frame in enumerate(frames) for c in (*names, *flat)])

    def both(name: str) -> str:
        before, after = f"_0_{name}", f"_1_{name}"
        return f"{how[name][1]}({before}, {after})" if name in how else f"coalesce({before}, 0) + coalesce({after}, 0)"

    gone = set(flat)
    return sides.selectExpr(
        *[f"`{c}`" for c in domains.columns if c not in gone], *[f"{both(c)} as rest_{c}" for c in names],
        *[f"{_array(value(f'{side}_{i}') for i in range(width))} as {prefix}{side}"
          for prefix, value in (("", str), ("rest_", both)) for side in ("num", "den")])
