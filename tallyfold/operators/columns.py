"""Column-set operators: names, prefixes, types, templates."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snake(name: str) -> str:
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"[^0-9a-zA-Z]+", "_", spaced).strip("_").lower()


def snake_case(df: DataFrame) -> DataFrame:
    """Rename every column to snake case, but for those that begin with one; two columns must not meet in one name."""
    names = [c if c.startswith("_") else snake(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns meet in one name: {clashes}")
    return df.toDF(*names)


def by_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    skip = set(skip)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def across(names: Iterable[str], fn: Callable[[Column], Column], template: str = "{}") -> list[Column]:
    """Apply one expression to many columns, naming the results by a template."""
    return [fn(F.col(n)).alias(template.format(n)) for n in names]


def text_to_double(names: Iterable[str], fill: float | None = None) -> dict[str, Column]:
    """Numbers held as text; what is not a number becomes null, or ``fill``."""
    out = {n: F.col(n).try_cast("double") for n in names}
    return out if fill is None else {n: F.coalesce(c, F.lit(fill)) for n, c in out.items()}
