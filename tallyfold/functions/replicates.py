"""Replicate-weight statistics over arrays whose first element is the base estimate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold import codebook as cb


@dataclass(frozen=True)
class SurveyDesign:
    """Weight columns of a microdata frame and how replicate spread becomes variance.

    Variance is ``scale`` times the squared distances of the replicate estimates
    from the base estimate. Reported errors are ``se_factor`` times its root:
    2 * sqrt(1/R * ...) equals the 4/R of the replication method.
    """

    weight: str
    replicates: tuple[str, ...]
    se_factor: float = 2.0

    @property
    def scale(self) -> float:
        return 1.0 / len(self.replicates)

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.weight, *self.replicates)

    @classmethod
    def of(cls, n: int = 80, prefix: str = "pweight") -> SurveyDesign:
        return cls(prefix, tuple(f"{prefix}{r}" for r in range(1, n + 1)))


def ratios(num: Column, den: Column) -> Column:
    """Element-wise num/den, null on an empty denominator."""
    return F.zip_with(num, den, lambda a, b: F.try_divide(a, b))


def differences(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a - b)


def base(theta: Column) -> Column:
    return F.get(theta, F.lit(0))


def spread_se(theta: Column, design: SurveyDesign, factor: float | None = None) -> Column:
    """Standard error from the spread of replicates around the base estimate."""
    factor = design.se_factor if factor is None else factor
    total = F.aggregate(
        F.slice(theta, 2, len(design.replicates)),
        F.lit(0.0),
        lambda acc, t: acc + (t - base(theta)) * (t - base(theta)),
    )
    return F.lit(factor) * F.sqrt(F.lit(design.scale) * total)


def significance(diff: Column, se: Column, z: float = cb.Z_95) -> Column:
    """1 if the difference exceeds z errors. No error and a difference is 1; neither is null."""
    return F.when(se == 0, F.when(diff != 0, 1.0)).otherwise((F.abs(diff / F.nullif(se, F.lit(0.0))) > z).cast("double"))


def confidence(mean: Column, se: Column, z: float = cb.Z_95) -> dict[str, Column]:
    return {"moe_95": se * z, "moe_95_lb": mean - se * z, "moe_95_ub": mean + se * z}


def tidy(value: Column, digits: int = 6) -> Column:
    """Round for comparison across engines; a negative zero becomes zero."""
    return F.round(value, digits) + F.lit(0.0)
