"""Rounding and banding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.keys import _col


def to_units(value: Column | str, digits: int) -> Column:
    """A number as a whole count of 10^-digits, so sums no longer depend on their order."""
    return F.round(_col(value) * F.lit(float(10**digits))).cast("bigint")


def from_units(units: Column, digits: int) -> Column:
    return units.cast("double") / F.lit(float(10**digits))


def mean_units(total: Column, count: Column, scale: int, digits: int) -> Column:
    """Half-up mean of 10^-scale units as whole 10^-digits units; NULL for an empty group."""
    size = F.nullif(count, F.lit(0)) * F.lit(10 ** max(scale - digits, 0))
    # Twice the total times a power of ten can exceed a bigint; the mean itself does not.
    magnitude = F.abs(total).cast("decimal(30, 0)") * F.lit(10 ** max(digits - scale, 0))
    half_up = F.call_function("div", magnitude * 2 + size, size * 2)
    return F.when(total < 0, -half_up).otherwise(half_up)


def band(rules: list[tuple[Column, str]], default: str) -> Column:
    """First label whose condition holds; NULL conditions do not hold."""
    (condition, label), *rest = rules
    chain = F.when(condition, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(default)


def null_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), default if isinstance(default, Column) else F.lit(default))


def flag(condition: Column) -> Column:
    """True only where the condition is true; NULL counts as false."""
    return F.coalesce(condition, F.lit(False))
