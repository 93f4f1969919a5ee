"""Small column expressions shared by the operators."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """0/1 integer from a condition; null counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def one_hot(column: str, value: str) -> Column:
    return flag(F.col(column).eqNullSafe(F.lit(value)))


def cyclical(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of the given period."""
    angle = value * F.lit(2 * pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def safe_divide(numerator: Column, denominator: Column, fill: float = 0.0) -> Column:
    """Quotient, ``fill`` where the denominator is zero; nulls stay null."""
    return F.when(
        denominator != 0, numerator.cast("double") / denominator
    ).when(denominator == 0, F.lit(float(fill)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Like :func:`safe_divide`, with null read as zero on both sides."""
    return F.coalesce(safe_divide(numerator, denominator), F.lit(0.0))


def clip(value: Column, low: Column, high: Column) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))
