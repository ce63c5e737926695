"""Null-aware scalar expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_at(value: Column, bound: float) -> Column:
    """Row maximum with a constant; a missing value stays missing (plain ``greatest`` would return the bound)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(bound)))


def clip(value: Column, low: Column, high: Column) -> Column:
    """Clip above first, then below; a missing value stays missing."""
    capped = F.when(value > high, high).otherwise(value)
    return F.when(capped < low, low).otherwise(capped)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator, also in ANSI mode."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def zero_to_null(value: Column) -> Column:
    return F.when(value != 0, value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def finite(value: Column) -> Column:
    """NULL for NaN and infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def null_or(value: Column, predicate: Column) -> Column:
    """True where the value is missing or the predicate holds."""
    return value.isNull() | predicate


def text_to_number(value: Column) -> Column:
    return value.try_cast("double")
