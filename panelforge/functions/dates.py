"""Calendar expressions over DATE columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_of(date: Column | str) -> Column:
    return F.trunc(date, "month")


def quarter_of(date: Column | str) -> Column:
    return F.trunc(date, "quarter")


def shift_months(date: Column | str, months: int) -> Column:
    """Calendar shift; a day past the end of the target month becomes its last day."""
    return F.add_months(date, months)


def months_apart(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def month_index(date: Column | str) -> Column:
    """Months counted from year 0: consecutive months differ by one."""
    return F.year(date) * 12 + F.month(date)


def month_at(index: Column | str) -> Column:
    """The first day of the month with a ``month_index``."""
    place = (F.col(index) if isinstance(index, str) else index) - 1
    return F.make_date(F.floor(place / 12).cast("int"), (F.pmod(place, F.lit(12)) + 1).cast("int"), F.lit(1))


def parse_yyyymm(value: Column) -> Column:
    """First day of the month in a yyyymm number or text, by arithmetic rather than text formats."""
    number = value.cast("int")
    return F.make_date(F.floor(number / 100).cast("int"), number % 100, F.lit(1))


def parse_yyyymmdd(value: Column) -> Column:
    number = value.cast("int")
    return F.make_date(F.floor(number / 10_000).cast("int"), F.floor(number / 100).cast("int") % 100, number % 100)


def period_grid(spark, start: str, end: str, months: int, name: str = "date") -> DataFrame:
    """Every ``months``-th month from ``start`` up to ``end``."""
    return spark.sql(
        f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL {int(months)} MONTH)) AS {name}"
    )
