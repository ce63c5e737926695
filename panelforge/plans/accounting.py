"""Accounting panel: book equity, profitability, last filing of a year, asset growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.scalars import ratio
from panelforge.operators.aggregates import keep_group_maximum
from panelforge.operators.windows import shift_year
from panelforge.sources.readers import raw_input

# Standard reporting format.
FORMAT = {"indfmt": "INDL", "datafmt": "STD", "consol": "C"}
REQUIRED = (
    "gvkey", "datadate", *FORMAT, "seq", "ceq", "at", "lt", "txditc", "txdb", "itcb", "pstkrv", "pstkl", "pstk", "sale", "cogs", "xsga", "xint",
)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def standard_format(filings: DataFrame) -> DataFrame:
    """Filings in the standard format, with all columns that the later steps need."""
    filings = raw_input(filings, REQUIRED, others=True)
    for column, wanted in FORMAT.items():
        filings = filings.where(F.col(column) == wanted)
    return filings


def book_equity() -> Column:
    """Shareholder equity plus deferred taxes minus preferred stock, each from the first known source."""
    equity = F.coalesce(F.col("seq"), F.col("ceq") + F.col("pstk"), F.col("at") - F.col("lt"))
    taxes = F.coalesce(F.col("txditc"), F.col("txdb") + F.col("itcb"), F.lit(0.0))
    preferred = F.coalesce(F.col("pstkrv"), F.col("pstkl"), F.col("pstk"), F.lit(0.0))
    value = equity + taxes - preferred
    return F.when(value > 0, value)


def operating_profitability() -> Column:
    return ratio(F.col("sale") - _or_zero("cogs") - _or_zero("xsga") - _or_zero("xint"), F.col("be"))


def with_equity(filings: DataFrame) -> DataFrame:
    return filings.withColumn("be", book_equity()).withColumn("op", operating_profitability())


def last_filing_per_year(filings: DataFrame) -> DataFrame:
    return keep_group_maximum(filings.withColumn("year", F.year("datadate")), "datadate", ["gvkey", "year"])


def asset_growth(yearly: DataFrame) -> DataFrame:
    """Growth over the previous calendar year; the table has one row per (gvkey, year)."""
    lagged = yearly.withColumn("at_lag", shift_year("at", "gvkey", "year", 1))
    growth = F.col("at") / F.nullif(F.col("at_lag"), F.lit(0.0)) - 1
    return lagged.withColumn("inv", F.when(F.col("at_lag") > 0, growth))


def accounting_panel(filings: DataFrame) -> DataFrame:
    """One row per (gvkey, year) with ``be``, ``op``, ``at_lag`` and ``inv``."""
    return asset_growth(last_filing_per_year(with_equity(standard_format(filings))))
