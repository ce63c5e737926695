"""Book-to-market and sorts on two characteristics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import month_of, shift_months
from panelforge.functions.scalars import ratio
from panelforge.operators.windows import fill_down, lag_month
from panelforge.plans.size_sorts import assign_portfolio

REPORTING_LAG = 6
MAX_AGE = 12


def book_to_market(accounts: DataFrame, panel: DataFrame) -> DataFrame:
    """Book equity over same-month capitalisation, usable six months later."""
    equity = accounts.select("gvkey", "datadate", "be").dropna().withColumn("month", month_of("datadate"))
    joined = equity.join(panel.select("month", "permno", "gvkey", "mktcap"), ["gvkey", "month"])
    usable = shift_months(F.col("month"), REPORTING_LAG)
    return joined.select("permno", "gvkey", usable.alias("sorting_date"), usable.alias("comp_date"), ratio(F.col("be"), F.col("mktcap")).alias("bm"))


def sorting_panel(panel: DataFrame, book: DataFrame) -> DataFrame:
    """Returns with last month's size and the latest book-to-market not older than twelve months.

    The panel has one row per (security, month), so the carry-forward window is bounded by the calendar.
    """
    sized = panel.withColumn("me", lag_month("mktcap", "permno", "month")).where(F.col("gvkey").isNotNull())
    joined = sized.join(book.withColumnRenamed("sorting_date", "month"), ["permno", "gvkey", "month"], "left")
    entity = ["permno", "gvkey"]
    carried = joined.withColumns({"bm": fill_down("bm", entity, "month"), "comp_date": fill_down("comp_date", entity, "month")})
    fresh = carried.where(F.col("comp_date") > shift_months(F.col("month"), -MAX_AGE))
    return fresh.select("permno", "gvkey", "month", "ret_excess", "mktcap_lag", "me", "bm", "exchange").dropna()


def cell_returns(assigned: DataFrame) -> DataFrame:
    """Size-weighted return of each cell."""
    total = F.nullif(F.sum("mktcap_lag"), F.lit(0.0))
    return assigned.groupBy("month", "portfolio_me", "portfolio_bm").agg((F.sum(F.col("ret_excess") * F.col("mktcap_lag")) / total).alias("ret"))


def double_sort_independent(data: DataFrame, n: int = 5, exchanges: Sequence[str] = ("NYSE",), **options) -> DataFrame:
    """Both sorts over all securities of a month."""
    by_value = assign_portfolio(data, "bm", n, ["month"], exchanges, "portfolio_bm", **options)
    return cell_returns(assign_portfolio(by_value, "me", n, ["month"], exchanges, "portfolio_me", **options))


def double_sort_dependent(data: DataFrame, n: int = 5, exchanges: Sequence[str] = ("NYSE",), **options) -> DataFrame:
    """Value sorted within each size bucket of a month."""
    by_size = assign_portfolio(data, "me", n, ["month"], exchanges, "portfolio_me", **options)
    return cell_returns(assign_portfolio(by_size, "bm", n, ["month", "portfolio_me"], exchanges, "portfolio_bm", **options))


def monthly_value_premium(cells: DataFrame) -> DataFrame:
    """High minus low value bucket after averaging over size buckets."""
    legs = cells.groupBy("month", "portfolio_bm").agg(F.avg("ret").alias("ret"))
    spread = F.max_by("ret", "portfolio_bm") - F.min_by("ret", "portfolio_bm")
    return legs.groupBy("month").agg(spread.alias("value_premium"))


def value_premium(cells: DataFrame) -> DataFrame:
    return monthly_value_premium(cells).agg(F.avg("value_premium").alias("value_premium"))
