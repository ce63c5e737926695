"""Factor, macro and price-index tables brought into panel form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.dates import month_of, parse_yyyymm, parse_yyyymmdd
from panelforge.functions.scalars import text_to_number
from panelforge.operators.aggregates import rescale_to_last
from panelforge.operators.joins import one_row_per
from panelforge.operators.reshape import map_columns, numeric_columns, rename_all, text_columns

# Column names of the published factor files and of the derived tables.
THREE_FACTORS = {"RF": "rf", "Mkt-RF": "mkt_excess", "SMB": "smb", "HML": "hml"}
FIVE_FACTORS = THREE_FACTORS | {"RMW": "rmw", "CMA": "cma"}
Q_PREFIX, Q_RENAMED = "R_", {"f": "rf", "mkt": "mkt_excess"}
MACRO_COLUMNS = (
    "month", "rp_div", "dp", "dy", "ep", "de", "svar", "bm", "ntis", "tbl", "lty", "ltr", "tms", "dfy", "infl",
)


def between_dates(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    return df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def _factors(raw: DataFrame, names: dict[str, str], period: str, parse: Callable[[Column], Column], start: str, end: str) -> DataFrame:
    rates = [(text_to_number(F.col(f"`{old}`").cast("string")) / 100).alias(new) for old, new in names.items()]
    return between_dates(raw.select(parse(F.col("date")).alias(period), *rates), period, start, end)


def monthly_factors(raw: DataFrame, start: str, end: str, names: dict[str, str] = THREE_FACTORS) -> DataFrame:
    """Percent factors keyed by yyyymm to decimals keyed by month."""
    return _factors(raw, names, "month", parse_yyyymm, start, end)


def daily_factors(raw: DataFrame, start: str, end: str, names: dict[str, str] = THREE_FACTORS) -> DataFrame:
    return _factors(raw, names, "date", parse_yyyymmdd, start, end)


def industry_portfolios(raw: DataFrame, start: str, end: str) -> DataFrame:
    """All numeric portfolio columns from percent to decimals."""
    dated = raw.withColumn("month", parse_yyyymm(F.col("date"))).drop("date")
    scaled = map_columns(dated, numeric_columns(dated), lambda c: c / 100)
    return between_dates(scaled.select("month", *[F.col(f"`{c}`") for c in scaled.columns if c != "month"]), "month", start, end)


def q_factors(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Year and month columns to a date; the name prefix is removed and the rest lower-cased."""
    dated = raw.select(F.make_date("year", "month", F.lit(1)).alias("month"), *[c for c in raw.columns if c not in ("year", "month")])
    named = rename_all(dated, lambda c: c.removeprefix(Q_PREFIX).lower()).withColumnsRenamed(Q_RENAMED)
    return between_dates(map_columns(named, [c for c in named.columns if c != "month"], lambda c: c / 100), "month", start, end)


def macro_predictors(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Return predictors from a monthly sheet.

    The sheet is one series, so its unpartitioned window is bounded by the number of months; the window runs before
    the date filter.
    """
    sheet = map_columns(raw, [c for c in text_columns(raw) if c != "yyyymm"], text_to_number)
    sheet = one_row_per(sheet, "yyyymm").withColumn("month", parse_yyyymm(F.col("yyyymm")))
    time = Window.orderBy("month")
    with_dividends = F.ln(F.col("Index") + F.col("D12"))
    sheet = sheet.withColumns(
        {"__logret": with_dividends - F.lag(with_dividends).over(time), "__rfree": F.ln(F.col("Rfree") + 1), "__prev": F.lag("Index").over(time)}
    )
    out = sheet.withColumns(
        {
            "rp_div": F.lead(F.col("__logret") - F.col("__rfree")).over(time),
            "dp": F.ln("D12") - F.ln("Index"),
            "dy": F.ln("D12") - F.ln("__prev"),
            "ep": F.ln("E12") - F.ln("Index"),
            "de": F.ln("D12") - F.ln("E12"),
            "bm": F.col("`b/m`"),
            "tms": F.col("lty") - F.col("tbl"),
            "dfy": F.col("BAA") - F.col("AAA"),
        }
    )
    return between_dates(out, "month", start, end).select(*MACRO_COLUMNS).dropna()


def deflator(prices: DataFrame) -> DataFrame:
    """Price index by month, scaled to one in the last month."""
    monthly = prices.select(month_of("date").alias("month"), F.col("price").alias("cpi"))
    return rescale_to_last(monthly, "cpi", "month")
