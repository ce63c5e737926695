"""Returns, volumes and distributions from price series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import month_of
from panelforge.operators.aggregates import keep_full_history, moments
from panelforge.operators.quantiles import exact_quantiles
from panelforge.operators.windows import lag_row


def simple_returns(prices: DataFrame, price: str = "adjusted") -> DataFrame:
    """Price over previous price minus one; the first row of a symbol is dropped."""
    ret = F.col(price) / F.nullif(lag_row(price, ["symbol"], "date"), F.lit(0.0)) - 1
    return prices.select("symbol", "date", ret.alias("ret")).dropna(subset=["ret"])


def return_stats(returns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, deviation and extremes of returns in percent."""
    percent = returns.withColumn("ret", F.col("ret") * 100)
    return percent.groupBy(*by).agg(*moments("ret", "daily_{fn}"))


def return_tail(returns: DataFrame, prob: float = 0.05, **options) -> DataFrame:
    percent = returns.select((F.col("ret") * 100).alias("ret"))
    return exact_quantiles(percent, "ret", [prob], (), "__q", **options).select(F.col("__q")[0].alias("quantile"))


def return_histogram(returns: DataFrame, bins: int = 100) -> DataFrame:
    """Count of returns in percent over ``bins`` equal intervals between the extremes."""
    percent = returns.select((F.col("ret") * 100).alias("ret"))
    span = percent.agg(F.min("ret").alias("low"), F.max("ret").alias("high")).first()
    if span["low"] is None:
        return percent.select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (span["high"] - span["low"]) / bins
    position = F.lit(0) if width == 0 else F.least(F.floor((F.col("ret") - span["low"]) / width), F.lit(bins - 1))
    return percent.groupBy(position.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def aggregate_volume(prices: DataFrame) -> DataFrame:
    """Dollar volume per date in billions and that of the previous date.

    The volume table has one row per date, so its unpartitioned window is bounded by the calendar.
    """
    daily = prices.groupBy("date").agg(F.sum(F.col("volume") * F.col("close") / 1e9).alias("volume"))
    return daily.withColumn("volume_lag", lag_row("volume", [], "date"))


def balanced_panel(prices: DataFrame) -> DataFrame:
    return keep_full_history(prices, "symbol")


def month_end_returns(prices: DataFrame) -> DataFrame:
    """Return between the last prices of consecutive observed months."""
    monthly = prices.groupBy("symbol", month_of("date").alias("month")).agg(F.max_by("adjusted", "date").alias("price"))
    ret = F.col("price") / F.nullif(lag_row("price", ["symbol"], "month"), F.lit(0.0)) - 1
    return monthly.select("symbol", "month", ret.alias("ret")).dropna(subset=["ret"])
