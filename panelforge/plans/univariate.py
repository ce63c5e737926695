"""Sorts on one lagged signal and the performance of the resulting portfolios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import shift_months
from panelforge.operators.aggregates import weighted_mean
from panelforge.operators.hac import newey_west
from panelforge.operators.joins import period_lookup
from panelforge.operators.quantiles import broadcast_if_small, exact_quantiles, ntile, profile_groups
from panelforge.operators.regression import simple_fit
from panelforge.operators.reshape import to_long, to_wide


def lagged_signal(signals: DataFrame, signal: str, name: str) -> DataFrame:
    """Signal of month t-1 filed under month t."""
    moved = signals.select("permno", shift_months(F.col("month"), 1).alias("month"), F.col(signal).alias(name))
    return moved.where(F.col(name).isNotNull())


def sort_data(panel: DataFrame, signals: DataFrame, signal: str, name: str) -> DataFrame:
    return panel.select("permno", "month", "ret_excess", "mktcap_lag").join(lagged_signal(signals, signal, name), ["permno", "month"])


def portfolio_returns(assigned: DataFrame, by: Sequence[str], weight: str | None = "mktcap_lag") -> DataFrame:
    """Weighted excess return per portfolio and month; rows without return or weight do not count."""
    needed = ["ret_excess", *([weight] if weight else [])]
    return assigned.dropna(subset=needed).groupBy(*by).agg(weighted_mean("ret_excess", weight).alias("ret"))


def median_sort(data: DataFrame, signal: str, **options) -> DataFrame:
    """Two portfolios per month: up to the median and above it."""
    profile = profile_groups(data, ["month"])
    medians = exact_quantiles(data, signal, [0.5], ["month"], "__m", profile=profile, **options)
    joined = data.join(broadcast_if_small(medians, profile.groups), "month")
    side = F.when(F.col(signal) <= F.col("__m")[0], "low").when(F.col(signal) > F.col("__m")[0], "high")
    return portfolio_returns(joined.withColumn("portfolio", side), ["month", "portfolio"])


def decile_sort(data: DataFrame, signal: str, n: int = 10, **options) -> DataFrame:
    """``n`` equal-count portfolios per month, ties ordered by security."""
    return portfolio_returns(ntile(data, signal, n, ["month"], "permno", **options), ["portfolio", "month"])


def long_short(portfolios: DataFrame, low="low", high="high") -> DataFrame:
    """High minus low portfolio per month; ``low`` and ``high`` are values of ``portfolio``."""
    legs = portfolios.where(F.col("portfolio").isin(low, high))
    legs = legs.withColumn("portfolio", F.when(F.col("portfolio") == high, "high").otherwise("low"))
    wide = to_wide(legs, ["month"], "portfolio", "ret", ["low", "high"])
    return wide.withColumn("long_short", F.col("high") - F.col("low"))


def long_short_extremes(portfolios: DataFrame) -> DataFrame:
    """Highest minus lowest portfolio that each month has; a month with one portfolio has no low leg."""
    low, high = F.min("portfolio"), F.max("portfolio")
    wide = portfolios.groupBy("month").agg(
        F.when(low < high, F.min_by("ret", "portfolio")).alias("low"), F.max_by("ret", "portfolio").alias("high")
    )
    return wide.withColumn("long_short", F.col("high") - F.col("low"))


def with_factors(df: DataFrame, factors: DataFrame) -> DataFrame:
    return df.join(period_lookup(factors, "month"), "month", "left")


def capm_performance(portfolios: DataFrame, factors: DataFrame) -> DataFrame:
    """Alpha, beta and mean return of each portfolio."""
    joined = with_factors(portfolios, factors.select("month", "mkt_excess"))
    fit = joined.groupBy("portfolio").agg(*simple_fit("ret", "mkt_excess"), F.avg("ret").alias("ret"))
    return fit.select("portfolio", F.col("intercept").alias("alpha"), F.col("slope").alias("beta"), "ret")


def market_line(performance: DataFrame) -> DataFrame:
    """Regression of mean returns on betas across portfolios."""
    return performance.agg(*simple_fit("ret", "beta")).select("intercept", "slope", "n")


def long_short_test(spread: DataFrame, factors: DataFrame | None = None, lag: int | None = None, prewhite: bool = True) -> DataFrame:
    """HAC test of the mean spread, or of its alpha when factors are given."""
    if factors is None:
        return newey_west(spread, "long_short", [], lag=lag, prewhite=prewhite)
    return newey_west(with_factors(spread, factors.select("month", "mkt_excess")), "long_short", ["mkt_excess"], lag=lag, prewhite=prewhite)


def annual_compound(spread: DataFrame) -> DataFrame:
    """Compounded yearly return of each leg and of the spread."""
    legs = ["low", "high", "long_short"]
    yearly = spread.groupBy(F.year("month").alias("year")).agg(*[(F.product(1 + F.col(c)) - 1).alias(c) for c in legs])
    return to_long(yearly, ["year"], legs)
