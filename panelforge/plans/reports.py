"""Descriptive reports over the monthly panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.aggregates import distinct_share, keep_global_maximum, keep_group_maximum, summarize_with_overall
from panelforge.operators.aggregates import share_of_group as _share_of_group
from panelforge.operators.joins import period_lookup
from panelforge.operators.quantiles import broadcast_if_small, exact_quantiles, profile_groups
from panelforge.operators.reshape import to_long

# Labels and quantiles of the size classes.
SIZE_CLASSES = {
    "Largest 1% of stocks": 0.99,
    "Largest 5% of stocks": 0.95,
    "Largest 10% of stocks": 0.90,
    "Largest 25% of stocks": 0.75,
}


def securities_count(panel: DataFrame, by: str, date: str = "date") -> DataFrame:
    return panel.groupBy(by, date).agg(F.count(F.lit(1)).alias("n"))


def real_market_cap(panel: DataFrame, cpi: DataFrame, by: str) -> DataFrame:
    """Deflated capitalisation per month and group; each row is deflated before it is added."""
    deflated = panel.join(period_lookup(cpi.select("month", "cpi"), "month"), "month", "left")
    return deflated.groupBy("month", by).agg(F.sum(F.col("mktcap") / F.nullif("cpi", F.lit(0.0))).alias("mktcap"))


def industry_stats(panel: DataFrame, cpi: DataFrame) -> DataFrame:
    deflated = panel.join(period_lookup(cpi.select("month", "cpi"), "month"), "month", "left")
    return deflated.groupBy("month", "industry").agg(
        F.count_distinct("permno").alias("securities"), (F.sum("mktcap") / F.avg("cpi")).alias("mktcap")
    )


def book_equity_coverage(panel: DataFrame, accounts: DataFrame) -> DataFrame:
    """Share of securities with book equity by exchange and year, on the last observation of each year."""
    last = keep_group_maximum(panel.withColumn("year", F.year("month")), "date", ["permno", "year"])
    joined = last.join(accounts.select("gvkey", "year", "be"), ["gvkey", "year"], "left")
    return joined.groupBy("exchange", "year").agg(distinct_share("permno", F.col("be").isNotNull()).alias("share"))


def size_concentration(panel: DataFrame, size: str = "mktcap", period: str = "month", **options) -> DataFrame:
    """Share of total capitalisation held by the largest securities of each period."""
    known = panel.where(F.col(size).isNotNull()).select(period, size)
    profile = profile_groups(known, [period])
    limits = exact_quantiles(known, size, list(SIZE_CLASSES.values()), [period], "__q", profile=profile, **options)
    joined = known.join(broadcast_if_small(limits, profile.groups, len(SIZE_CLASSES)), period)
    shares = joined.groupBy(period).agg(
        *[
            (F.sum(F.when(F.col(size) >= F.col("__q")[i], F.col(size))) / F.nullif(F.sum(size), F.lit(0.0))).alias(label)
            for i, label in enumerate(SIZE_CLASSES)
        ]
    )
    return to_long(shares, [period], list(SIZE_CLASSES), "name", "value")


def exchange_share(panel: DataFrame) -> DataFrame:
    totals = panel.groupBy("month", "exchange").agg(F.sum("mktcap").alias("mktcap"))
    return _share_of_group(totals, "mktcap", ["month"], "share").select("month", "exchange", "share")


def size_summary(panel: DataFrame, **options) -> DataFrame:
    """Capitalisation in the last month by exchange and overall."""
    return summarize_with_overall(keep_global_maximum(panel, "month"), "mktcap", "exchange", **options)
