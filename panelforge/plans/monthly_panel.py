"""Clean monthly security panel from returns, name history, delistings, links and factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import month_of
from panelforge.functions.scalars import floor_at, zero_to_null
from panelforge.operators.joins import join_validity, period_lookup
from panelforge.operators.windows import lag_month
from panelforge.sources.readers import raw_input

# Share codes of common stock, exchange codes, industry ranges of SIC codes, delisting codes.
COMMON_SHARE_CODES = (10, 11)
EXCHANGES = {"NYSE": (1, 31), "AMEX": (2, 32), "NASDAQ": (3, 33)}
INDUSTRIES = {
    "Agriculture": (1, 999),
    "Mining": (1000, 1499),
    "Construction": (1500, 1799),
    "Manufacturing": (2000, 3999),
    "Transportation": (4000, 4899),
    "Utilities": (4900, 4999),
    "Wholesale": (5000, 5199),
    "Retail": (5200, 5999),
    "Finance": (6000, 6799),
    "Services": (7000, 8999),
    "Public": (9000, 9999),
}
PERFORMANCE_DELISTING_CODES = (500, 520, 580, 584)
PERFORMANCE_DELISTING_RANGE = (551, 574)
PERFORMANCE_DELISTING_RETURN = -0.30
LINK_TYPES = ("LU", "LC")
LINK_PRIMARY = ("P", "C")


def market_cap(shares_thousand: Column, price: Column) -> Column:
    """Capitalisation in millions; prices may be negative quotes, zero means unknown."""
    return zero_to_null(F.abs(shares_thousand * 1000 * price) / 1e6)


def classify_exchange(code: Column) -> Column:
    label = F
    for name, codes in EXCHANGES.items():
        label = label.when(code.isin(*codes), name)
    return label.otherwise("Other")


def classify_industry(sic: Column) -> Column:
    label = F
    for name, (low, high) in INDUSTRIES.items():
        label = label.when(sic.between(low, high), name)
    return label.otherwise("Missing")


def delisting_adjusted_return(ret: Column, delisting_return: Column, code: Column) -> Column:
    performance = code.isin(*PERFORMANCE_DELISTING_CODES) | code.between(*PERFORMANCE_DELISTING_RANGE)
    return (
        F.when(code.isNull(), ret)
        .when(delisting_return.isNotNull(), delisting_return)
        .when(performance, PERFORMANCE_DELISTING_RETURN)
        .when(code == 100, ret)
        .otherwise(-1.0)
    )


def valid_names(returns: DataFrame, names: DataFrame) -> DataFrame:
    """Returns of common stock inside a name record, with the record's codes attached."""
    common = names.where(F.col("shrcd").isin(*COMMON_SHARE_CODES)).select("permno", "exchcd", "siccd", "namedt", "nameendt")
    return join_validity(returns, common, "permno", "date", "namedt", "nameendt").drop("namedt", "nameendt")


def delistings_by_month(delistings: DataFrame) -> DataFrame:
    """The delisting record of each security and month, the latest where a month has several."""
    last = F.max_by(F.struct("dlret", "dlstcd"), F.struct("dlstdt", "dlstcd", "dlret")).alias("d")
    return delistings.groupBy("permno", month_of("dlstdt").alias("month")).agg(last).select("permno", "month", "d.*")


def add_excess_return(df: DataFrame, risk_free: DataFrame, period: str, ret: str = "ret") -> DataFrame:
    """Return over the risk-free rate, floored at -1; unknown when either side is unknown."""
    rates = period_lookup(risk_free.select(period, "rf"), period)
    return df.join(rates, period, "left").withColumn("ret_excess", floor_at(F.col(ret) - F.col("rf"), -1.0)).drop("rf")


def classified_returns(returns: DataFrame, names: DataFrame, delistings: DataFrame) -> DataFrame:
    """Monthly returns with size, lagged size, classifications and delisting-adjusted return (no row filter)."""
    returns = raw_input(returns, ("permno", "date", "ret", "shrout", "altprc"))
    exits = delistings_by_month(raw_input(delistings, ("permno", "dlstdt", "dlret", "dlstcd")))
    panel = valid_names(returns.withColumn("month", month_of("date")), raw_input(names, ("permno", "shrcd", "exchcd", "siccd", "namedt", "nameendt")))
    panel = panel.join(exits, ["permno", "month"], "left")
    panel = panel.withColumn("mktcap", market_cap(F.col("shrout"), F.col("altprc")))
    panel = panel.withColumn("mktcap_lag", lag_month("mktcap", "permno", "month"))
    return panel.withColumns(
        {
            "exchange": classify_exchange(F.col("exchcd")),
            "industry": classify_industry(F.col("siccd")),
            "ret_adj": delisting_adjusted_return(F.col("ret"), F.col("dlret"), F.col("dlstcd")),
        }
    )


def monthly_panel(returns: DataFrame, names: DataFrame, delistings: DataFrame, factors: DataFrame) -> DataFrame:
    """Panel keyed by (permno, month) with complete excess return, size and lagged size."""
    panel = classified_returns(returns, names, delistings)
    panel = add_excess_return(panel, factors, "month", "ret_adj")
    return panel.dropna(subset=["ret_excess", "mktcap", "mktcap_lag"]).select(
        "permno", "date", "month", "ret", "shrout", "altprc", "exchcd", "siccd",
        "mktcap", "mktcap_lag", "exchange", "industry", "ret_excess",
    )


def valid_links(links: DataFrame, as_of: str) -> DataFrame:
    """Usable security-to-firm links; open ends run to ``as_of``."""
    return links.where(
        F.col("linktype").isin(*LINK_TYPES) & F.col("linkprim").isin(*LINK_PRIMARY) & (F.col("usedflag") == 1) & F.col("gvkey").isNotNull()
    ).select(
        F.col("lpermno").alias("permno"), "gvkey", "linkdt", F.coalesce("linkenddt", F.lit(as_of).cast("date")).alias("linkenddt")
    )


def link_entities(panel: DataFrame, links: DataFrame, as_of: str) -> DataFrame:
    """Attach ``gvkey`` where a link covers the observation date; several valid links give several rows."""
    linked = join_validity(panel, valid_links(links, as_of), "permno", "date", "linkdt", "linkenddt", how="left")
    return linked.drop("linkdt", "linkenddt")


def overlapping_links(panel: DataFrame, links: DataFrame, as_of: str) -> DataFrame:
    """Observations covered by more than one link, to be inspected before linking."""
    matched = join_validity(panel.select("permno", "date"), valid_links(links, as_of), "permno", "date", "linkdt", "linkenddt")
    return matched.groupBy("permno", "date").agg(F.count(F.lit(1)).alias("links")).where("links > 1")
