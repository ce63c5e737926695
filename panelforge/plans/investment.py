"""Investment panel and its regressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import month_of
from panelforge.operators.aggregates import summarize
from panelforge.operators.fixed_effects import two_way_fit, within_fit
from panelforge.operators.regression import cluster_covariance, ols, winsorize
from panelforge.operators.reshape import to_long
from panelforge.operators.windows import shift_year
from panelforge.storage import materialize

MEASURES = ("investment_lead", "cash_flows", "tobins_q")
Y, XS = "investment_lead", ["cash_flows", "tobins_q"]


def investment_inputs(accounts: DataFrame, panel: DataFrame) -> DataFrame:
    """Next year's investment, cash flows and market-to-book of assets; complete rows only.

    Both year shifts are windows over one row per (gvkey, year), so they share one shuffle.
    """
    base = accounts.select("gvkey", "year", "datadate", "at", "be", "txdb", "capx", "oancf")
    lagged = base.withColumn("at_lag", shift_year("at", "gvkey", "year", 1)).where("at > 0 AND at_lag > 0")
    scaled = lagged.withColumns({"investment": F.col("capx") / F.col("at_lag"), "cash_flows": F.col("oancf") / F.col("at_lag")})
    led = scaled.withColumn("investment_lead", shift_year("investment", "gvkey", "year", -1))
    sized = led.withColumn("month", month_of("datadate")).join(panel.select("gvkey", "month", "mktcap"), ["gvkey", "month"], "left")
    q = (F.col("mktcap") + F.col("at") - F.col("be") + F.col("txdb")) / F.col("at")
    return sized.withColumn("tobins_q", q).select("gvkey", "year", *MEASURES).dropna()


def investment_panel(accounts: DataFrame, panel: DataFrame, cut: float = 0.01, **options) -> DataFrame:
    return winsorize(materialize(investment_inputs(accounts, panel), "investment"), MEASURES, cut, **options)


def panel_summary(investment: DataFrame, **options) -> DataFrame:
    long = to_long(investment.select(*MEASURES), [], MEASURES, "measure")
    return summarize(long, "value", ["measure"], **options)


def panel_regressions(investment: DataFrame) -> DataFrame:
    """Pooled, one-way and two-way effect models with iid and clustered errors, in long form.

    Absorbed parameters count as estimated ones, except, under clustering, effects that are nested in a cluster.
    """
    spark = investment.sparkSession
    data = materialize(investment.select("gvkey", "year", Y, *XS), "regression")
    pooled = ols(data, Y, XS)
    firm, firms = within_fit(data, Y, XS, "gvkey")
    both, residual, effects = two_way_fit(data, Y, XS, "gvkey", "year")
    k = len(XS)
    by_firm = cluster_covariance(residual, Y, both, ["gvkey"], estimated=k + effects.periods - effects.parts + 1)
    by_both = cluster_covariance(residual, Y, both, ["gvkey", "year"], estimated=k + 1)
    tables = [
        pooled.table(spark, pooled.iid(), "ols"),
        firm.table(spark, firm.iid(absorbed=firms), "fe_firm"),
        both.table(spark, both.iid(absorbed=effects.rank), "fe_firm_year"),
        both.table(spark, by_firm, "cluster_firm"),
        both.table(spark, by_both, "cluster_firm_year"),
    ]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
