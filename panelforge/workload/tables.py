"""Raw inputs and panels derived from the driver tables.

Every table here has a twin in ``tables_sql``.  Amounts are summed in whole units of their last decimal, so both
engines start from bit-identical doubles whatever the order of addition.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.dates import month_index
from panelforge.plans import accounting, betas, value_sorts
from panelforge.plans.daily_panel import daily_panel
from panelforge.plans.monthly_panel import link_entities, monthly_panel
from panelforge.sources import factors as factor_tables
from panelforge.sources.schemas import DRIVER
from panelforge.storage import materialize

START, END = "1995-01-01", "2001-12-31"
AS_OF = "2001-12-31"
TRADE_START, TRADE_END = "2010-01-01", "2013-12-31"
INDUSTRY_COLUMNS = ("NoDur", "Durbl", "Manuf", "Enrgy", "HiTec", "Telcm", "Shops", "Hlth", "Utils", "Other")
DAILY_MIN_OBS = 15


def _units(amount: str, per_unit: int):
    """Whole smallest units of an amount, so that sums are exact in any order."""
    return F.expr(f"floor(({amount}) * {per_unit} + 0.5D)")


class Tables:
    """Lazy tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def driver(self, name: str) -> DataFrame:
        return self.spark.read.schema(DRIVER[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    # -- aggregates of lineitem ------------------------------------------------------------------------------

    def _traded(self, *by: str) -> DataFrame:
        rows = self.driver("lineitem").select(
            F.col("l_suppkey").cast("int").alias("permno"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.trunc("l_shipdate", "month").alias("month"),
            "l_quantity", "l_extendedprice", "l_discount",
        )
        return rows.groupBy(*by).agg(
            F.max("date").alias("last_date"),
            F.sum("l_quantity").alias("qty"),
            (F.sum(_units("l_extendedprice", 100)) / 100).alias("vol"),
            (F.sum(_units("l_extendedprice * l_discount", 10_000)) / 10_000).alias("disc"),
            F.max("l_extendedprice").alias("top"),
        )

    @cached_property
    def monthly_trade(self) -> DataFrame:
        return self._traded("permno", "month").withColumns(
            {"mi": month_index("month"), "r": F.expr("disc / vol - 0.05D")}
        )

    @cached_property
    def daily_trade(self) -> DataFrame:
        return self._traded("permno", "date").withColumns(
            {"mi": month_index("date"), "r": F.expr("disc / vol - 0.05D")}
        )

    @cached_property
    def stored_monthly(self) -> DataFrame:
        """Monthly aggregates written once, for plans in which returns and factors read them several times."""
        return materialize(self.monthly_trade.drop("top", "disc"), "monthly-trade")

    @cached_property
    def stored_daily(self) -> DataFrame:
        return materialize(self.daily_trade.select("permno", "date", "mi", "r"), "daily-trade")

    # -- raw security tables ---------------------------------------------------------------------------------

    @cached_property
    def msf(self) -> DataFrame:
        return self.stored_monthly.where("(permno * 13 + mi) % 61 <> 0").selectExpr(
            "permno", "last_date AS date",
            "CASE WHEN (permno * 7 + mi) % 53 <> 0 THEN r END AS ret",
            "CASE WHEN (permno * 31 + mi) % 97 = 0 THEN 0.0D ELSE qty END AS shrout",
            "CASE WHEN (permno + mi) % 11 = 0 THEN -vol / qty ELSE vol / qty END AS altprc",
        )

    @cached_property
    def dsf(self) -> DataFrame:
        return self.stored_daily.selectExpr("permno", "date", "CASE WHEN (permno * 7 + mi + day(date)) % 53 <> 0 THEN r END AS ret")

    @cached_property
    def names(self) -> DataFrame:
        cut = "date_add(DATE'1997-01-01', CAST(s_suppkey * 97 % 1400 AS INT))"
        both = self.driver("supplier").selectExpr("s_suppkey", "s_nationkey", f"{cut} AS cut", "explode(array(1, 2)) AS rec")
        return both.selectExpr(
            "CAST(s_suppkey AS INT) AS permno",
            "CAST(CASE WHEN s_suppkey % 9 = 8 THEN 12 ELSE 10 + s_suppkey % 2 END AS INT) AS shrcd",
            "CASE s_nationkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 31 WHEN 4 THEN 32 WHEN 5 THEN 33 WHEN 6 THEN 4 END AS exchcd",
            "CAST(CASE WHEN s_suppkey % 13 <> 0 THEN (s_suppkey * 97 + rec * 1500) % 10000 END AS INT) AS siccd",
            "CASE rec WHEN 1 THEN DATE'1995-01-01' WHEN 2 THEN date_add(cut, CASE WHEN s_suppkey % 10 = 7 THEN 40 ELSE 1 END) END AS namedt",
            "CASE rec WHEN 1 THEN cut ELSE DATE'2001-12-31' END AS nameendt",
        )

    @cached_property
    def delistings(self) -> DataFrame:
        return self.driver("supplier").where("s_suppkey % 5 = 0").selectExpr(
            "CAST(s_suppkey AS INT) AS permno",
            "date_add(DATE'2000-01-01', CAST(s_suppkey * 37 % 600 AS INT)) AS dlstdt",
            "CASE WHEN s_suppkey % 10 <> 0 THEN -CAST(s_suppkey % 7 + 10 AS DOUBLE) / 100 END AS dlret",
            "CASE (s_suppkey DIV 10) % 6 WHEN 0 THEN 100 WHEN 1 THEN 500 WHEN 2 THEN 520 WHEN 3 THEN 560 WHEN 4 THEN 200 ELSE 574 END AS dlstcd",
        )

    @cached_property
    def links(self) -> DataFrame:
        cut = "date_add(DATE'1998-01-01', CAST(s_suppkey * 53 % 700 AS INT))"
        both = self.driver("supplier").selectExpr("s_suppkey", f"{cut} AS cut", "explode(array(1, 2, 3)) AS rec")
        return both.selectExpr(
            "CAST(s_suppkey AS INT) AS lpermno",
            "concat('G', CASE WHEN rec = 3 THEN s_suppkey + 1 ELSE s_suppkey END) AS gvkey",
            "CASE WHEN rec = 3 THEN 'LX' WHEN s_suppkey % 2 = 0 THEN 'LU' ELSE 'LC' END AS linktype",
            "CASE WHEN s_suppkey % 17 = 16 THEN 'N' WHEN s_suppkey % 3 = 0 THEN 'C' ELSE 'P' END AS linkprim",
            "CASE WHEN s_suppkey % 19 = 18 THEN 0 ELSE 1 END AS usedflag",
            "CASE rec WHEN 2 THEN date_add(cut, 1) ELSE DATE'1994-01-01' END AS linkdt",
            "CASE rec WHEN 1 THEN cut END AS linkenddt",
        )

    @cached_property
    def prices(self) -> DataFrame:
        rows = self.driver("lineitem").select(
            F.col("l_suppkey"), F.col("l_shipdate").cast("date").alias("date"), "l_quantity", "l_extendedprice"
        )
        nations = self.driver("supplier").selectExpr("s_suppkey AS l_suppkey", "concat('N', s_nationkey) AS symbol")
        grouped = rows.join(nations, "l_suppkey").groupBy("symbol", "date").agg(
            F.sum("l_quantity").alias("volume"), (F.sum(_units("l_extendedprice", 100)) / 100).alias("vol"), F.max("l_extendedprice").alias("close")
        )
        return grouped.selectExpr("symbol", "date", "vol / volume AS adjusted", "close", "volume")

    # -- factors and macro series ----------------------------------------------------------------------------

    @staticmethod
    def _spread(condition: str) -> str:
        return f"round((avg(CASE WHEN {condition} THEN r END) - avg(CASE WHEN NOT ({condition}) THEN r END)) * 100, 6)"

    @cached_property
    def factors_raw(self) -> DataFrame:
        return self.stored_monthly.groupBy("month", "mi").agg(
            F.expr("CAST(first(mi) % 5 AS DOUBLE) * 0.02D + 0.1D").alias("RF"),
            F.expr("round(avg(r) * 100, 6)").alias("Mkt-RF"),
            F.expr(self._spread("permno % 2 = 0")).alias("SMB"),
            F.expr(self._spread("permno % 3 = 0")).alias("HML"),
            F.expr(self._spread("permno % 5 = 0")).alias("RMW"),
            F.expr(self._spread("permno % 7 = 0")).alias("CMA"),
        ).selectExpr("CAST(year(month) * 100 + month(month) AS STRING) AS date", "RF", "`Mkt-RF`", "SMB", "HML", "RMW", "CMA")

    @cached_property
    def factors_daily_raw(self) -> DataFrame:
        return self.stored_daily.groupBy("date").agg(
            F.expr("CAST(first(mi) % 5 AS DOUBLE) * 0.001D + 0.005D").alias("RF"),
            F.expr("round(avg(r) * 100, 6)").alias("Mkt-RF"),
            F.expr(self._spread("permno % 2 = 0")).alias("SMB"),
            F.expr(self._spread("permno % 3 = 0")).alias("HML"),
        ).selectExpr("CAST(year(date) * 10000 + month(date) * 100 + day(date) AS STRING) AS date", "RF", "`Mkt-RF`", "SMB", "HML")

    @cached_property
    def q_factors_raw(self) -> DataFrame:
        return self.monthly_trade.groupBy("month").agg(
            F.expr("CAST(first(mi) % 5 AS DOUBLE) * 0.02D + 0.1D").alias("R_F"),
            F.expr("round(avg(r) * 100, 6)").alias("R_MKT"),
            F.expr(self._spread("permno % 2 = 0")).alias("R_ME"),
            F.expr(self._spread("permno % 3 = 0")).alias("R_IA"),
        ).selectExpr("year(month) AS year", "month(month) AS month", "R_F", "R_MKT", "R_ME", "R_IA")

    @cached_property
    def industries_raw(self) -> DataFrame:
        sums = [F.expr(f"round(avg(CASE WHEN permno % 10 = {i} THEN r END) * 100, 6)").alias(c) for i, c in enumerate(INDUSTRY_COLUMNS)]
        return self.monthly_trade.groupBy("month").agg(*sums).withColumn("date", F.expr("CAST(year(month) * 100 + month(month) AS STRING)")).drop("month")

    @cached_property
    def macro_raw(self) -> DataFrame:
        sums = self.monthly_trade.groupBy("month", "mi").agg(
            F.round(F.sum("vol"), 2).alias("vol"), F.sum("qty").alias("qty"), F.round(F.sum("disc"), 4).alias("disc"),
            F.max("top").alias("top"), F.count(F.lit(1)).alias("k"),
        )
        return sums.selectExpr(
            "CAST(year(month) * 100 + month(month) AS STRING) AS yyyymm", "vol / 1000 AS Index", "disc / 1000 AS D12", "disc / 500 AS E12",
            "CAST(mi % 5 AS DOUBLE) * 0.0002D + 0.001D AS Rfree",
            "CASE WHEN mi % 29 = 0 THEN 'n/a' ELSE CAST(k AS STRING) END AS svar",
            "qty / vol AS `b/m`", "top / vol AS ntis", "CAST(mi % 7 AS DOUBLE) / 100 AS tbl", "CAST(mi % 9 AS DOUBLE) / 100 AS lty",
            "CAST(mi % 4 AS DOUBLE) / 100 AS ltr", "CAST(mi % 11 AS DOUBLE) / 100 AS BAA", "CAST(mi % 6 AS DOUBLE) / 100 AS AAA",
            "CASE WHEN mi % 31 <> 0 THEN disc / vol END AS infl",
        )

    @cached_property
    def cpi_raw(self) -> DataFrame:
        sums = self.monthly_trade.groupBy("month").agg(F.round(F.sum("vol"), 2).alias("vol"), F.sum("qty").alias("qty"))
        return sums.selectExpr("month AS date", "vol / qty AS price")

    # -- accounting --------------------------------------------------------------------------------------------

    @cached_property
    def funda(self) -> DataFrame:
        sums = self.driver("orders").groupBy(
            F.expr("concat('G', o_custkey DIV 15)").alias("gvkey"), F.last_day("o_orderdate").alias("datadate")
        ).agg((F.sum(_units("o_totalprice", 100)) / 100 / 1000).alias("x"), F.min("o_orderkey").alias("k"))
        return sums.selectExpr(
            "gvkey", "datadate",
            "CASE WHEN k % 19 = 0 THEN 'FS' ELSE 'INDL' END AS indfmt",
            "CASE WHEN k % 43 = 0 THEN 'SUMM' ELSE 'STD' END AS datafmt", "'C' AS consol",
            "CASE WHEN k % 41 = 0 THEN 0.0D ELSE x END AS at", "x * 0.55D AS lt",
            "CASE WHEN k % 23 = 0 THEN -x WHEN k % 5 <> 0 THEN x * 0.4D END AS seq",
            "CASE WHEN k % 7 <> 0 THEN x * 0.35D END AS ceq", "CASE WHEN k % 3 <> 0 THEN x * 0.05D END AS pstk",
            "CASE WHEN k % 4 <> 0 THEN x * 0.02D END AS txditc", "CASE WHEN k % 11 <> 0 THEN x * 0.01D END AS txdb",
            "CASE WHEN k % 2 <> 0 THEN x * 0.005D END AS itcb", "CASE WHEN k % 3 <> 1 THEN x * 0.04D END AS pstkrv",
            "CASE WHEN k % 5 <> 2 THEN x * 0.03D END AS pstkl",
            "x * 0.1D + CAST(k % 17 AS DOUBLE) * 10 AS capx", "x * 0.08D + CAST(k % 13 AS DOUBLE) * 10 AS oancf",
            "x * 0.9D AS sale", "CASE WHEN k % 6 <> 0 THEN x * 0.5D END AS cogs", "CASE WHEN k % 8 <> 0 THEN x * 0.02D END AS xint",
            "CASE WHEN k % 9 <> 0 THEN x * 0.1D END AS xsga",
        )

    # -- bonds ---------------------------------------------------------------------------------------------------

    @cached_property
    def issues(self) -> DataFrame:
        def flag(name: str, modulus: int) -> str:
            return f"CASE WHEN p_partkey % {modulus} = 0 THEN 'Y' ELSE 'N' END AS {name}"

        def rare(name: str, modulus: int) -> str:
            return f"CASE WHEN p_partkey % {modulus} = 1 THEN 'x' END AS {name}"

        offered = "date_add(DATE'2000-01-01', CAST(p_partkey * 53 % 6000 AS INT))"
        return self.driver("part").selectExpr(
            "concat('B', p_partkey) AS complete_cusip",
            f"{offered} AS offering_date",
            f"date_add({offered}, 365 * (2 + p_size % 20)) AS maturity",
            f"{offered} AS dated_date", f"date_add({offered}, 30) AS last_interest_date",
            "p_retailprice * 100 AS offering_amt", "p_retailprice / 200 AS coupon",
            "CASE p_partkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '4' WHEN 4 THEN '12' ELSE '13' END AS interest_frequency",
            "CAST(p_partkey AS INT) AS issue_id", "CAST(p_partkey DIV 20 AS INT) AS issuer_id",
            "CASE WHEN p_partkey % 29 = 0 THEN 'JUN' ELSE 'SEN' END AS security_level",
            "CASE p_partkey % 7 WHEN 0 THEN 'CDEB' WHEN 1 THEN 'CMTN' WHEN 2 THEN 'CMTZ' WHEN 3 THEN 'CZ' WHEN 4 THEN 'USBN' WHEN 5 THEN 'CDEB' ELSE 'CCOV' END AS bond_type",
            "CASE WHEN p_partkey % 37 = 0 THEN 'Y' WHEN p_partkey % 41 = 0 THEN NULL ELSE 'N' END AS pay_in_kind",
            "CASE p_partkey % 8 WHEN 0 THEN 'V' WHEN 1 THEN 'Z' ELSE 'F' END AS coupon_type",
            flag("slob", 43), flag("asset_backed", 47), flag("defeased", 53), flag("yankee", 59), flag("canadian", 61),
            flag("foreign_currency", 67), flag("coupon_change_indicator", 71), flag("rule_144a", 31), flag("private_placement", 73),
            flag("defaulted", 79), flag("convertible", 83), flag("putable", 89), flag("unit_deal", 97), flag("exchangeable", 101),
            flag("perpetual", 103), flag("preferred_security", 107),
            rare("security_pledge", 33), rare("fix_frequency", 39), rare("exchange", 45),
            "CASE WHEN p_partkey % 51 = 1 THEN DATE'2010-01-01' END AS filing_date",
            "CASE WHEN p_partkey % 57 = 1 THEN DATE'2010-01-01' END AS settlement",
        )

    @cached_property
    def issuers(self) -> DataFrame:
        return self.driver("supplier").selectExpr(
            "CAST(s_suppkey AS INT) AS issuer_id", "CAST(s_suppkey * 97 % 10000 AS STRING) AS sic_code",
            "CASE WHEN s_suppkey % 10 = 9 THEN 'CAN' ELSE 'USA' END AS country_domicile",
        )

    @cached_property
    def trades(self) -> DataFrame:
        rows = self.driver("lineitem").selectExpr(
            "*", "date_add(DATE'2010-01-04', CAST(datediff(l_shipdate, DATE'1995-01-01') DIV 90 * 45 AS INT)) AS day"
        ).selectExpr("*", "date_add(day, CAST(l_orderkey % 3 AS INT)) AS reported")
        return rows.selectExpr(
            "concat('B', l_partkey DIV 16 * 16) AS cusip_id",
            "CAST(l_linenumber AS STRING) AS msg_seq_nb",
            "CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber - 1 AS STRING) END AS orig_msg_seq_nb",
            "1000.0D * (1 + CAST(l_quantity AS INT) % 2) AS entrd_vol_qt",
            "98.0D + l_orderkey % 2 AS rptd_pr",
            "l_tax * 100 AS yld_pt",
            "CASE WHEN l_suppkey DIV 4 % 2 = 0 THEN 'B' ELSE 'S' END AS rpt_side_cd",
            "CASE WHEN l_orderkey % 7 = 0 THEN 'E' WHEN l_orderkey % 3 = 0 THEN 'D' ELSE 'C' END AS cntra_mp_id",
            "day AS trd_exctn_dt",
            "CASE WHEN l_suppkey % 2 = 0 THEN '09:30:00' ELSE '14:15:00' END AS trd_exctn_tm",
            "reported AS trd_rpt_dt",
            "CASE WHEN l_orderkey % 2 = 0 THEN '15:00:00' ELSE '16:30:00' END AS trd_rpt_tm",
            "date_add(day, -1) AS pr_trd_dt",
            "CASE WHEN l_returnflag = 'A' OR l_returnflag || l_linestatus = 'NF' THEN 'T'"
            " WHEN l_returnflag = 'N' THEN CASE WHEN l_orderkey % 2 = 0 THEN 'C' ELSE 'X' END"
            " WHEN reported >= DATE'2012-02-06' THEN CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'Y' END"
            " ELSE 'W' END AS trc_st",
            "CASE WHEN l_partkey % 5 = 0 THEN 'R' WHEN l_partkey % 11 = 1 THEN 'A' WHEN l_partkey % 13 = 1 THEN 'D' WHEN l_partkey % 17 = 1 THEN '' END AS asof_cd",
            "CASE WHEN l_partkey % 23 = 1 THEN 'Y' ELSE 'N' END AS wis_fl",
            "CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_orderkey % 9 AS STRING) END AS days_to_sttl_ct",
            "CASE WHEN l_partkey % 3 <> 0 THEN date_add(day, CAST(l_partkey % 9 AS INT)) END AS stlmnt_dt",
            "CASE WHEN l_suppkey % 31 = 1 THEN 'S' WHEN l_suppkey % 2 = 0 THEN '' END AS spcl_trd_fl",
        )

    # -- panels built by the library -----------------------------------------------------------------------------

    @cached_property
    def ff3(self) -> DataFrame:
        return factor_tables.monthly_factors(self.factors_raw, START, END)

    @cached_property
    def ff3_daily(self) -> DataFrame:
        return factor_tables.daily_factors(self.factors_daily_raw, START, END)

    @cached_property
    def cpi(self) -> DataFrame:
        return factor_tables.deflator(self.cpi_raw)

    @cached_property
    def panel(self) -> DataFrame:
        return monthly_panel(self.msf, self.names, self.delistings, self.ff3)

    def stored_panel(self, *columns: str) -> DataFrame:
        """The needed columns of the monthly panel written once, for plans that read them several times."""
        return materialize(self.panel.select(*columns), "panel")

    @cached_property
    def linked(self) -> DataFrame:
        return link_entities(self.panel, self.links, AS_OF)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_panel(self.dsf, self.delistings, self.ff3_daily, END)

    @cached_property
    def accounts(self) -> DataFrame:
        return accounting.accounting_panel(self.funda)

    @cached_property
    def beta_monthly(self) -> DataFrame:
        return betas.beta_monthly(self.panel, self.ff3, 60, 48)

    @cached_property
    def beta_daily(self) -> DataFrame:
        return betas.beta_daily(self.daily, self.ff3_daily, 3, DAILY_MIN_OBS)

    @cached_property
    def beta(self) -> DataFrame:
        return materialize(betas.beta_table(self.beta_monthly, self.beta_daily), "beta")

    @cached_property
    def stored_linked(self) -> DataFrame:
        return materialize(self.linked, "linked")

    @cached_property
    def book(self) -> DataFrame:
        return value_sorts.book_to_market(self.accounts, self.stored_linked)

    @cached_property
    def sorting(self) -> DataFrame:
        return materialize(value_sorts.sorting_panel(self.stored_linked, self.book), "sorting")
