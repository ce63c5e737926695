"""Panel building, accounting and descriptive reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.dates import month_of
from panelforge.operators.windows import lag_month
from panelforge.plans import accounting, reports
from panelforge.plans import daily_panel as daily
from panelforge.plans import monthly_panel as mp
from panelforge.sources import factors as factor_tables
from panelforge.storage import materialize, stage_path
from panelforge.workload.registry import query
from panelforge.workload.tables import AS_OF, END, INDUSTRY_COLUMNS, START


@query("valid_names", "SELECT permno, date, month, ret, exchcd, siccd FROM t_valid", "ret")
def valid_names(t):
    return mp.valid_names(t.msf, t.names).select("permno", "date", month_of("date").alias("month"), "ret", "exchcd", "siccd")


@query(
    "market_cap",
    "SELECT permno, date, CASE WHEN abs(shrout * 1000 * altprc) / 1e6 <> 0 THEN abs(shrout * 1000 * altprc) / 1e6 END AS mktcap FROM t_msf",
    "mktcap",
)
def market_cap(t):
    return t.msf.select("permno", "date", mp.market_cap(F.col("shrout"), F.col("altprc")).alias("mktcap"))


@query(
    "lagged_market_cap",
    """SELECT s.permno, s.month, s.mktcap, l.mktcap AS mktcap_lag FROM t_sized s
       LEFT JOIN t_sized l ON s.permno = l.permno AND s.month = CAST(l.month + INTERVAL 1 MONTH AS DATE)""",
    "mktcap mktcap_lag",
)
def lagged_market_cap(t):
    panel = mp.valid_names(t.msf.withColumn("month", month_of("date")), t.names)
    panel = panel.withColumn("mktcap", mp.market_cap(F.col("shrout"), F.col("altprc")))
    return panel.select("permno", "month", "mktcap", lag_month("mktcap", "permno", "month").alias("mktcap_lag"))


@query("classify_exchange", "SELECT permno, month, exchcd, exchange FROM t_classified")
def classify_exchange(t):
    valid = mp.valid_names(t.msf, t.names)
    return valid.select("permno", month_of("date").alias("month"), "exchcd", mp.classify_exchange(F.col("exchcd")).alias("exchange"))


@query("classify_industry", "SELECT permno, month, siccd, industry FROM t_classified")
def classify_industry(t):
    valid = mp.valid_names(t.msf, t.names)
    return valid.select("permno", month_of("date").alias("month"), "siccd", mp.classify_industry(F.col("siccd")).alias("industry"))


@query("delisting_return", "SELECT permno, month, ret, dlret, dlstcd, ret_adj FROM t_classified", "ret dlret ret_adj")
def delisting_return(t):
    return mp.classified_returns(t.msf, t.names, t.delistings).select("permno", "month", "ret", "dlret", "dlstcd", "ret_adj")


@query("excess_return", "SELECT permno, month, ret_adj, ret_excess FROM t_excess", "ret_adj ret_excess")
def excess_return(t):
    panel = mp.classified_returns(t.msf, t.names, t.delistings)
    return mp.add_excess_return(panel, t.ff3, "month", "ret_adj").select("permno", "month", "ret_adj", "ret_excess")


@query("build_monthly_panel", "SELECT * FROM t_panel")
def build_monthly_panel(t):
    return t.panel


@query("build_daily_panel", "SELECT * FROM t_daily")
def build_daily_panel(t):
    return t.daily


@query("refresh_daily_panel", "SELECT * FROM t_daily")
def refresh_daily_panel(t):
    """A panel written before returns of two months and a delisting were known, brought up to date month by month."""
    path = stage_path(t.spark, "daily-panel")
    returns, exits = materialize(t.dsf, "returns"), materialize(t.delistings, "delistings")
    new = returns.where("date BETWEEN DATE'1997-03-10' AND DATE'1997-03-20' OR trunc(date, 'MM') = DATE'1999-06-01'")
    late = exits.where("permno % 2 = 0")
    before = daily.daily_panel(returns.exceptAll(new), exits.exceptAll(late), t.ff3_daily, END)
    daily.write_daily_panel(before, path)
    months = daily.touched_months(returns, new, late)
    daily.refresh_daily_panel(t.spark, path, returns, exits, t.ff3_daily, END, months)
    return t.spark.read.parquet(path).select("permno", "date", "month", "ret", "ret_excess")


@query("link_entities", "SELECT permno, date, month, gvkey, mktcap FROM t_linked", "mktcap")
def link_entities(t):
    return t.linked.select("permno", "date", "month", "gvkey", "mktcap")


@query(
    "overlapping_links",
    """SELECT p.permno, p.date, count(*) AS links FROM t_panel p JOIN t_links k ON p.permno = k.lpermno
       AND p.date BETWEEN k.linkdt AND coalesce(k.linkenddt, DATE '2001-12-31') GROUP BY ALL HAVING count(*) > 1""",
)
def overlapping_links(t):
    every = t.links.withColumns({"linktype": F.lit("LU"), "linkprim": F.lit("P"), "usedflag": F.lit(1)})
    return mp.overlapping_links(t.panel, every, AS_OF)


# -- accounting --------------------------------------------------------------------------------------------------


@query("book_equity", "SELECT gvkey, datadate, be FROM t_equity", "be", 9)
def book_equity(t):
    return accounting.with_equity(accounting.standard_format(t.funda)).select("gvkey", "datadate", "be")


@query("operating_profitability", "SELECT gvkey, datadate, op FROM t_equity", "op")
def operating_profitability(t):
    return accounting.with_equity(accounting.standard_format(t.funda)).select("gvkey", "datadate", "op")


@query("last_filing_per_year", 'SELECT gvkey, year, datadate, "at" FROM t_yearly', "at")
def last_filing_per_year(t):
    return accounting.last_filing_per_year(accounting.standard_format(t.funda)).select("gvkey", "year", "datadate", "at")


@query("asset_growth", 'SELECT gvkey, year, "at", at_lag, inv FROM t_accounts', "at at_lag inv")
def asset_growth(t):
    yearly = accounting.last_filing_per_year(accounting.standard_format(t.funda))
    return accounting.asset_growth(yearly).select("gvkey", "year", "at", "at_lag", "inv")


@query("accounting_panel", "SELECT gvkey, datadate, year, be, op, at_lag, inv FROM t_accounts", "be op at_lag inv", 9)
def accounting_panel(t):
    return t.accounts.select("gvkey", "datadate", "year", "be", "op", "at_lag", "inv")


# -- reports -----------------------------------------------------------------------------------------------------


@query("securities_count", "SELECT exchange, date, count(*) AS n FROM t_panel GROUP BY ALL")
def securities_count(t):
    return reports.securities_count(t.panel, "exchange")


@query(
    "real_market_cap",
    "SELECT p.month, exchange, sum(mktcap / cpi) AS mktcap FROM t_panel p LEFT JOIN t_cpi c ON p.month = c.month GROUP BY ALL",
    "mktcap", 4,
)
def real_market_cap(t):
    return reports.real_market_cap(t.panel, t.cpi, "exchange")


@query(
    "industry_stats",
    """SELECT p.month, industry, count(DISTINCT permno) AS securities, sum(mktcap) / avg(cpi) AS mktcap
       FROM t_panel p LEFT JOIN t_cpi c ON p.month = c.month GROUP BY ALL""",
    "mktcap", 4,
)
def industry_stats(t):
    return reports.industry_stats(t.panel, t.cpi)


@query(
    "book_equity_coverage",
    """SELECT exchange, l.year, count(DISTINCT CASE WHEN be IS NOT NULL THEN permno END) / count(DISTINCT permno) AS share
       FROM (SELECT *, CAST(year(month) AS INTEGER) AS year, max(date) OVER (PARTITION BY permno, year(month)) AS last FROM t_linked) l
       LEFT JOIN t_accounts a ON l.gvkey = a.gvkey AND l.year = a.year WHERE l.date = l.last GROUP BY ALL""",
    "share",
)
def book_equity_coverage(t):
    return reports.book_equity_coverage(t.linked, t.accounts)


@query(
    "size_concentration",
    """SELECT month, name, value FROM (
         SELECT p.month, sum(CASE WHEN mktcap >= q1 THEN mktcap END) / sum(mktcap) AS "Largest 1% of stocks",
                sum(CASE WHEN mktcap >= q5 THEN mktcap END) / sum(mktcap) AS "Largest 5% of stocks",
                sum(CASE WHEN mktcap >= q10 THEN mktcap END) / sum(mktcap) AS "Largest 10% of stocks",
                sum(CASE WHEN mktcap >= q25 THEN mktcap END) / sum(mktcap) AS "Largest 25% of stocks"
         FROM t_panel p JOIN (SELECT month, quantile_cont(mktcap, 0.99) AS q1, quantile_cont(mktcap, 0.95) AS q5,
                                     quantile_cont(mktcap, 0.90) AS q10, quantile_cont(mktcap, 0.75) AS q25 FROM t_panel GROUP BY month) q
           ON p.month = q.month GROUP BY p.month)
       UNPIVOT (value FOR name IN ("Largest 1% of stocks", "Largest 5% of stocks", "Largest 10% of stocks", "Largest 25% of stocks"))""",
    "value",
)
def size_concentration(t):
    return reports.size_concentration(t.stored_panel("month", "mktcap"))


@query(
    "exchange_share",
    """SELECT month, exchange, mktcap / sum(mktcap) OVER (PARTITION BY month) AS share
       FROM (SELECT month, exchange, sum(mktcap) AS mktcap FROM t_panel GROUP BY ALL)""",
    "share",
)
def exchange_share(t):
    return reports.exchange_share(t.panel)


@query(
    "size_summary",
    """SELECT exchange, avg(mktcap) AS mean, stddev_samp(mktcap) AS sd, min(mktcap) AS min, quantile_cont(mktcap, 0.05) AS q05,
              quantile_cont(mktcap, 0.5) AS q50, quantile_cont(mktcap, 0.95) AS q95, max(mktcap) AS max, count(mktcap) AS n
       FROM (SELECT unnest([exchange, 'Overall']) AS exchange, mktcap FROM t_panel WHERE month = (SELECT max(month) FROM t_panel))
       GROUP BY exchange""",
    "mean sd min q05 q50 q95 max", 9,
)
def size_summary(t):
    return reports.size_summary(t.stored_panel("month", "exchange", "mktcap"))


# -- factor and macro ingestion ------------------------------------------------------------------------------------


@query("ingest_factors", "SELECT * FROM t_ff3", "rf mkt_excess smb hml", 9)
def ingest_factors(t):
    return t.ff3


@query("ingest_factors_daily", "SELECT * FROM t_ff3_daily", "rf mkt_excess smb hml", 9)
def ingest_factors_daily(t):
    return t.ff3_daily


@query(
    "ingest_five_factors",
    """SELECT CAST(strptime(date || '01', '%Y%m%d') AS DATE) AS month, "RF" / 100 AS rf, "Mkt-RF" / 100 AS mkt_excess, "SMB" / 100 AS smb,
              "HML" / 100 AS hml, "RMW" / 100 AS rmw, "CMA" / 100 AS cma FROM t_factors_raw""",
    "rf mkt_excess smb hml rmw cma", 9,
)
def ingest_five_factors(t):
    return factor_tables.monthly_factors(t.factors_raw, START, END, factor_tables.FIVE_FACTORS)


@query(
    "ingest_industries",
    "SELECT CAST(strptime(date || '01', '%Y%m%d') AS DATE) AS month, "
    + ", ".join(f'"{c}" / 100 AS "{c}"' for c in INDUSTRY_COLUMNS)
    + " FROM t_industries_raw",
    " ".join(INDUSTRY_COLUMNS), 9,
)
def ingest_industries(t):
    return factor_tables.industry_portfolios(t.industries_raw, START, END)


@query(
    "ingest_q_factors",
    """SELECT make_date(year, month, 1) AS month, "R_F" / 100 AS rf, "R_MKT" / 100 AS mkt_excess, "R_ME" / 100 AS me, "R_IA" / 100 AS ia
       FROM t_q_factors_raw""",
    "rf mkt_excess me ia", 9,
)
def ingest_q_factors(t):
    return factor_tables.q_factors(t.q_factors_raw, START, END)


@query("deflator", "SELECT month, cpi FROM t_cpi", "cpi")
def deflator(t):
    return t.cpi


@query(
    "macro_predictors",
    f"""SELECT * FROM (
          SELECT month, lead(logret - log_rfree) OVER (ORDER BY month) AS rp_div, ln("D12") - ln("Index") AS dp, ln("D12") - ln(prev) AS dy,
                 ln("E12") - ln("Index") AS ep, ln("D12") - ln("E12") AS de, svar, "b/m" AS bm, ntis, tbl, lty, ltr, lty - tbl AS tms,
                 "BAA" - "AAA" AS dfy, infl
          FROM (SELECT * EXCLUDE (svar), CAST(strptime(yyyymm || '01', '%Y%m%d') AS DATE) AS month, TRY_CAST(svar AS DOUBLE) AS svar,
                       ln("Index" + "D12") - lag(ln("Index" + "D12")) OVER (ORDER BY yyyymm) AS logret, ln("Rfree" + 1) AS log_rfree,
                       lag("Index") OVER (ORDER BY yyyymm) AS prev FROM t_macro_raw))
        WHERE month BETWEEN DATE '{START}' AND DATE '{END}' AND rp_div IS NOT NULL AND dy IS NOT NULL AND svar IS NOT NULL AND infl IS NOT NULL""",
    "rp_div dp dy ep de svar bm ntis tbl lty ltr tms dfy infl",
)
def macro_predictors(t):
    return factor_tables.macro_predictors(t.macro_raw, START, END)
