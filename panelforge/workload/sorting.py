"""Betas and portfolio sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators.windows import label_extremes
from panelforge.plans import betas, size_sorts, univariate, value_sorts
from panelforge.sources.readers import inline_table
from panelforge.workload.registry import query
from panelforge.workload.tables import DAILY_MIN_OBS

EXAMPLES = [(1, "Alpha"), (3, "Beta"), (5, "Gamma"), (7, "Delta")]
EXAMPLES_SQL = "(VALUES (1, 'Alpha'), (3, 'Beta'), (5, 'Gamma'), (7, 'Delta')) e(permno, company)"
COMPARISON_START = "1999-01-01"
SPLIT = "1998-07-01"
SORT_COLUMNS = ("month", "exchange", "ret", "ret_excess", "mktcap_lag")


def examples(t):
    return inline_table(t.spark, EXAMPLES, "permno int, company string")


# -- betas -------------------------------------------------------------------------------------------------------


@query("beta_monthly", "SELECT * FROM t_beta_monthly", "beta_monthly")
def beta_monthly(t):
    return t.beta_monthly


@query(
    "beta_monthly_rows",
    """SELECT permno, month, beta_monthly, n_obs FROM (
         SELECT p.permno, p.month, regr_slope(p.ret_excess, f.mkt_excess) OVER w AS beta_monthly, CAST(regr_count(p.ret_excess, f.mkt_excess) OVER w AS BIGINT) AS n_obs
         FROM t_panel p JOIN (SELECT permno FROM t_panel GROUP BY permno HAVING count(*) >= 61) v ON p.permno = v.permno
         LEFT JOIN t_ff3 f ON p.month = f.month
         WINDOW w AS (PARTITION BY p.permno ORDER BY p.month ROWS BETWEEN 60 PRECEDING AND CURRENT ROW))
       WHERE n_obs >= 48""",
    "beta_monthly",
)
def beta_monthly_rows(t):
    return betas.beta_monthly(t.panel, t.ff3, rows=60, min_obs=48, min_history=61)


@query(
    "beta_monthly_consecutive",
    """SELECT permno, month, beta_monthly, n_obs FROM (
         SELECT p.permno, p.month, regr_slope(p.ret_excess, f.mkt_excess) OVER w AS beta_monthly, CAST(regr_count(p.ret_excess, f.mkt_excess) OVER w AS BIGINT) AS n_obs,
                date_diff('month', min(p.month) OVER w, max(p.month) OVER w) + 1 - count(*) OVER w AS gaps
         FROM t_panel p LEFT JOIN t_ff3 f ON p.month = f.month
         WINDOW w AS (PARTITION BY p.permno ORDER BY p.month RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW))
       WHERE n_obs >= 10 AND gaps = 0""",
    "beta_monthly",
)
def beta_monthly_consecutive(t):
    return betas.beta_monthly(t.panel, t.ff3, months=12, min_obs=10, require_consecutive=True)


@query("beta_daily", "SELECT * FROM t_beta_daily", "beta_daily")
def beta_daily(t):
    return t.beta_daily


@query(
    "beta_trailing_days",
    """SELECT permno, date, beta FROM (
         SELECT d.permno, d.date, CASE WHEN regr_sxx(d.ret_excess, f.mkt_excess) OVER w > 0 THEN regr_slope(d.ret_excess, f.mkt_excess) OVER w END AS beta,
                CAST(regr_count(d.ret_excess, f.mkt_excess) OVER w AS BIGINT) AS n
         FROM t_daily d LEFT JOIN t_ff3_daily f ON d.date = f.date
         WINDOW w AS (PARTITION BY d.permno ORDER BY d.date ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING))
       WHERE n >= 50 AND beta IS NOT NULL""",
    "beta",
)
def beta_trailing_days(t):
    return betas.beta_trailing_days(t.daily, t.ff3_daily, 90, 50)


@query("beta_table", "SELECT * FROM t_beta", "beta_monthly beta_daily")
def beta_table(t):
    return betas.beta_table(t.beta_monthly, t.beta_daily)


@query("beta_examples", f"SELECT b.*, e.company FROM t_beta b JOIN {EXAMPLES_SQL} ON b.permno = e.permno", "beta_monthly beta_daily")
def beta_examples(t):
    return betas.beta_examples(betas.beta_table(t.beta_monthly, t.beta_daily), examples(t))


INDUSTRY_BETAS = """
    SELECT industry, b.permno, avg(beta_monthly) AS beta_monthly FROM t_beta_monthly b
    JOIN t_panel p ON b.permno = p.permno AND b.month = p.month GROUP BY ALL"""


@query("beta_by_industry", INDUSTRY_BETAS, "beta_monthly")
def beta_by_industry(t):
    return betas.beta_by_industry(t.beta_monthly, t.panel)


@query(
    "beta_industry_order",
    f"SELECT industry, median(beta_monthly) AS median_beta FROM ({INDUSTRY_BETAS}) GROUP BY industry",
    "median_beta",
)
def beta_industry_order(t):
    return betas.industry_order(betas.beta_by_industry(t.beta_monthly, t.panel))


@query(
    "beta_deciles",
    """SELECT month, CAST(round(p * 100) AS INTEGER) AS quantile, q AS beta_monthly FROM (
         SELECT month, unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS p,
                unnest(quantile_cont(beta_monthly, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS q FROM t_beta_monthly GROUP BY month)""",
    "beta_monthly",
)
def beta_deciles(t):
    return betas.beta_deciles(t.beta_monthly)


@query(
    "beta_decile_floors",
    """SELECT month, CAST(d * 10 AS INTEGER) AS quantile, min(beta_monthly) AS x FROM (
         SELECT month, beta_monthly, ntile(10) OVER (PARTITION BY month ORDER BY -beta_monthly, permno) AS d FROM t_beta_monthly)
       WHERE d <> 10 GROUP BY ALL""",
    "x",
)
def beta_decile_floors(t):
    return betas.beta_decile_floors(t.beta_monthly)


BETA_LONG = """
    SELECT permno, month, 'beta_monthly' AS name, beta_monthly AS value FROM t_beta
    UNION ALL SELECT permno, month, 'beta_daily', beta_daily FROM t_beta"""


@query(
    "beta_comparison",
    f"""SELECT l.permno, company, month, name, value FROM ({BETA_LONG}) l JOIN {EXAMPLES_SQL} ON l.permno = e.permno
        WHERE value IS NOT NULL AND month >= DATE '{COMPARISON_START}'""",
    "value",
)
def beta_comparison(t):
    return betas.beta_comparison(betas.beta_table(t.beta_monthly, t.beta_daily), examples(t), COMPARISON_START)


@query(
    "beta_coverage",
    f"""SELECT p.month, n.name, count(l.value) / count(*) AS share FROM t_panel p
        CROSS JOIN (VALUES ('beta_monthly'), ('beta_daily')) n(name)
        LEFT JOIN ({BETA_LONG}) l ON p.permno = l.permno AND p.month = l.month AND n.name = l.name GROUP BY ALL""",
    "share",
)
def beta_coverage(t):
    return betas.beta_coverage(t.panel, betas.beta_table(t.beta_monthly, t.beta_daily))


SUMMARY = """avg(value) AS mean, stddev_samp(value) AS sd, min(value) AS min, quantile_cont(value, 0.05) AS q05,
    quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.95) AS q95, max(value) AS max, count(value) AS n"""


@query(
    "beta_summary",
    f"""SELECT name, {SUMMARY} FROM ({BETA_LONG}) l JOIN t_panel p ON p.permno = l.permno AND p.month = l.month
        WHERE value IS NOT NULL GROUP BY name""",
    "mean sd min q05 q50 q95 max",
)
def beta_summary(t):
    return betas.beta_summary(t.stored_panel("permno", "month"), t.beta)


@query("agg_corr", "SELECT corr(beta_monthly, beta_daily) AS corr FROM t_beta", "corr")
def agg_corr(t):
    return betas.beta_correlation(betas.beta_table(t.beta_monthly, t.beta_daily))


# -- sorts on the lagged beta --------------------------------------------------------------------------------------

LAGGED = "SELECT permno, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, beta_daily AS beta_lag FROM t_beta_daily"
SORT_DATA = f"SELECT p.permno, p.month, p.ret_excess, p.mktcap_lag, s.beta_lag FROM t_panel p JOIN ({LAGGED}) s ON p.permno = s.permno AND p.month = s.month"
MEDIAN_PORTFOLIOS = f"""
    SELECT d.month, CASE WHEN beta_lag <= m THEN 'low' ELSE 'high' END AS portfolio, sum(ret_excess * mktcap_lag) / sum(mktcap_lag) AS ret
    FROM ({SORT_DATA}) d JOIN (SELECT month, median(beta_lag) AS m FROM ({SORT_DATA}) GROUP BY month) q ON d.month = q.month GROUP BY ALL"""
DECILE_PORTFOLIOS = f"""
    SELECT CAST(portfolio AS INTEGER) AS portfolio, month, sum(ret_excess * mktcap_lag) / sum(mktcap_lag) AS ret
    FROM (SELECT *, ntile(10) OVER (PARTITION BY month ORDER BY beta_lag, permno) AS portfolio FROM ({SORT_DATA})) GROUP BY ALL"""


def spread_sql(portfolios: str, low: str, high: str) -> str:
    return f"""SELECT month, max(CASE WHEN portfolio = {low} THEN ret END) AS low, max(CASE WHEN portfolio = {high} THEN ret END) AS high,
        max(CASE WHEN portfolio = {high} THEN ret END) - max(CASE WHEN portfolio = {low} THEN ret END) AS long_short
        FROM ({portfolios}) WHERE portfolio IN ({low}, {high}) GROUP BY month"""


def sort_data(t):
    from panelforge.storage import materialize

    return materialize(univariate.sort_data(t.panel, t.beta_daily, "beta_daily", "beta_lag"), "signal")


@query("lagged_signal", LAGGED, "beta_lag")
def lagged_signal(t):
    return univariate.lagged_signal(t.beta_daily, "beta_daily", "beta_lag")


@query("median_sort", MEDIAN_PORTFOLIOS, "ret")
def median_sort(t):
    return univariate.median_sort(sort_data(t), "beta_lag")


@query("decile_sort", DECILE_PORTFOLIOS, "ret")
def decile_sort(t):
    return univariate.decile_sort(sort_data(t), "beta_lag")


@query("long_short", spread_sql(MEDIAN_PORTFOLIOS, "'low'", "'high'"), "low high long_short")
def long_short(t):
    return univariate.long_short(univariate.median_sort(sort_data(t), "beta_lag"))


@query(
    "long_short_deciles",
    f"""SELECT s.month, low, high, high - low AS long_short, mkt_excess, smb, hml FROM (
          SELECT month, CASE WHEN min(portfolio) < max(portfolio) THEN arg_min(ret, portfolio) END AS low, arg_max(ret, portfolio) AS high
          FROM ({DECILE_PORTFOLIOS}) GROUP BY month) s LEFT JOIN t_ff3 f ON s.month = f.month""",
    "low high long_short mkt_excess smb hml",
)
def long_short_deciles(t):
    spread = univariate.long_short_extremes(univariate.decile_sort(sort_data(t), "beta_lag"))
    return univariate.with_factors(spread, t.ff3.select("month", "mkt_excess", "smb", "hml"))


PERFORMANCE = f"""
    SELECT portfolio, regr_intercept(ret, mkt_excess) AS alpha, regr_slope(ret, mkt_excess) AS beta, avg(ret) AS ret
    FROM ({DECILE_PORTFOLIOS}) d LEFT JOIN t_ff3 f ON d.month = f.month GROUP BY portfolio"""


@query("capm_performance", PERFORMANCE, "alpha beta ret")
def capm_performance(t):
    return univariate.capm_performance(univariate.decile_sort(sort_data(t), "beta_lag"), t.ff3)


@query(
    "market_line",
    f"SELECT regr_intercept(ret, beta) AS intercept, regr_slope(ret, beta) AS slope, CAST(regr_count(ret, beta) AS BIGINT) AS n FROM ({PERFORMANCE})",
    "intercept slope",
)
def market_line(t):
    return univariate.market_line(univariate.capm_performance(univariate.decile_sort(sort_data(t), "beta_lag"), t.ff3))


@query(
    "annual_compound",
    f"""SELECT year, name, value FROM (SELECT CAST(year(month) AS INTEGER) AS year, product(1 + low) - 1 AS low, product(1 + high) - 1 AS high,
          product(1 + long_short) - 1 AS long_short FROM ({spread_sql(MEDIAN_PORTFOLIOS, "'low'", "'high'")}) GROUP BY 1)
        UNPIVOT (value FOR name IN (low, high, long_short))""",
    "value",
)
def annual_compound(t):
    return univariate.annual_compound(univariate.long_short(univariate.median_sort(sort_data(t), "beta_lag")))


@query("market_mean", "SELECT avg(mkt_excess) AS mkt_excess, avg(smb) AS smb FROM t_ff3", "mkt_excess smb", 9)
def market_mean(t):
    return t.ff3.agg(F.avg("mkt_excess").alias("mkt_excess"), F.avg("smb").alias("smb"))


# -- size sorts ----------------------------------------------------------------------------------------------------

ALL3 = "'NYSE', 'NASDAQ', 'AMEX'"


def breaks_sql(source: str, var: str, n: int, by: str, exchanges: str) -> str:
    probs = ", ".join(str(k / n) for k in range(n + 1))
    return f"SELECT {by}, quantile_cont({var}, [{probs}]) AS breaks FROM ({source}) WHERE exchange IN ({exchanges}) GROUP BY {by}"


def assigned_sql(source: str, var: str, n: int, by: str, exchanges: str, name: str) -> str:
    """Range join on consecutive break points, the outer ones at infinity."""
    keys = by.split(", ")
    match = " AND ".join(f"s.{k} = r.{k}" for k in keys)
    ranges = f"""SELECT {by}, CAST(k AS INTEGER) AS {name}, CASE WHEN k = 1 THEN '-inf'::DOUBLE ELSE breaks[k] END AS port_min,
        CASE WHEN k = {n} THEN 'inf'::DOUBLE ELSE breaks[k + 1] END AS port_max
        FROM (SELECT *, unnest(range(1, {n + 1})) AS k FROM ({breaks_sql(source, var, n, by, exchanges)}))"""
    return f"SELECT s.*, r.{name} FROM ({source}) s JOIN ({ranges}) r ON {match} AND s.{var} >= r.port_min AND s.{var} < r.port_max"


SIZE_ASSIGNED = assigned_sql("SELECT * FROM t_panel", "mktcap_lag", 10, "month", ALL3, "portfolio")


def premium_sql(assigned: str, ret: str) -> str:
    return f"""SELECT avg(spread) AS size_premium FROM (SELECT month, arg_min(ret, portfolio) - arg_max(ret, portfolio) AS spread FROM (
        SELECT month, portfolio, {ret} AS ret FROM ({assigned}) WHERE ret IS NOT NULL GROUP BY ALL) GROUP BY month)"""


VALUE_WEIGHTED, EQUAL_WEIGHTED = "sum(ret_excess * mktcap_lag) / sum(mktcap_lag)", "avg(ret_excess)"


@query(
    "breakpoints",
    f"""SELECT month, unnest(range(0, 11))::INTEGER AS k, unnest(breaks) AS breakpoint
        FROM ({breaks_sql("SELECT * FROM t_panel", "mktcap_lag", 10, "month", "'NYSE'")})""",
    "breakpoint", 9,
)
def breakpoints(t):
    arrays = size_sorts.breakpoints(t.stored_panel("month", "exchange", "mktcap_lag"), "mktcap_lag", 10, ["month"], ("NYSE",))
    return arrays.select("month", F.posexplode("breaks").alias("k", "breakpoint"))


@query(
    "breakpoint_rows",
    f"""SELECT month, CAST(k AS INTEGER) AS portfolio, CASE WHEN k = 1 THEN '-inf'::DOUBLE ELSE round(breaks[k], 9) END AS port_min,
          CASE WHEN k = 5 THEN 'inf'::DOUBLE ELSE round(breaks[k + 1], 9) END AS port_max
        FROM (SELECT *, unnest(range(1, 6)) AS k FROM ({breaks_sql("SELECT * FROM t_panel", "mktcap_lag", 5, "month", ALL3)}))""",
)
def breakpoint_rows(t):
    rows = size_sorts.breakpoint_rows(size_sorts.breakpoints(t.stored_panel("month", "exchange", "mktcap_lag"), "mktcap_lag", 5, ["month"], size_sorts.ALL_EXCHANGES), ["month"])
    infinite = [float("-inf"), float("inf")]
    return rows.withColumns({c: F.when(F.col(c).isin(infinite), F.col(c)).otherwise(F.round(c, 9)) for c in ("port_min", "port_max")})


@query("assign_portfolio", f"SELECT permno, month, portfolio FROM ({SIZE_ASSIGNED})")
def assign_portfolio(t):
    return size_sorts.assign_portfolio(t.stored_panel("permno", "month", "exchange", "mktcap_lag"), "mktcap_lag", 10, ["month"], size_sorts.ALL_EXCHANGES).select("permno", "month", "portfolio")


@query(
    "size_portfolios",
    f"SELECT month, portfolio, {VALUE_WEIGHTED} AS ret FROM ({SIZE_ASSIGNED}) WHERE ret IS NOT NULL GROUP BY ALL",
    "ret",
)
def size_portfolios(t):
    return size_sorts.size_portfolios(t.stored_panel(*SORT_COLUMNS))


@query(
    "win_global_extreme_label",
    f"""SELECT month, leg, ret FROM (SELECT month, ret, CASE WHEN portfolio = min(portfolio) OVER (PARTITION BY month) THEN 'min'
          WHEN portfolio = max(portfolio) OVER (PARTITION BY month) THEN 'max' ELSE 'other' END AS leg
        FROM (SELECT month, portfolio, {VALUE_WEIGHTED} AS ret FROM ({SIZE_ASSIGNED}) WHERE ret IS NOT NULL GROUP BY ALL))""",
    "ret",
)
def win_global_extreme_label(t):
    return label_extremes(size_sorts.size_portfolios(t.stored_panel(*SORT_COLUMNS)), "portfolio", ["month"]).select("month", "leg", "ret")


@query("size_premium", f"SELECT 'NYSE, NASDAQ, AMEX' AS exchanges, * FROM ({premium_sql(SIZE_ASSIGNED, VALUE_WEIGHTED)})", "size_premium", 9)
def size_premium(t):
    return size_sorts.size_premium(t.stored_panel(*SORT_COLUMNS))


def grid_sql() -> str:
    samples = {
        "all": "true", "no finance": "industry <> 'Finance'",
        f"before {SPLIT}": f"month < DATE '{SPLIT}'", f"from {SPLIT}": f"month >= DATE '{SPLIT}'",
    }
    sets = {"NYSE": "'NYSE'", "NYSE, NASDAQ, AMEX": ALL3}
    parts = []
    for n in (2, 5, 10):
        for set_name, members in sets.items():
            for weighted, ret in (("true", VALUE_WEIGHTED), ("false", EQUAL_WEIGHTED)):
                for name, predicate in samples.items():
                    assigned = assigned_sql(f"SELECT * FROM t_panel WHERE {predicate}", "mktcap_lag", n, "month", members, "portfolio")
                    parts.append(
                        f"SELECT {n} AS n_portfolios, '{set_name}' AS exchanges, {weighted} AS value_weighted, '{name}' AS subsample, * FROM ({premium_sql(assigned, ret)})"
                    )
    return " UNION ALL ".join(parts)


@query("specification_grid", grid_sql(), "size_premium", 9)
def specification_grid(t):
    return size_sorts.specification_grid(t.stored_panel(*SORT_COLUMNS, "industry"), SPLIT)


# -- value sorts ---------------------------------------------------------------------------------------------------

SORTING = "SELECT * FROM t_sorting"
BM_ASSIGNED = assigned_sql(SORTING, "bm", 5, "month", "'NYSE'", "portfolio_bm")
INDEPENDENT = assigned_sql(BM_ASSIGNED, "me", 5, "month", "'NYSE'", "portfolio_me")
ME_ASSIGNED = assigned_sql(SORTING, "me", 5, "month", "'NYSE'", "portfolio_me")
DEPENDENT = assigned_sql(ME_ASSIGNED, "bm", 5, "month, portfolio_me", "'NYSE'", "portfolio_bm")


def cells_sql(assigned: str) -> str:
    return f"SELECT month, portfolio_me, portfolio_bm, {VALUE_WEIGHTED} AS ret FROM ({assigned}) GROUP BY ALL"


def value_premium_sql(assigned: str) -> str:
    return f"""SELECT avg(spread) AS value_premium FROM (SELECT month, arg_max(ret, portfolio_bm) - arg_min(ret, portfolio_bm) AS spread
        FROM (SELECT month, portfolio_bm, avg(ret) AS ret FROM ({cells_sql(assigned)}) GROUP BY ALL) GROUP BY month)"""


@query("book_to_market", "SELECT * FROM t_book", "bm")
def book_to_market(t):
    return t.book


@query("sorting_panel", SORTING, "ret_excess mktcap_lag me bm")
def sorting_panel(t):
    return value_sorts.sorting_panel(t.stored_linked, t.book)


@query("double_sort_independent", cells_sql(INDEPENDENT), "ret")
def double_sort_independent(t):
    return value_sorts.double_sort_independent(t.sorting)


@query("double_sort_dependent", cells_sql(DEPENDENT), "ret")
def double_sort_dependent(t):
    return value_sorts.double_sort_dependent(t.sorting)


@query("value_premium", value_premium_sql(INDEPENDENT), "value_premium", 9)
def value_premium(t):
    return value_sorts.value_premium(value_sorts.double_sort_independent(t.sorting))


@query("value_premium_dependent", value_premium_sql(DEPENDENT), "value_premium", 9)
def value_premium_dependent(t):
    return value_sorts.value_premium(value_sorts.double_sort_dependent(t.sorting))
