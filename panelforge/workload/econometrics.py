"""Returns, portfolio choice and regressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import regression
from panelforge.operators.covariance import covariance_matrix
from panelforge.operators.fixed_effects import demean, two_way_fit, within_fit
from panelforge.operators.hac import newey_west
from panelforge.plans import betas, investment, portfolio, returns, univariate
from panelforge.storage import materialize
from panelforge.workload import tables_sql
from panelforge.workload.registry import query
from panelforge.workload.sorting import DECILE_PORTFOLIOS, MEDIAN_PORTFOLIOS, SORT_DATA, SUMMARY, sort_data, spread_sql

STATS = "avg(ret * 100) AS daily_mean, stddev_samp(ret * 100) AS daily_sd, min(ret * 100) AS daily_min, max(ret * 100) AS daily_max"
STAT_COLUMNS = "daily_mean daily_sd daily_min daily_max"

tables_sql.CTES.update(
    {
        "t_returns": """
            SELECT symbol, date, ret FROM (SELECT symbol, date, adjusted / lag(adjusted) OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret FROM t_prices)
            WHERE ret IS NOT NULL""",
        "t_month_end": """
            SELECT symbol, month, price / lag(price) OVER (PARTITION BY symbol ORDER BY month) - 1 AS ret FROM (
              SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS month, arg_max(adjusted, date) AS price FROM t_prices GROUP BY 1, 2)
            QUALIFY lag(price) OVER (PARTITION BY symbol ORDER BY month) IS NOT NULL""",
        "t_balanced": """
            SELECT * FROM t_month_end WHERE symbol IN (SELECT symbol FROM t_month_end GROUP BY symbol
              HAVING count(*) = (SELECT max(n) FROM (SELECT count(*) AS n FROM t_month_end GROUP BY symbol)))""",
        "t_investment_inputs": """
            SELECT * FROM (
              SELECT s.gvkey, s.year, l.investment AS investment_lead, s.cash_flows, (p.mktcap + s.a - s.be + s.txdb) / s.a AS tobins_q
              FROM t_scaled s LEFT JOIN t_scaled l ON s.gvkey = l.gvkey AND s.year = l.year - 1
              LEFT JOIN t_linked p ON s.gvkey = p.gvkey AND CAST(date_trunc('month', s.datadate) AS DATE) = p.month)
            WHERE investment_lead IS NOT NULL AND cash_flows IS NOT NULL AND tobins_q IS NOT NULL""",
        "t_scaled": """
            SELECT gvkey, year, datadate, "at" AS a, be, txdb, capx / at_lag AS investment, oancf / at_lag AS cash_flows
            FROM t_accounts WHERE "at" > 0 AND at_lag > 0""",
        "t_capped": """
            SELECT gvkey, year, least(investment_lead, (SELECT quantile_cont(investment_lead, 0.99) FROM t_investment_inputs)) AS investment_lead,
                   least(cash_flows, (SELECT quantile_cont(cash_flows, 0.99) FROM t_investment_inputs)) AS cash_flows,
                   least(tobins_q, (SELECT quantile_cont(tobins_q, 0.99) FROM t_investment_inputs)) AS tobins_q FROM t_investment_inputs""",
        "t_investment": """
            SELECT gvkey, year, greatest(investment_lead, (SELECT quantile_cont(investment_lead, 0.01) FROM t_capped)) AS investment_lead,
                   greatest(cash_flows, (SELECT quantile_cont(cash_flows, 0.01) FROM t_capped)) AS cash_flows,
                   greatest(tobins_q, (SELECT quantile_cont(tobins_q, 0.01) FROM t_capped)) AS tobins_q FROM t_capped""",
        "t_year_panel": """
            SELECT permno, CAST(year(month) AS INTEGER) AS year, sum(ret_excess) AS y, avg(mktcap_lag) / 100 AS x, avg(altprc) / 1000 AS z
            FROM t_panel GROUP BY 1, 2""",
    }
)


# -- returns -----------------------------------------------------------------------------------------------------


@query("simple_returns", "SELECT * FROM t_returns", "ret")
def simple_returns(t):
    return returns.simple_returns(t.prices)


@query("return_stats", f"SELECT {STATS} FROM t_returns", STAT_COLUMNS)
def return_stats(t):
    return returns.return_stats(returns.simple_returns(t.prices))


@query("return_stats_by_year", f"SELECT CAST(year(date) AS INTEGER) AS year, {STATS} FROM t_returns GROUP BY 1", STAT_COLUMNS)
def return_stats_by_year(t):
    return returns.return_stats(returns.simple_returns(t.prices).withColumn("year", F.year("date")), ["year"])


@query("return_stats_by_symbol", f"SELECT symbol, {STATS} FROM t_returns GROUP BY symbol", STAT_COLUMNS)
def return_stats_by_symbol(t):
    return returns.return_stats(returns.simple_returns(t.prices), ["symbol"])


@query("return_distribution", "SELECT quantile_cont(ret * 100, 0.05) AS quantile FROM t_returns", "quantile")
def return_distribution(t):
    return returns.return_tail(returns.simple_returns(t.prices))


@query(
    "return_histogram",
    """SELECT CAST(least(floor((ret * 100 - low) / ((high - low) / 100)), 99) AS INTEGER) AS bin, count(*) AS n FROM t_returns,
         (SELECT min(ret * 100) AS low, max(ret * 100) AS high FROM t_returns) GROUP BY 1""",
)
def return_histogram(t):
    return returns.return_histogram(materialize(returns.simple_returns(t.prices), "returns"))


@query(
    "aggregate_volume",
    """SELECT date, volume, lag(volume) OVER (ORDER BY date) AS volume_lag
       FROM (SELECT date, sum(volume * close / 1e9) AS volume FROM t_prices GROUP BY date)""",
    "volume volume_lag",
)
def aggregate_volume(t):
    return returns.aggregate_volume(t.prices)


@query(
    "balanced_panel",
    """SELECT symbol, date, adjusted FROM t_prices WHERE symbol IN (SELECT symbol FROM t_prices GROUP BY symbol
       HAVING count(*) = (SELECT max(n) FROM (SELECT count(*) AS n FROM t_prices GROUP BY symbol)))""",
)
def balanced_panel(t):
    return returns.balanced_panel(t.prices).select("symbol", "date", "adjusted")


@query("month_end_returns", "SELECT * FROM t_month_end", "ret")
def month_end_returns(t):
    return returns.month_end_returns(t.prices)


@query(
    "agg_cov_matrix",
    "SELECT a.symbol AS i, b.symbol AS j, covar_samp(a.ret, b.ret) AS cov FROM t_balanced a JOIN t_balanced b ON a.month = b.month GROUP BY ALL",
    "cov",
)
def agg_cov_matrix(t):
    return covariance_matrix(_balanced_returns(t), "symbol", "month", "ret")


def _balanced_returns(t):
    return returns.balanced_panel(materialize(returns.month_end_returns(t.prices), "returns"))


def _funds(t):
    return portfolio.two_funds(materialize(_balanced_returns(t), "balanced"))


# Gauss-Jordan elimination of the covariance matrix with the right-hand sides (1, mean), one column per step.
ELIMINATION = """
    WITH RECURSIVE cov AS MATERIALIZED (
      SELECT a.symbol AS i, list(covar ORDER BY b.symbol) AS line FROM (SELECT DISTINCT symbol FROM t_balanced) a
      JOIN (SELECT x.symbol, y.symbol AS other, covar_samp(x.ret, y.ret) AS covar FROM t_balanced x JOIN t_balanced y ON x.month = y.month GROUP BY ALL) b ON a.symbol = b.other GROUP BY 1),
    means AS MATERIALIZED (SELECT symbol AS i, avg(ret) AS mu FROM t_balanced GROUP BY 1),
    steps(k, m) AS (
      SELECT 0, list(list_concat(line, [1.0, mu]) ORDER BY i) FROM cov JOIN means USING (i)
      UNION ALL
      SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / m[k + 1][k + 1])
        ELSE list_transform(r, lambda v, j: v - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)
      FROM steps WHERE k < len(m)),
    solved AS MATERIALIZED (SELECT m, len(m) AS n FROM steps ORDER BY k DESC LIMIT 1),
    base AS MATERIALIZED (
      SELECT i AS symbol, mu, m[p][n + 1] AS si, m[p][n + 2] AS sm FROM (SELECT *, row_number() OVER (ORDER BY i) AS p FROM means), solved),
    constants AS MATERIALIZED (SELECT sum(si) AS c, sum(sm) AS d, sum(mu * sm) AS e FROM base),
    funds AS MATERIALIZED (
      SELECT symbol, mu, si / c AS mvp, si / c + (3 * d / c - d / c) / (e - d * d / c) * (sm - d * si / c) AS efficient, c, d, e FROM base, constants),
    sums AS MATERIALIZED (SELECT sum(mvp * mu) AS m1, sum(efficient * mu) AS m2 FROM funds),
    spread AS MATERIALIZED (
      SELECT sum(f.mvp * covar * g.mvp) AS v11, sum(f.mvp * covar * g.efficient) AS v12, sum(f.efficient * covar * g.efficient) AS v22
      FROM funds f JOIN (SELECT x.symbol AS a, y.symbol AS b, covar_samp(x.ret, y.ret) AS covar FROM t_balanced x JOIN t_balanced y ON x.month = y.month GROUP BY ALL) k ON f.symbol = k.a
      JOIN funds g ON g.symbol = k.b)
"""


@query("portfolio_weights", ELIMINATION + "SELECT symbol, mvp, efficient FROM funds", "mvp efficient")
def portfolio_weights(t):
    return portfolio.portfolio_weights(_funds(t))


@query("portfolio_choice", ELIMINATION + "SELECT m1 AS average_ret, sqrt(v11) AS volatility FROM sums, spread", "average_ret volatility")
def portfolio_choice(t):
    return portfolio.minimum_variance_performance(_funds(t))


@query(
    "efficient_frontier",
    ELIMINATION
    + """SELECT c, 1200 * ((1 - c) * m1 + c * m2) AS mu, 100 * sqrt(12) * sqrt((1 - c) ** 2 * v11 + 2 * c * (1 - c) * v12 + c ** 2 * v22) AS sd
         FROM (SELECT CAST(k - 40 AS DOUBLE) / 100 AS c FROM (SELECT unnest(range(0, 231)) AS k)), sums, spread""",
    "mu sd",
)
def efficient_frontier(t):
    return portfolio.efficient_frontier(materialize(_funds(t), "funds"))


# -- regressions ---------------------------------------------------------------------------------------------------

FIT = """regr_intercept({y}, {x}) AS intercept, regr_slope({y}, {x}) AS slope,
    sqrt((regr_syy({y}, {x}) - regr_sxy({y}, {x}) ** 2 / regr_sxx({y}, {x})) / (regr_count({y}, {x}) - 2) / regr_sxx({y}, {x})) AS se_slope,
    sqrt((regr_syy({y}, {x}) - regr_sxy({y}, {x}) ** 2 / regr_sxx({y}, {x})) / (regr_count({y}, {x}) - 2)
         * (1 / regr_count({y}, {x}) + regr_avgx({y}, {x}) ** 2 / regr_sxx({y}, {x}))) AS se_intercept,
    regr_r2({y}, {x}) AS r2, CAST(regr_count({y}, {x}) AS BIGINT) AS n""".format(y="ret_excess", x="mkt_excess")
FIT_COLUMNS = "intercept slope se_slope se_intercept r2"
MARKET = "SELECT p.*, f.mkt_excess FROM t_panel p LEFT JOIN t_ff3 f ON p.month = f.month"


@query("ols_single", f"SELECT {FIT} FROM ({MARKET})", FIT_COLUMNS)
def ols_single(t):
    return betas.with_market(t.panel, t.ff3, "month").agg(*regression.simple_fit("ret_excess", "mkt_excess"))


@query("ols_by_group", f"SELECT permno, {FIT} FROM ({MARKET}) GROUP BY permno HAVING count(*) >= 24", FIT_COLUMNS)
def ols_by_group(t):
    grouped = betas.with_market(t.panel, t.ff3, "month").groupBy("permno")
    fits = grouped.agg(*regression.simple_fit("ret_excess", "mkt_excess"), F.count(F.lit(1)).alias("rows"))
    return fits.where("rows >= 24").drop("rows")


def _year_panel(t):
    yearly = t.panel.groupBy("permno", F.year("month").alias("year")).agg(
        F.sum("ret_excess").alias("y"), (F.avg("mktcap_lag") / 100).alias("x"), (F.avg("altprc") / 1000).alias("z")
    )
    return materialize(yearly, "yearly")


# Two-regressor least squares from centred products: Cramer's rule on the 2 x 2 system.
TWO = """
    SELECT n, sxx, szz, sxz, sxy, szy, syy, mx, mz, my, d, (sxy * szz - szy * sxz) / d AS bx, (szy * sxx - sxy * sxz) / d AS bz
    FROM (SELECT *, sxx * szz - sxz * sxz AS d FROM ({sums}))"""
POOLED = TWO.format(
    sums="""SELECT count(*) AS n, regr_sxx(y, x) AS sxx, regr_sxx(y, z) AS szz, regr_sxy(x, z) AS sxz, regr_sxy(y, x) AS sxy, regr_sxy(y, z) AS szy,
            regr_syy(y, x) AS syy, avg(x) AS mx, avg(z) AS mz, avg(y) AS my FROM t_year_panel"""
)
WITHIN_ROWS = """SELECT permno, year, y - avg(y) OVER w AS y, x - avg(x) OVER w AS x, z - avg(z) OVER w AS z, count(*) OVER () AS total
    FROM t_year_panel WINDOW w AS (PARTITION BY permno)"""
SUMS = """SELECT count(*) AS n, sum(x * x) AS sxx, sum(z * z) AS szz, sum(x * z) AS sxz, sum(x * y) AS sxy, sum(z * y) AS szy, sum(y * y) AS syy,
          0 AS mx, 0 AS mz, 0 AS my FROM ({rows})"""
WITHIN = TWO.format(sums=SUMS.format(rows=WITHIN_ROWS))
BALANCED_ROWS = """SELECT permno, year, y - avg(y) OVER (PARTITION BY permno) - avg(y) OVER (PARTITION BY year) + avg(y) OVER () AS y,
    x - avg(x) OVER (PARTITION BY permno) - avg(x) OVER (PARTITION BY year) + avg(x) OVER () AS x,
    z - avg(z) OVER (PARTITION BY permno) - avg(z) OVER (PARTITION BY year) + avg(z) OVER () AS z FROM (
      SELECT * FROM t_year_panel WHERE permno IN (SELECT permno FROM t_year_panel GROUP BY permno
        HAVING count(*) = (SELECT max(n) FROM (SELECT count(*) AS n FROM t_year_panel GROUP BY permno))))"""
TWO_WAY = TWO.format(sums=SUMS.format(rows=BALANCED_ROWS))
FITTED = "estimate std_error t_stat"


def _terms(source: str, model: str, absorbed: str, constant: bool = False) -> str:
    """Coefficient rows with iid errors; ``absorbed`` counts further estimated parameters."""
    base = f"SELECT *, (syy - bx * sxy - bz * szy) / (n - {2 + constant} - ({absorbed})) AS s2 FROM ({source})"
    rows = [
        f"SELECT '{model}' AS model, 'x' AS term, bx AS estimate, sqrt(s2 * szz / d) AS std_error, bx / sqrt(s2 * szz / d) AS t_stat, n FROM ({base})",
        f"SELECT '{model}', 'z', bz, sqrt(s2 * sxx / d), bz / sqrt(s2 * sxx / d), n FROM ({base})",
    ]
    if constant:
        variance = "s2 * (1 / n + (mx * mx * szz - 2 * mx * mz * sxz + mz * mz * sxx) / d)"
        rows.append(f"SELECT '{model}', 'const', my - mx * bx - mz * bz, sqrt({variance}), (my - mx * bx - mz * bz) / sqrt({variance}), n FROM ({base})")
    return " UNION ALL ".join(rows)


ENTITIES = "(SELECT count(DISTINCT permno) FROM t_year_panel)"
YEARS = "(SELECT count(DISTINCT year) FROM t_year_panel)"


@query("ols_multi", _terms(POOLED, "ols", "0", True), FITTED)
def ols_multi(t):
    fit = regression.ols(_year_panel(t), "y", ["x", "z"])
    return fit.table(t.spark, fit.iid(), "ols")


@query("ols_fe_oneway", _terms(WITHIN, "fe", ENTITIES), FITTED)
def ols_fe_oneway(t):
    fit, entities = within_fit(_year_panel(t), "y", ["x", "z"], "permno")
    return fit.table(t.spark, fit.iid(absorbed=entities), "fe")


@query(
    "demean",
    "SELECT permno, year, y - avg(y) OVER (PARTITION BY permno) AS y, x - avg(x) OVER (PARTITION BY permno) AS x FROM t_year_panel",
    "y x",
)
def demean_rows(t):
    return demean(_year_panel(t).select("permno", "year", "y", "x"), ["y", "x"], "permno")


def _balanced_years(t):
    from panelforge.operators.aggregates import keep_full_history

    return materialize(keep_full_history(_year_panel(t), "permno"), "balanced")


BALANCED_ENTITIES = f"(SELECT count(DISTINCT permno) FROM ({BALANCED_ROWS}))"
BALANCED_YEARS = f"(SELECT count(DISTINCT year) FROM ({BALANCED_ROWS}))"


@query("ols_fe_twoway", _terms(TWO_WAY, "fe2", f"{BALANCED_ENTITIES} + {BALANCED_YEARS} - 1"), FITTED)
def ols_fe_twoway(t):
    fit, _, effects = two_way_fit(_balanced_years(t), "y", ["x", "z"], "permno", "year")
    return fit.table(t.spark, fit.iid(absorbed=effects.rank), "fe2")


def _alternating(table: str, passes: int = 60) -> str:
    """Rows demeaned in turn by entity and by year until the means vanish."""
    once = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY permno) AS {c}" for c in "yxz")
    twice = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY year) AS {c}" for c in "yxz")
    return f"""WITH RECURSIVE turn(k, id, permno, year, y, x, z) AS (
        SELECT 0, row_number() OVER (), permno, year, y, x, z FROM {table}
        UNION ALL SELECT k + 1, id, permno, year, {twice} FROM (SELECT k, id, permno, year, {once} FROM turn WHERE k < {passes}))
        SELECT permno, year, y, x, z FROM turn WHERE k = {passes}"""


UNBALANCED = TWO.format(sums=SUMS.format(rows=_alternating("t_year_panel")))


@query("ols_fe_twoway_unbalanced", _terms(UNBALANCED, "fe2", f"{ENTITIES} + {YEARS} - 1"), FITTED)
def ols_fe_twoway_unbalanced(t):
    fit, _, effects = two_way_fit(_year_panel(t), "y", ["x", "z"], "permno", "year")
    return fit.table(t.spark, fit.iid(absorbed=effects.rank), "fe2")


APART = "(permno % 2 = 0) = (year <= 1998)"
HALVES = f"(SELECT * FROM t_year_panel WHERE {APART})"


@query(
    "ols_fe_twoway_parts",
    _terms(
        TWO.format(sums=SUMS.format(rows=_alternating(HALVES))), "fe2",
        f"(SELECT count(DISTINCT permno) FROM {HALVES}) + (SELECT count(DISTINCT year) FROM {HALVES}) - (SELECT count(DISTINCT permno % 2) FROM {HALVES})",
    ),
    FITTED,
)
def ols_fe_twoway_parts(t):
    """Two halves that share neither an entity nor a year: one effect more is lost."""
    fit, _, effects = two_way_fit(_year_panel(t).where(APART), "y", ["x", "z"], "permno", "year")
    return fit.table(t.spark, fit.iid(absorbed=effects.rank), "fe2")


def _meat(rows: str, by: str) -> str:
    """Sums of outer products of score sums per cluster, given the rows and the coefficients bx, bz."""
    scores = f"""SELECT sum(x * (y - bx * x - bz * z)) AS sx, sum(z * (y - bx * x - bz * z)) AS sz FROM ({rows}) r, coefficients GROUP BY {by}"""
    return f"SELECT sum(sx * sx) AS mxx, sum(sx * sz) AS mxz, sum(sz * sz) AS mzz, count(*) AS g FROM ({scores})"


def _clustered(source: str, rows: str, model: str, meat: str, k: str) -> str:
    vx = "(szz * szz * mxx - 2 * szz * sxz * mxz + sxz * sxz * mzz) / (d * d)"
    vz = "(sxx * sxx * mzz - 2 * sxx * sxz * mxz + sxz * sxz * mxx) / (d * d)"
    scale = f"(g / (g - 1)) * ((n - 1) / (n - ({k})))"
    return f"""WITH coefficients AS MATERIALIZED ({source}), meat AS ({meat})
        SELECT '{model}' AS model, 'x' AS term, bx AS estimate, sqrt({vx} * {scale}) AS std_error, bx / sqrt({vx} * {scale}) AS t_stat, n FROM coefficients, meat
        UNION ALL SELECT '{model}', 'z', bz, sqrt({vz} * {scale}), bz / sqrt({vz} * {scale}), n FROM coefficients, meat"""


@query("se_cluster_oneway", _clustered(WITHIN, WITHIN_ROWS, "cluster", _meat(WITHIN_ROWS, "permno"), "3"), FITTED)
def se_cluster_oneway(t):
    rows = materialize(demean(_year_panel(t), ["y", "x", "z"], "permno"), "within")
    fit = regression.fit_products(rows, "y", ["x", "z"])
    return fit.table(t.spark, regression.cluster_covariance(rows, "y", fit, ["permno"], estimated=3), "cluster")


TWO_WAY_MEAT = f"""SELECT f.mxx + y.mxx - b.mxx AS mxx, f.mxz + y.mxz - b.mxz AS mxz, f.mzz + y.mzz - b.mzz AS mzz, least(f.g, y.g) AS g
    FROM ({_meat(BALANCED_ROWS, "permno")}) f, ({_meat(BALANCED_ROWS, "year")}) y, ({_meat(BALANCED_ROWS, "permno, year")}) b"""


@query("se_cluster_twoway", _clustered(TWO_WAY, BALANCED_ROWS, "cluster2", TWO_WAY_MEAT, "3"), FITTED)
def se_cluster_twoway(t):
    fit, rows, _ = two_way_fit(_balanced_years(t), "y", ["x", "z"], "permno", "year")
    return fit.table(t.spark, regression.cluster_covariance(rows, "y", fit, ["permno", "year"], estimated=3), "cluster2")


# -- autocorrelation-robust tests -----------------------------------------------------------------------------------

SPREAD = spread_sql(MEDIAN_PORTFOLIOS, "'low'", "'high'")
HAC_LAG = 3
HAC_MEAN = f"""
    SELECT 'const' AS term, estimate, sqrt(v) AS std_error, estimate / sqrt(v) AS t_stat, {HAC_LAG}::INTEGER AS lag, n FROM (
      SELECT any_value(m) AS estimate, count(*) AS n, (sum(u * u) + 2 * ({" + ".join(f"(1 - {j} / ({HAC_LAG} + 1)) * coalesce(sum(u * u{j}), 0)" for j in range(1, HAC_LAG + 1))})) / count(*) ** 2 AS v
      FROM (SELECT m, u, {", ".join(f"lag(u, {j}) OVER (ORDER BY month) AS u{j}" for j in range(1, HAC_LAG + 1))}
            FROM (SELECT month, avg(long_short) OVER () AS m, long_short - avg(long_short) OVER () AS u FROM ({SPREAD}) WHERE long_short IS NOT NULL)))"""


def _spread(t):
    return univariate.long_short(univariate.median_sort(sort_data(t), "beta_lag"))


@query("se_newey_west", HAC_MEAN, FITTED)
def se_newey_west(t):
    return univariate.long_short_test(_spread(t), lag=HAC_LAG, prewhite=False)


HAC_AUTOMATIC = f"""
    WITH u AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY month) AS t, avg(long_short) OVER () AS m, count(*) OVER () AS n, long_short - avg(long_short) OVER () AS u
      FROM ({SPREAD}) WHERE long_short IS NOT NULL),
    r AS MATERIALIZED (SELECT sum(a.u * b.u) / sum(b.u * b.u) AS rho FROM u a JOIN u b ON a.t = b.t + 1),
    v AS MATERIALIZED (SELECT a.t, a.u - rho * b.u AS v FROM u a JOIN u b ON a.t = b.t + 1, r),
    g AS MATERIALIZED (SELECT a.t - b.t AS j, sum(a.v * b.v) AS g FROM v a JOIN v b ON a.t >= b.t GROUP BY 1),
    s AS (SELECT any_value(n) AS n, any_value(m) AS m FROM u),
    w AS MATERIALIZED (
      SELECT CAST(floor(1.1447 * pow(pow(sum(CASE WHEN j > 0 THEN 2 * j * g ELSE 0 END) / sum(CASE WHEN j > 0 THEN 2 * g ELSE g END), 2), 1.0 / 3) * pow(any_value(n), 1.0 / 3)) AS INTEGER) AS lag
      FROM g, s WHERE j <= floor(3 * pow(n / 100, 2.0 / 9)))
    SELECT 'const' AS term, m AS estimate, sqrt(x) AS std_error, m / sqrt(x) AS t_stat, lag, n FROM (
      SELECT any_value(m) AS m, any_value(n) AS n, any_value(lag) AS lag,
             sum(CASE WHEN j = 0 THEN g ELSE 2 * (1 - j / (lag + 1)) * g END) / any_value((1 - rho) * (1 - rho)) / any_value(n) ** 2 AS x
      FROM g, s, w, r WHERE j <= lag)"""


@query("se_newey_west_automatic", HAC_AUTOMATIC, FITTED)
def se_newey_west_automatic(t):
    return univariate.long_short_test(_spread(t))


def _lagged_sums(pairs: str) -> str:
    """Bartlett-weighted autocovariance sums of the score products in ``pairs`` (columns j, a, b)."""
    return f"sum(CASE WHEN j = 0 THEN {pairs} ELSE (1 - j / ({HAC_LAG} + 1)) * {pairs} END)"


HAC_REGRESSION = f"""
    WITH d AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY s.month) AS t, long_short AS y, mkt_excess AS x FROM ({SPREAD}) s JOIN t_ff3 f ON s.month = f.month
      WHERE long_short IS NOT NULL AND mkt_excess IS NOT NULL),
    c AS MATERIALIZED (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, count(*) * sum(x * x) - sum(x) ** 2 AS det FROM d),
    u AS MATERIALIZED (SELECT t, y - a - b * x AS u, x * (y - a - b * x) AS v FROM d, c),
    m AS MATERIALIZED (
      SELECT {_lagged_sums("p.u * q.u * CASE WHEN j = 0 THEN 1 ELSE 2 END")} AS m11, {_lagged_sums("CASE WHEN j = 0 THEN p.u * q.v ELSE p.u * q.v + p.v * q.u END")} AS m12,
             {_lagged_sums("p.v * q.v * CASE WHEN j = 0 THEN 1 ELSE 2 END")} AS m22
      FROM (SELECT unnest(range(0, {HAC_LAG + 1})) AS j) l, u p JOIN u q ON TRUE WHERE p.t = q.t + j),
    r AS (
      SELECT 'const' AS term, a AS estimate, (sxx * sxx * m11 - 2 * sxx * sx * m12 + sx * sx * m22) / (det * det) AS var, n FROM c, m
      UNION ALL SELECT 'mkt_excess', b, (sx * sx * m11 - 2 * sx * n * m12 + n * n * m22) / (det * det), n FROM c, m)
    SELECT term, estimate, sqrt(var) AS std_error, estimate / sqrt(var) AS t_stat, {HAC_LAG}::INTEGER AS lag, n FROM r"""


@query("se_newey_west_regression_lag", HAC_REGRESSION, FITTED)
def se_newey_west_regression_lag(t):
    return univariate.long_short_test(_spread(t), t.ff3, lag=HAC_LAG, prewhite=False)


def prewhitened_sql(rows: str, by: str = "") -> str:
    """Regression of y on a constant and x over ``rows`` (month, y, x), automatic bandwidth, prewhitened scores."""
    k, same = (f"{by}, ", f"p.{by} = q.{by} AND ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""

    def join(a: str, b: str) -> str:
        return f"{a} JOIN {b} USING ({by})" if by else f"{a} CROSS JOIN {b}"

    p_k = f"p.{by}, " if by else ""
    return f"""
    WITH d AS MATERIALIZED (
      SELECT {k}row_number() OVER ({f"PARTITION BY {by} " if by else ""}ORDER BY month) AS t, y, x FROM ({rows}) WHERE y IS NOT NULL AND x IS NOT NULL AND month IS NOT NULL),
    c AS MATERIALIZED (SELECT {k}regr_intercept(y, x) AS a, regr_slope(y, x) AS b, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx FROM d {group}),
    u AS MATERIALIZED (SELECT {k}t, y - a - b * x AS u, x * (y - a - b * x) AS v FROM {join("d", "c")}),
    r AS MATERIALIZED (
      SELECT {k}(p22 * r11 - p12 * r21) / det AS c11, (p22 * r12 - p12 * r22) / det AS c12, (p11 * r21 - p12 * r11) / det AS c21, (p11 * r22 - p12 * r12) / det AS c22
      FROM (SELECT *, p11 * p22 - p12 * p12 AS det FROM (
        SELECT {p_k}sum(p.u * p.u) AS p11, sum(p.u * p.v) AS p12, sum(p.v * p.v) AS p22,
               sum(p.u * q.u) AS r11, sum(p.u * q.v) AS r12, sum(p.v * q.u) AS r21, sum(p.v * q.v) AS r22
        FROM u p JOIN u q ON {same}q.t = p.t + 1 {f"GROUP BY p.{by}" if by else ""}))),
    w AS MATERIALIZED (
      SELECT {k}t, u - pu * c11 - pv * c21 AS u, v - pu * c12 - pv * c22 AS v
      FROM {join(f"(SELECT {p_k}q.t, q.u, q.v, p.u AS pu, p.v AS pv FROM u p JOIN u q ON {same}q.t = p.t + 1)", "r")}),
    g AS MATERIALIZED (
      SELECT {p_k}q.t - p.t AS j, sum(p.u * q.u) AS g11, sum(p.u * q.v + p.v * q.u) AS g12, sum(p.v * q.v) AS g22
      FROM w p JOIN w q ON {same}q.t >= p.t GROUP BY ALL),
    l AS MATERIALIZED (
      SELECT {k}CAST(floor(1.1447 * pow(pow(sum(2 * j * g22) / sum(CASE WHEN j = 0 THEN g22 ELSE 2 * g22 END), 2), 1.0 / 3) * pow(any_value(n), 1.0 / 3)) AS INTEGER) AS lag
      FROM {join("g", "c")} WHERE j <= floor(3 * pow(n / 100, 2.0 / 9)) {group}),
    s AS MATERIALIZED (
      SELECT {k}sum(CASE WHEN j = 0 THEN g11 ELSE 2 * bartlett * g11 END) AS s11, sum(CASE WHEN j = 0 THEN g12 / 2 ELSE bartlett * g12 END) AS s12,
             sum(CASE WHEN j = 0 THEN g22 ELSE 2 * bartlett * g22 END) AS s22
      FROM (SELECT g.*, lag, 1 - j / (least(lag, n - 2) + 1) AS bartlett FROM {join(join("g", "c"), "l")} WHERE j <= least(lag, n - 2)) {group}),
    z AS (
      SELECT *, ((1 - c22) * sxx - c12 * sx) / (dd * det) AS k11, (c21 * sxx - (1 - c11) * sx) / (dd * det) AS k12,
             (c12 * n - (1 - c22) * sx) / (dd * det) AS k21, ((1 - c11) * n - c21 * sx) / (dd * det) AS k22
      FROM (SELECT *, (1 - c11) * (1 - c22) - c12 * c21 AS dd, n * sxx - sx * sx AS det FROM {join(join(join("c", "r"), "s"), "l")})),
    o AS (
      SELECT {k}'const' AS term, a AS estimate, k11 * k11 * s11 + 2 * k11 * k12 * s12 + k12 * k12 * s22 AS var, lag, n FROM z
      UNION ALL SELECT {k}'mkt_excess', b, k21 * k21 * s11 + 2 * k21 * k22 * s12 + k22 * k22 * s22, lag, n FROM z)
    SELECT {k}term, estimate, sqrt(var) AS std_error, estimate / sqrt(var) AS t_stat, lag, n FROM o"""


ALPHA_ROWS = f"SELECT s.month, long_short AS y, mkt_excess AS x FROM ({SPREAD}) s LEFT JOIN t_ff3 f ON s.month = f.month"
DECILE_ROWS = f"SELECT portfolio, d.month, ret AS y, mkt_excess AS x FROM ({DECILE_PORTFOLIOS}) d LEFT JOIN t_ff3 f ON d.month = f.month"


@query("se_newey_west_regression", prewhitened_sql(ALPHA_ROWS), FITTED)
def se_newey_west_regression(t):
    return univariate.long_short_test(_spread(t), t.ff3)


@query("se_newey_west_by_portfolio", prewhitened_sql(DECILE_ROWS, "portfolio"), FITTED)
def se_newey_west_by_portfolio(t):
    deciles = univariate.with_factors(univariate.decile_sort(sort_data(t), "beta_lag"), t.ff3.select("month", "mkt_excess"))
    return newey_west(deciles, "ret", ["mkt_excess"], by=["portfolio"])


# -- investment panel -------------------------------------------------------------------------------------------------

MEASURES = "investment_lead cash_flows tobins_q"


@query("investment_inputs", "SELECT * FROM t_investment_inputs", MEASURES)
def investment_inputs(t):
    return investment.investment_inputs(t.accounts, t.linked)


@query("winsorize", "SELECT * FROM t_investment", MEASURES)
def winsorize(t):
    inputs = materialize(investment.investment_inputs(t.accounts, t.linked), "inputs")
    return regression.winsorize(inputs, investment.MEASURES, 0.01)


@query("investment_panel", "SELECT * FROM t_investment", MEASURES)
def investment_panel(t):
    return investment.investment_panel(t.accounts, t.linked)


@query(
    "panel_summary",
    f"SELECT measure, {SUMMARY} FROM (SELECT * FROM t_investment) UNPIVOT (value FOR measure IN (investment_lead, cash_flows, tobins_q)) GROUP BY measure",
    "mean sd min q05 q50 q95 max",
)
def panel_summary(t):
    return investment.panel_summary(materialize(investment.investment_panel(t.accounts, t.linked), "investment"))


tables_sql.CTES["t_reg"] = "SELECT gvkey AS permno, year, investment_lead AS y, cash_flows AS x, tobins_q AS z FROM t_investment"


def _on_investment(text: str) -> str:
    return text.replace("t_year_panel", "t_reg")


REG_ROWS = _alternating("t_reg")
REG_TWO_WAY = TWO.format(sums=SUMS.format(rows=REG_ROWS))
REG_FIRMS, REG_YEARS = _on_investment(ENTITIES), _on_investment(YEARS)
REG_TWO_WAY_MEAT = f"""SELECT f.mxx + y.mxx - b.mxx AS mxx, f.mxz + y.mxz - b.mxz AS mxz, f.mzz + y.mzz - b.mzz AS mzz, least(f.g, y.g) AS g
    FROM ({_meat(REG_ROWS, "permno")}) f, ({_meat(REG_ROWS, "year")}) y, ({_meat(REG_ROWS, "permno, year")}) b"""
REG_MODELS = [
    _terms(_on_investment(POOLED), "ols", "0", True),
    _terms(_on_investment(WITHIN), "fe_firm", REG_FIRMS),
    _terms(REG_TWO_WAY, "fe_firm_year", f"{REG_FIRMS} + {REG_YEARS} - 1"),
    _clustered(REG_TWO_WAY, REG_ROWS, "cluster_firm", _meat(REG_ROWS, "permno"), f"2 + {REG_YEARS}"),
    _clustered(REG_TWO_WAY, REG_ROWS, "cluster_firm_year", REG_TWO_WAY_MEAT, "3"),
]


@query(
    "panel_regressions",
    "SELECT model, CASE term WHEN 'x' THEN 'cash_flows' WHEN 'z' THEN 'tobins_q' ELSE term END AS term, estimate, std_error, t_stat, n FROM ("
    + " UNION ALL ".join(f"SELECT * FROM ({m})" for m in REG_MODELS)
    + ")",
    FITTED,
)
def panel_regressions(t):
    return investment.panel_regressions(investment.investment_panel(t.accounts, t.linked))
