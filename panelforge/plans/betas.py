"""Rolling market betas and reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.dates import month_index, months_apart
from panelforge.functions.scalars import finite
from panelforge.operators.aggregates import keep_min_rows, share_known, summarize
from panelforge.operators.joins import period_lookup
from panelforge.operators.quantiles import exact_quantiles, ntile, quantile_rows
from panelforge.operators.reshape import to_long
from panelforge.operators.windows import rolling_sums

Y, X = "ret_excess", "mkt_excess"
CENTRED = "mkt_centred"
BETAS = ("beta_monthly", "beta_daily")
NOISE = 1e-10


def with_market(panel: DataFrame, factors: DataFrame, period: str, name: str = X) -> DataFrame:
    """The panel with the market return of its period; values that are no finite numbers count as missing on both sides.

    Under the name ``CENTRED`` the column is the return less its mean over the calendar, which leaves slopes as they are and
    keeps sums of squares small.  The lookup has one row per period, so its unpartitioned window is bounded by the calendar.
    """
    market = period_lookup(factors.select(period, finite(F.col(X)).alias(name)), period)
    if name == CENTRED:
        market = market.withColumn(name, F.col(name) - F.avg(name).over(Window.partitionBy(F.lit(0))))
    return panel.withColumn(Y, finite(F.col(Y))).join(F.broadcast(market), period, "left")


def _pair_terms() -> dict[str, Column]:
    """Summands of the regression of Y on the centred market over rows where both are known."""
    x, y = F.col(CENTRED), F.col(Y)
    pair = y.isNotNull() & x.isNotNull()
    terms = {"n": F.lit(1.0), "sx": x, "sy": y, "sxx": x * x, "sxy": x * y}
    return {k: F.when(pair, t) for k, t in terms.items()}


def _slope() -> Column:
    """Slope from the sums, where the regressor varies beyond rounding noise."""
    n = F.nullif(F.col("n"), F.lit(0.0))
    sxx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    sxy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    return F.when(sxx > F.col("sxx") * NOISE, sxy / F.nullif(sxx, F.lit(0.0)))


def beta_monthly(
    panel: DataFrame,
    factors: DataFrame,
    months: int = 60,
    min_obs: int = 48,
    rows: int | None = None,
    require_consecutive: bool = False,
    min_history: int | None = None,
) -> DataFrame:
    """Rolling slope of excess returns on the market over ``months`` calendar months (or ``rows`` preceding rows)."""
    data = keep_min_rows(panel, "permno", min_history) if min_history else panel
    data = with_market(data.select("permno", "month", Y), factors, "month", CENTRED).withColumn("__mi", month_index("month"))
    width = ("range", -(months - 1), 0) if rows is None else ("rows", -rows, 0)
    out = rolling_sums(data, _pair_terms(), "permno", "__mi", width)
    if require_consecutive:
        frame = Window.partitionBy("permno").orderBy("__mi")
        frame = frame.rangeBetween(-(months - 1), 0) if rows is None else frame.rowsBetween(-rows, 0)
        span = months_apart(F.min("month").over(frame), F.max("month").over(frame))
        out = out.withColumn("__gap", span + 1 - F.count("month").over(frame)).where("__gap = 0")
    out = out.where(F.col("n") >= min_obs)
    return out.select("permno", "month", _slope().alias("beta_monthly"), F.col("n").cast("long").alias("n_obs")).dropna(subset=["beta_monthly"])


def beta_daily(
    daily: DataFrame, factors: DataFrame, months: int = 3, min_obs: int = 50, min_history: int | None = None
) -> DataFrame:
    """Rolling slope over the days of ``months`` calendar months, one row per month.

    Days are first reduced to monthly sums, which are aggregated map-side; the window then runs over months.
    """
    data = keep_min_rows(daily, "permno", min_history) if min_history else daily
    data = with_market(data.select("permno", "month", "date", Y), factors, "date", CENTRED)
    terms = _pair_terms()
    monthly = data.groupBy("permno", "month").agg(*[F.sum(t).alias(k) for k, t in terms.items()])
    monthly = monthly.withColumn("__mi", month_index("month"))
    out = rolling_sums(monthly, {k: F.col(k) for k in terms}, "permno", "__mi", ("range", -(months - 1), 0))
    out = out.where(F.col("n") >= min_obs)
    return out.select("permno", "month", _slope().alias("beta_daily"), F.col("n").cast("long").alias("n_obs")).dropna(subset=["beta_daily"])


def beta_trailing_days(daily: DataFrame, factors: DataFrame, days: int = 90, min_obs: int = 50) -> DataFrame:
    """Slope over the ``days`` rows before the current one."""
    data = with_market(daily.select("permno", "date", Y), factors, "date", CENTRED)
    out = rolling_sums(data, _pair_terms(), "permno", "date", ("rows", -days, -1))
    return out.where(F.col("n") >= min_obs).select("permno", "date", _slope().alias("beta")).dropna(subset=["beta"])


def beta_table(monthly: DataFrame, daily: DataFrame) -> DataFrame:
    left = monthly.select("permno", "month", "beta_monthly")
    return left.join(daily.select("permno", "month", "beta_daily"), ["permno", "month"], "full")


def beta_examples(betas: DataFrame, examples: DataFrame) -> DataFrame:
    """Betas of a short list of named securities."""
    return betas.join(examples, "permno")


def beta_by_industry(betas: DataFrame, panel: DataFrame) -> DataFrame:
    """Mean beta of each security within its industry."""
    joined = betas.where("beta_monthly IS NOT NULL").join(panel.select("permno", "month", "industry"), ["permno", "month"])
    return joined.groupBy("industry", "permno").agg(F.avg("beta_monthly").alias("beta_monthly"))


def industry_order(by_industry: DataFrame) -> DataFrame:
    """Industries by the median of their securities' mean betas."""
    medians = exact_quantiles(by_industry, "beta_monthly", [0.5], ["industry"], "__q")
    return medians.select("industry", F.col("__q")[0].alias("median_beta")).orderBy("median_beta")


def beta_deciles(betas: DataFrame) -> DataFrame:
    """Monthly 10%...90% quantiles."""
    probs = [k / 10 for k in range(1, 10)]
    out = quantile_rows(betas, "beta_monthly", probs, ["month"], "p", "beta_monthly")
    return out.select("month", F.round(F.col("p") * 100).cast("int").alias("quantile"), "beta_monthly")


def beta_decile_floors(betas: DataFrame) -> DataFrame:
    """Smallest beta of each of the ten equal-count buckets from high to low, last bucket left out."""
    ranked = ntile(betas, "beta_monthly", 10, ["month"], "permno", "__d", descending=True)
    out = ranked.withColumn("quantile", F.col("__d") * 10).groupBy("month", "quantile").agg(F.min("beta_monthly").alias("x"))
    return out.where("quantile <> 100")


def beta_long(betas: DataFrame, ids: Sequence[str] = ("permno", "month")) -> DataFrame:
    return to_long(betas.select(*ids, *BETAS), ids, BETAS)


def beta_comparison(betas: DataFrame, examples: DataFrame, start: str) -> DataFrame:
    """Known betas of named securities in long form from ``start`` on."""
    named = beta_examples(betas, examples).where(F.col("month") >= F.lit(start).cast("date"))
    return beta_long(named, ("permno", "company", "month")).where("value IS NOT NULL")


def beta_panel_long(panel: DataFrame, betas: DataFrame) -> DataFrame:
    joined = panel.select("permno", "month").join(betas, ["permno", "month"], "left")
    return beta_long(joined)


def beta_coverage(panel: DataFrame, betas: DataFrame) -> DataFrame:
    """Share of securities with a beta, per month and kind."""
    return beta_panel_long(panel, betas).groupBy("month", "name").agg(share_known("value").alias("share"))


def beta_summary(panel: DataFrame, betas: DataFrame, **options) -> DataFrame:
    return summarize(beta_panel_long(panel, betas), "value", ["name"], **options)


def beta_correlation(betas: DataFrame) -> DataFrame:
    return betas.agg(F.corr("beta_monthly", "beta_daily").alias("corr"))
