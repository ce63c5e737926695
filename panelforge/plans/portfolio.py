"""Minimum-variance and efficient portfolios from monthly returns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.covariance import covariance_matrix

# Target return multiple, and the grid of combinations of the two portfolios.
TARGET_MULTIPLE = 3.0
FRONTIER_START, FRONTIER_STEP, FRONTIER_POINTS = -0.4, 0.01, 231
MONTHS_PER_YEAR = 12


def _two_funds(group: pd.DataFrame) -> pd.DataFrame:
    means = group[group["j"].isna()].set_index("i")["x"].sort_index()
    pairs = group[group["j"].notna()]
    sigma = pairs.pivot(index="i", columns="j", values="x").loc[means.index, means.index].to_numpy(float)
    mu = means.to_numpy(float)
    inverse = np.linalg.inv(sigma)
    iota = np.ones(len(mu))
    c, d, e = iota @ inverse @ iota, iota @ inverse @ mu, mu @ inverse @ mu
    mvp = inverse @ iota / c
    target = TARGET_MULTIPLE * (mvp @ mu)
    tilt = 2 * (target - d / c) / (e - d**2 / c)
    efficient = mvp + tilt / 2 * (inverse @ mu - d * mvp)
    return pd.DataFrame(
        {
            "symbol": means.index, "mvp": mvp, "efficient": efficient,
            "mu": mu, "cov_mvp": sigma @ mvp, "cov_efficient": sigma @ efficient,
        }
    )


def two_funds(returns: DataFrame) -> DataFrame:
    """Weights of the minimum-variance portfolio and of the one with three times its mean.

    The covariance matrix can only be inverted with fewer assets than months, so the matrix that is solved in one
    task is bounded by the calendar; a wider universe is refused because it has no unique solution.
    """
    size = returns.agg(F.count_distinct("symbol").alias("assets"), F.count_distinct("month").alias("months")).first()
    if size["assets"] >= size["months"]:
        raise ValueError("fewer assets than months are needed for an invertible covariance matrix")
    cov = covariance_matrix(returns, "symbol", "month", "ret").select("i", "j", F.col("cov").alias("x"))
    key = returns.schema["symbol"].dataType.simpleString()
    mean = returns.groupBy(F.col("symbol").alias("i")).agg(F.avg("ret").alias("x"))
    mean = mean.select("i", F.lit(None).cast(key).alias("j"), "x")
    schema = f"symbol {key}, mvp double, efficient double, mu double, cov_mvp double, cov_efficient double"
    return cov.unionByName(mean).withColumn("universe", F.lit(0)).groupBy("universe").applyInPandas(_two_funds, schema)


def portfolio_weights(funds: DataFrame) -> DataFrame:
    return funds.select("symbol", "mvp", "efficient")


def minimum_variance_performance(funds: DataFrame) -> DataFrame:
    return funds.agg(
        F.sum(F.col("mvp") * F.col("mu")).alias("average_ret"), F.sqrt(F.sum(F.col("mvp") * F.col("cov_mvp"))).alias("volatility")
    )


def efficient_frontier(funds: DataFrame) -> DataFrame:
    """Annualised mean and deviation in percent of the combinations of the two portfolios."""
    moments = funds.agg(
        F.sum(F.col("mvp") * F.col("mu")).alias("m1"),
        F.sum(F.col("efficient") * F.col("mu")).alias("m2"),
        F.sum(F.col("mvp") * F.col("cov_mvp")).alias("v11"),
        F.sum(F.col("efficient") * F.col("cov_mvp")).alias("v12"),
        F.sum(F.col("efficient") * F.col("cov_efficient")).alias("v22"),
    )
    grid = moments.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(FRONTIER_POINTS - 1))))
    grid = grid.withColumn("c", F.round(F.lit(FRONTIER_START) + F.col("k") * FRONTIER_STEP, 2))
    a, b = 1 - F.col("c"), F.col("c")
    variance = a * a * F.col("v11") + 2 * a * b * F.col("v12") + b * b * F.col("v22")
    return grid.select(
        "c",
        (MONTHS_PER_YEAR * 100 * (a * F.col("m1") + b * F.col("m2"))).alias("mu"),
        (100 * F.sqrt(F.lit(float(MONTHS_PER_YEAR))) * F.sqrt(variance)).alias("sd"),
    )
