"""Least squares from aggregated cross products.

The data never leave the executors: every estimator first reduces them to sums of products per group, cluster or
entity (partially aggregated before the shuffle), and only a matrix as wide as the number of regressors reaches the
driver, where it is solved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = "model string, term string, estimate double, std_error double, t_stat double, n long"


def simple_fit(y: str, x: str) -> list[Column]:
    """Aggregates of one-regressor least squares, with iid standard errors."""
    slope, intercept = F.regr_slope(y, x), F.regr_intercept(y, x)
    n, sxx, syy, sxy = F.regr_count(y, x), F.regr_sxx(y, x), F.regr_syy(y, x), F.regr_sxy(y, x)
    variance = (syy - sxy * sxy / F.nullif(sxx, F.lit(0.0))) / F.nullif(n - 2, F.lit(0))
    mean_x = F.regr_avgx(y, x)
    return [
        intercept.alias("intercept"),
        slope.alias("slope"),
        F.sqrt(variance / F.nullif(sxx, F.lit(0.0))).alias("se_slope"),
        F.sqrt(variance * (1 / F.nullif(n, F.lit(0)) + mean_x * mean_x / F.nullif(sxx, F.lit(0.0)))).alias("se_intercept"),
        F.regr_r2(y, x).alias("r2"),
        n.alias("n"),
    ]


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


@dataclass(frozen=True)
class Fit:
    """Coefficients with the pieces that the covariance estimators need."""

    terms: list[str]
    beta: np.ndarray
    bread: np.ndarray
    residual_ss: float
    n: int

    def iid(self, absorbed: int = 0) -> np.ndarray:
        free = self.n - len(self.terms) - absorbed
        return self.residual_ss / free * self.bread

    def table(self, spark: SparkSession, covariance: np.ndarray, model: str) -> DataFrame:
        se = np.sqrt(np.diag(covariance))
        rows = [
            (model, term, float(b), float(s), float(b / s), self.n)
            for term, b, s in zip(self.terms, self.beta, se, strict=True)
        ]
        return spark.createDataFrame(rows, RESULT_SCHEMA)


def _products(columns: Sequence[str]) -> dict[str, Column]:
    return {
        f"p_{i}_{j}": F.sum(F.col(a) * F.col(b)) for i, a in enumerate(columns) for j, b in enumerate(columns) if j >= i
    }


def _matrix(row, width: int) -> np.ndarray:
    out = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            out[i, j] = out[j, i] = row[f"p_{i}_{j}"]
    return out


def fit_products(df: DataFrame, y: str, xs: Sequence[str]) -> Fit:
    """Least squares of ``y`` on ``xs`` as given (no constant is added)."""
    columns = [*xs, y]
    products = _products(columns)
    row = df.agg(*[c.alias(k) for k, c in products.items()], F.count(F.lit(1)).alias("n")).first()
    gram = _matrix(row, len(columns))
    xx, xy, yy = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1]
    bread = np.linalg.inv(xx)
    beta = bread @ xy
    return Fit(list(xs), beta, bread, float(yy - beta @ xy), row["n"])


def with_constant(df: DataFrame) -> DataFrame:
    return df.withColumn("const", F.lit(1.0))


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> Fit:
    """Pooled least squares with a constant, computed around the means for precision."""
    rows = complete_rows(df, [y, *xs])
    columns = [*xs, y]
    stats = [F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)] + [F.count(F.lit(1)).alias("n")]
    stats += [
        F.covar_pop(a, b).alias(f"p_{i}_{j}") for i, a in enumerate(columns) for j, b in enumerate(columns) if j >= i
    ]
    row = rows.agg(*stats).first()
    n, means = row["n"], np.array([row[f"m_{i}"] for i in range(len(columns))])
    centred = _matrix(row, len(columns)) * n
    slopes = np.linalg.solve(centred[:-1, :-1], centred[:-1, -1])
    inverse = np.linalg.inv(centred[:-1, :-1])
    mean_x = means[:-1]
    beta = np.concatenate([[means[-1] - mean_x @ slopes], slopes])
    bread = np.block([[np.array([[1 / n + mean_x @ inverse @ mean_x]]), -(mean_x @ inverse)[None, :]], [-(inverse @ mean_x)[:, None], inverse]])
    return Fit(["const", *xs], beta, bread, float(centred[-1, -1] - slopes @ centred[:-1, -1]), n)


def cluster_meat(df: DataFrame, y: str, fit: Fit, cluster: Sequence[str]) -> tuple[np.ndarray, int]:
    """Sum over clusters of the outer product of score sums, and the number of clusters.

    The score sum of a cluster is ``X'y - X'X b``, so one aggregation per cluster is enough and rows need not be
    touched again once the coefficients are known.
    """
    xs, k = fit.terms, len(fit.terms)
    sums = {f"xy_{i}": F.sum(F.col(x) * F.col(y)) for i, x in enumerate(xs)}
    sums |= {f"xx_{i}_{j}": F.sum(F.col(a) * F.col(b)) for i, a in enumerate(xs) for j, b in enumerate(xs) if j >= i}
    per_cluster = df.groupBy(*cluster).agg(*[c.alias(name) for name, c in sums.items()])
    scores = []
    for i in range(k):
        score = F.col(f"xy_{i}")
        for j in range(k):
            score = score - F.col(f"xx_{min(i, j)}_{max(i, j)}") * float(fit.beta[j])
        scores.append(score.alias(f"s_{i}"))
    outer = [F.sum(F.col(f"s_{i}") * F.col(f"s_{j}")).alias(f"p_{i}_{j}") for i in range(k) for j in range(i, k)]
    row = per_cluster.select(*scores).agg(*outer, F.count(F.lit(1)).alias("g")).first()
    return _matrix(row, k), row["g"]


def positive_part(covariance: np.ndarray) -> np.ndarray:
    """The nearest positive semi-definite matrix: negative eigenvalues become zero."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    return (vectors * np.clip(values, 0, None)) @ vectors.T


def cluster_covariance(
    df: DataFrame, y: str, fit: Fit, clusters: Sequence[str], estimated: int | None = None, small_sample: bool = True, repair: bool = False
) -> np.ndarray:
    """Cluster-robust covariance for one or two cluster variables.

    With two the matrix is a difference, which may have negative variances; ``repair`` then clips its eigenvalues at zero.

    With ``small_sample`` the result is scaled by ``(n-1)/(n-K)`` and ``G/(G-1)``, where K is ``estimated`` (default:
    the number of coefficients) and G the smaller number of clusters.
    """
    if len(clusters) == 1:
        parts = [(1.0, cluster_meat(df, y, fit, clusters))]
    elif len(clusters) == 2:
        first, second = clusters
        parts = [
            (1.0, cluster_meat(df, y, fit, [first])),
            (1.0, cluster_meat(df, y, fit, [second])),
            (-1.0, cluster_meat(df, y, fit, [first, second])),
        ]
    else:
        raise ValueError("one or two cluster variables")
    smallest = min(g for _, (_, g) in parts)
    covariance = fit.bread @ sum(sign * meat for sign, (meat, _) in parts) @ fit.bread
    if repair:
        covariance = positive_part(covariance)
    if not small_sample:
        return covariance
    k = len(fit.terms) if estimated is None else estimated
    return covariance * (smallest / (smallest - 1)) * ((fit.n - 1) / (fit.n - k))


def winsorize(df: DataFrame, columns: Sequence[str], cut: float, max_group_rows: int | None = None) -> DataFrame:
    """Clip each column over the whole sample: above at its ``1 - cut`` quantile, then below at the ``cut`` quantile
    of the clipped column.

    Clipping above moves only values over the upper quantile, so for ``cut < 0.5`` the second quantile is that of
    the original column unless interpolation reaches a clipped value; it is therefore taken from the clipped column.
    """
    from panelforge.functions.scalars import clip
    from panelforge.operators.quantiles import MAX_GROUP_ROWS, exact_quantiles

    if not 0 <= cut < 0.5:
        raise ValueError("cut must lie in [0, 0.5)")
    bound = max_group_rows or MAX_GROUP_ROWS
    long = df.unpivot([], list(columns), "__column", "__x")
    high = {r["__column"]: r["q"][0] for r in exact_quantiles(long, "__x", [1 - cut], ["__column"], "q", bound).collect()}
    capped = long
    for column, limit in high.items():
        capped = capped.withColumn("__x", F.when((F.col("__column") == column) & (F.col("__x") > limit), limit).otherwise(F.col("__x")))
    low = {r["__column"]: r["q"][0] for r in exact_quantiles(capped, "__x", [cut], ["__column"], "q", bound).collect()}
    return df.withColumns({c: clip(F.col(c), F.lit(low[c]), F.lit(high[c])) for c in columns if c in high})
