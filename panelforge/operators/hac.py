"""Autocorrelation-robust standard errors for regressions on a time series.

A series has one row per period, which is checked, so the calendar bounds each group; groups (portfolios) run in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.joins import one_row_per_group


def bartlett_weights(lag: int) -> np.ndarray:
    return 1 - np.arange(lag + 1) / (lag + 1)


def _first_order(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residuals and coefficients of a first-order vector autoregression without constant."""
    coefficients = np.linalg.lstsq(u[:-1], u[1:], rcond=None)[0]
    return u[1:] - u[:-1] @ coefficients, coefficients.T


def automatic_lag(scores: np.ndarray, has_constant: bool, prewhite: bool) -> int:
    """Data-driven Bartlett bandwidth (Newey and West, 1994)."""
    n, k = scores.shape
    first_stage = int(np.floor((3 if prewhite else 4) * (n / 100) ** (2 / 9)))
    u = _first_order(scores)[0] if prewhite else scores
    weights = np.ones(k)
    if has_constant and k > 1:
        weights[0] = 0.0
    h = u @ weights
    size = len(h)
    sigma = np.array([h[: size - j] @ h[j:] / size for j in range(first_stage + 1)])
    s0 = sigma[0] + 2 * sigma[1:].sum()
    s1 = 2 * (np.arange(1, first_stage + 1) * sigma[1:]).sum()
    return int(np.floor(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)))


def long_run_covariance(scores: np.ndarray, lag: int, prewhite: bool) -> np.ndarray:
    n, k = scores.shape
    u, recolour = scores, np.eye(k)
    if prewhite:
        u, coefficients = _first_order(scores)
        recolour = np.linalg.inv(np.eye(k) - coefficients)
    weights = bartlett_weights(min(lag, len(u) - 1)) if lag else np.ones(1)
    half = 0.5 * weights[0] * (u.T @ u)
    for j, w in enumerate(weights[1:], start=1):
        half = half + w * (u[:-j].T @ u[j:])
    return recolour @ (half + half.T) @ recolour.T / n


def newey_west(
    df: DataFrame,
    y: str,
    xs: Sequence[str] = (),
    time: str = "month",
    by: Sequence[str] = (),
    lag: int | None = None,
    prewhite: bool = True,
) -> DataFrame:
    """Regression of ``y`` on a constant and ``xs`` per group with HAC standard errors.

    ``lag=None`` chooses the bandwidth from the data.  Rows without a period have no place in a series and are left out;
    two rows for one period fail the job.
    """
    terms = ["const", *xs]
    keys = list(by)
    rows = df.dropna(how="any", subset=[time, y, *xs]).select(*keys, time, y, *xs)
    rows = one_row_per_group(rows, [*keys, time])
    if not keys:
        rows, keys = rows.withColumn("__all", F.lit(0)), ["__all"]

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(time)
        design = np.column_stack([np.ones(len(group)), *[group[x].to_numpy(float) for x in xs]])
        target = group[y].to_numpy(float)
        n, k = design.shape
        out = pd.DataFrame({c: [group[c].iloc[0]] * k for c in keys})
        out["term"], out["n"] = terms, n
        if n <= k + 1:
            return out.assign(estimate=None, std_error=None, t_stat=None, lag=None)
        bread = np.linalg.inv(design.T @ design)
        beta = bread @ design.T @ target
        scores = design * (target - design @ beta)[:, None]
        bandwidth = automatic_lag(scores, True, prewhite) if lag is None else lag
        covariance = n * bread @ long_run_covariance(scores, bandwidth, prewhite) @ bread
        se = np.sqrt(np.diag(covariance))
        return out.assign(estimate=beta, std_error=se, t_stat=beta / se, lag=bandwidth)

    key_schema = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys]
    schema = ", ".join([*key_schema, "term string", "estimate double", "std_error double", "t_stat double", "lag int", "n long"])
    result = rows.groupBy(*keys).applyInPandas(lambda g: fit(g)[[*keys, "term", "estimate", "std_error", "t_stat", "lag", "n"]], schema)
    return result if by else result.drop("__all")
