"""Covariance matrices of many series, in long form.

Assets are hashed into blocks, and each pair of blocks is multiplied as two dense matrices with one row per period.
A task holds (periods x block size) numbers, and no row per pair of assets and period is ever produced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 256


def covariance_matrix(returns: DataFrame, entity: str, period: str, value: str, block: int = BLOCK) -> DataFrame:
    """Sample covariance for every ordered pair of entities as rows ``(i, j, cov)``.

    A pair with a period where only one of them is observed gets NULL, as a covariance over incomplete rows would.
    """
    rows = returns.select(F.col(entity).alias("a"), F.col(period).alias("t"), F.col(value).cast("double").alias("x"))
    size = rows.agg(F.count_distinct("a").alias("assets"), F.count_distinct("t").alias("periods")).first()
    blocks, periods = max(1, math.ceil(size["assets"] / block)), size["periods"]
    blocked = rows.withColumn("b", F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int"))
    vectors = blocked.groupBy("b", "t").agg(F.collect_list("a").alias("ids"), F.collect_list("x").alias("xs"))
    left = vectors.select(F.col("b").alias("bi"), "t", F.col("ids").alias("ids_i"), F.col("xs").alias("xs_i"))
    right = vectors.select(F.col("b").alias("bj"), "t", F.col("ids").alias("ids_j"), F.col("xs").alias("xs_j"))
    pairs = left.join(right, "t").where("bi <= bj")
    entity_type = returns.schema[entity].dataType.simpleString()

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        x, names_i = _dense(group["ids_i"], group["xs_i"])
        y, names_j = _dense(group["ids_j"], group["xs_j"])
        x, y = x - x.mean(axis=0), y - y.mean(axis=0)
        product = x.T @ y / max(len(x) - 1, 1) if len(x) == periods else np.full((len(names_i), len(names_j)), np.nan)
        i, j, cov = np.repeat(names_i, len(names_j)), np.tile(names_j, len(names_i)), product.ravel()
        if group["bi"].iloc[0] != group["bj"].iloc[0]:
            i, j, cov = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([cov, cov])
        return pd.DataFrame({"i": i, "j": j, "cov": cov})

    out = pairs.groupBy("bi", "bj").applyInPandas(multiply, f"i {entity_type}, j {entity_type}, cov double")
    return out.withColumn("cov", F.when(~F.isnan("cov"), F.col("cov")))


def _dense(ids: pd.Series, values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Period by asset matrix with NaN where an asset has no value."""
    names = np.unique(np.concatenate([np.asarray(i, dtype=object) for i in ids]))
    position = {name: k for k, name in enumerate(names)}
    out = np.full((len(ids), len(names)), np.nan)
    for row, (who, what) in enumerate(zip(ids, values, strict=True)):
        out[row, [position[w] for w in who]] = what
    return out, names
