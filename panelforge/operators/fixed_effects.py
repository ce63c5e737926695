"""Panel regressions with absorbed effects.

One-way effects need no demeaned rows at all: centred cross products per entity add up to the within moments.
Two-way effects are solved directly instead of by alternating projections.  After demeaning by entity, the period
effects are ordinary regressors, as many as the calendar has periods; their normal equations are accumulated from
counts per (entity, period), solved once, and the residualised rows follow from one broadcast of the period effects.
Beyond ``DENSE_PERIODS`` the equations are not written out but solved by conjugate gradients, whose every step is two
aggregates over the counts; the driver then holds one number per period and column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.regression import Fit, complete_rows, fit_products
from panelforge.storage import materialize

DENSE_PERIODS = 2_000

#: Conjugate gradients end when the residual has shrunk to this share.
TOLERANCE = 1e-13


def within_fit(df: DataFrame, y: str, xs: Sequence[str], entity: str) -> tuple[Fit, int]:
    """Entity fixed-effect estimate and the number of entities, from one aggregation per entity."""
    rows = complete_rows(df, [entity, y, *xs])
    columns = [*xs, y]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    per_entity = rows.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.covar_pop(columns[i], columns[j]).alias(f"p_{i}_{j}") for i, j in pairs],
    )
    total = per_entity.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("entities"),
        *[F.sum(F.col(f"p_{i}_{j}") * F.col("n")).alias(f"p_{i}_{j}") for i, j in pairs],
    ).first()
    gram = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = total[f"p_{i}_{j}"]
    bread = np.linalg.inv(gram[:-1, :-1])
    beta = bread @ gram[:-1, -1]
    fit = Fit(list(xs), beta, bread, float(gram[-1, -1] - beta @ gram[:-1, -1]), total["n"])
    return fit, total["entities"]


def demean(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Deviations from group means; means are aggregated map-side and joined back."""
    means = df.groupBy(by).agg(*[F.avg(c).alias(f"__m_{c}") for c in columns])
    return (
        df.join(means, by)
        .withColumns({c: F.col(c) - F.col(f"__m_{c}") for c in columns})
        .drop(*[f"__m_{c}" for c in columns])
    )


def _period_equations(periods: list):
    """Per-batch partial sums of the cross products of the entity-demeaned period indicators."""
    position = {p: i for i, p in enumerate(periods)}
    size = len(periods)

    def accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            for ids, counts in zip(batch["periods"], batch["counts"], strict=True):
                at = np.fromiter((position[p] for p in ids), dtype=int, count=len(ids))
                n = np.asarray(counts, dtype=float)
                total[at, at] += n
                total[np.ix_(at, at)] -= np.outer(n, n) / n.sum()
        yield pd.DataFrame({"i": np.arange(size), "row": [line.tobytes() for line in total]})

    return accumulate


def _added_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Packed rows with the same number as their sum."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch["i"], batch["row"], strict=True):
            line = np.frombuffer(row)
            total[i] = total[i] + line if i in total else line
    yield pd.DataFrame({"i": list(total), "row": [line.tobytes() for line in total.values()]})


def _roots(links: Iterator[tuple]) -> dict:
    """The smallest node joined to each node that a link names."""
    above: dict = {}

    def root(x):
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        above[high] = low
    return {x: root(x) for x in above}


def _forest(position: dict):
    """As few links as keep together what an entity of the task was seen in: at most one for each period."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = ([position[p] for p in entity] for batch in batches for entity in batch["periods"])
        roots = _roots((entity[0], p) for entity in seen for p in entity)
        yield pd.DataFrame({"a": list(roots.values()), "b": list(roots)}, dtype="int64")

    return links


def connected_parts(cells: DataFrame, entity: str, period: str, periods: list) -> int:
    """Number of parts of the panel that share neither an entity nor a period.

    Every entity joins the periods it was seen in.  Each task reduces those links to a spanning forest of the calendar, so
    the driver receives distinct links, a few per period.
    """
    per_entity = cells.groupBy(entity).agg(F.collect_set(period).alias("periods")).select("periods")
    forest = per_entity.mapInPandas(_forest({p: k for k, p in enumerate(periods)}), "a long, b long").distinct()
    return len(set(_roots((r["a"], r["b"]) for r in forest.collect()).values()))


def _solved_densely(cells: DataFrame, entity: str, period: str, periods: list, right: np.ndarray) -> np.ndarray:
    per_entity = cells.groupBy(entity).agg(F.collect_list(F.struct(F.col(period).alias("p"), "n")).alias("e"))
    per_entity = per_entity.select(F.col("e.p").alias("periods"), F.col("e.n").alias("counts"))
    parts = per_entity.mapInPandas(_period_equations(periods), "i int, row binary")
    left = np.zeros((len(periods), len(periods)))
    for r in parts.repartition("i").mapInPandas(_added_up, "i int, row binary").collect():
        left[r["i"]] = np.frombuffer(r["row"])
    return np.linalg.lstsq(left, right, rcond=None)[0]


def _lookup(spark: SparkSession, cells: DataFrame, period: str, periods: list, values: np.ndarray, names: Sequence[str]) -> DataFrame:
    """One row per period with a column of ``values`` each."""
    schema = ", ".join([f"`{period}` {cells.schema[period].dataType.simpleString()}", *[f"{n} double" for n in names]])
    return spark.createDataFrame([(p, *map(float, values[i])) for i, p in enumerate(periods)], schema)


def _solved_by_gradients(cells: DataFrame, entity: str, period: str, periods: list, right: np.ndarray) -> np.ndarray:
    """Conjugate gradients for all columns side by side, scaled by the counts per period.

    The equations are singular (effects are known up to a constant for each connected part of the panel) but consistent,
    so the iteration from zero converges to a solution, and every solution gives the same residuals.
    """
    spark, k = cells.sparkSession, right.shape[1]
    position = {p: i for i, p in enumerate(periods)}
    count = np.zeros(len(periods))
    for r in cells.groupBy(period).agg(F.sum("n").alias("n")).collect():
        count[position[r[period]]] = r["n"]
    names = [f"__v{c}" for c in range(k)]

    def times(v: np.ndarray) -> np.ndarray:
        placed = cells.join(F.broadcast(_lookup(spark, cells, period, periods, v, names)), period)
        means = placed.groupBy(entity).agg(*[(F.sum(F.col(n) * F.col("n")) / F.sum("n")).alias(n) for n in names])
        back = cells.join(means, entity).groupBy(period).agg(*[F.sum(F.col(n) * F.col("n")).alias(n) for n in names])
        out = count[:, None] * v
        for r in back.collect():
            out[position[r[period]]] -= [r[n] for n in names]
        return out

    solution, residual = np.zeros_like(right), right.copy()
    scaled = residual / count[:, None]
    direction, size = scaled.copy(), (residual * scaled).sum(axis=0)
    goal = TOLERANCE**2 * size
    for _ in range(2 * len(periods)):
        if (size <= goal).all():
            break
        image = times(direction)
        along = (direction * image).sum(axis=0)
        step = np.divide(size, along, out=np.zeros(k), where=(along > 0) & (size > goal))
        solution, residual = solution + step * direction, residual - step * image
        scaled = residual / count[:, None]
        before, size = size, (residual * scaled).sum(axis=0)
        turn = np.divide(size, before, out=np.zeros(k), where=before > 0)
        direction = scaled + turn * direction
    else:
        raise RuntimeError("period effects did not converge")
    return solution


@dataclass(frozen=True)
class Effects:
    """Sizes of a two-way panel: entities, periods, and parts that share neither."""

    entities: int
    periods: int
    parts: int

    @property
    def rank(self) -> int:
        """Independent effects: one is lost for every part."""
        return self.entities + self.periods - self.parts


def residualize_two_way(
    df: DataFrame, columns: Sequence[str], entity: str, period: str, dense_periods: int = DENSE_PERIODS
) -> tuple[DataFrame, Effects]:
    """Remove entity and period effects, balanced or not, connected or not, with any number of periods.

    Returns the rows with residualised columns and the sizes of the panel.  Rows are first
    counted and summed per (entity, period), so what is gathered for one entity is bounded by the calendar.
    """
    spark = df.sparkSession
    within = materialize(demean(df.select(entity, period, *columns), columns, entity), "within")
    sums = [F.sum(c).alias(f"__s{k}") for k, c in enumerate(columns)]
    per_period = within.groupBy(period).agg(*sums).orderBy(period).collect()
    periods = [r[period] for r in per_period]
    right = np.array([[r[f"__s{k}"] for k in range(len(columns))] for r in per_period])

    cells = materialize(within.groupBy(entity, period).agg(F.count(F.lit(1)).alias("n")), "cells")
    entities = cells.select(entity).distinct().count()
    if len(periods) <= dense_periods:
        effects = _solved_densely(cells, entity, period, periods, right)
    else:
        effects = _solved_by_gradients(cells, entity, period, periods, right)
    names = [f"__g_{c}" for c in columns]
    lookup = _lookup(spark, within, period, periods, effects, names)
    joined = demean(within.join(F.broadcast(lookup), period), names, entity)
    out = joined.withColumns({c: F.col(c) - F.col(f"__g_{c}") for c in columns}).drop(*names)
    return out, Effects(entities, len(periods), connected_parts(cells, entity, period, periods))


def two_way_fit(df: DataFrame, y: str, xs: Sequence[str], entity: str, period: str) -> tuple[Fit, DataFrame, Effects]:
    """Two-way fixed-effect estimate, the residualised rows, and the sizes of the panel."""
    rows = complete_rows(df, [entity, period, y, *xs])
    residual, effects = residualize_two_way(rows, [*xs, y], entity, period)
    residual = materialize(residual, "residual")
    return fit_products(residual, y, xs), residual, effects
