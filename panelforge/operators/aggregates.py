"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.joins import join_groups
from panelforge.operators.quantiles import MAX_GROUP_ROWS, exact_quantiles, profile_groups

SUMMARY_QUANTILES = {"q05": 0.05, "q50": 0.50, "q95": 0.95}


def weighted_mean(value: str, weight: str | None) -> Column:
    """Sum of value times weight over sum of weight, using only rows where both are known."""
    if weight is None:
        return F.avg(value)
    known = F.col(value).isNotNull() & F.col(weight).isNotNull()
    total = F.sum(F.when(known, F.col(weight)))
    return F.sum(F.when(known, F.col(value) * F.col(weight))) / F.nullif(total, F.lit(0.0))


def moments(value: str, template: str = "{fn}") -> list[Column]:
    """Mean, sample standard deviation, minimum and maximum, named by ``template``."""
    parts = {"mean": F.avg(value), "sd": F.stddev_samp(value), "min": F.min(value), "max": F.max(value)}
    return [column.alias(template.format(fn=fn)) for fn, column in parts.items()]


def summarize(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    quantiles: dict[str, float] = SUMMARY_QUANTILES,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mean, sd, min, quantiles, max and number of known values per group."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias(value))
    plain = [*moments(value), F.count(value).alias("n")]
    profile = profile_groups(rows, by)
    if profile.largest <= max_group_rows:
        array = F.percentile(value, F.array(*[F.lit(p) for p in quantiles.values()])).alias("__q")
        table = rows.groupBy(*by).agg(*plain, array)
    else:
        arrays = exact_quantiles(rows, value, list(quantiles.values()), by, "__q", max_group_rows, profile)
        table = rows.groupBy(*by).agg(*plain)
        table = join_groups(table, arrays, by) if by else table.withColumn("__q", arrays.scalar())
    picked = [F.col("__q")[i].alias(label) for i, label in enumerate(quantiles)]
    return table.select(*by, "mean", "sd", "min", *picked, "max", "n")


def summarize_with_overall(df: DataFrame, value: str, group: str, label: str = "Overall", **options) -> DataFrame:
    """Summary per group and one row for all groups together."""
    spread = df.select(F.explode(F.array(F.col(group), F.lit(label))).alias(group), value)
    return summarize(spread, value, [group], **options)


def share_known(value: str) -> Column:
    return F.count(value) / F.count(F.lit(1))


def distinct_share(entity: str, condition: Column) -> Column:
    """Share of distinct entities that satisfy ``condition`` at least once."""
    return F.count_distinct(F.when(condition, F.col(entity))) / F.count_distinct(F.col(entity))


def share_of_group(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """``value`` over its group total.

    The total is aggregated map-side and joined back, so a group is never sorted or gathered in one task.
    """
    totals = df.groupBy(*by).agg(F.sum(value).alias("__total"))
    return df.join(totals, list(by)).withColumn(name, F.col(value) / F.nullif(F.col("__total"), F.lit(0.0))).drop("__total")


def keep_group_maximum(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Rows at the maximum of their group; ties are kept."""
    best = df.groupBy(*by).agg(F.max(value).alias(value))
    return df.join(best, [*by, value], "left_semi")


def keep_global_maximum(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) == df.agg(F.max(value)).scalar())


def keep_full_history(df: DataFrame, entity: str) -> DataFrame:
    """Entities with as many rows as the entity that has most."""
    counts = df.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
    complete = counts.where(F.col("__n") == counts.agg(F.max("__n")).scalar())
    return df.join(complete, entity, "left_semi")


def keep_min_rows(df: DataFrame, entity: str, at_least: int) -> DataFrame:
    counts = df.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
    return df.join(counts.where(F.col("__n") >= at_least), entity, "left_semi")


def rescale_to_last(df: DataFrame, value: str, period: str) -> DataFrame:
    """Divide a series by its value in the last period."""
    return df.withColumn(value, F.col(value) / df.agg(F.max_by(value, period)).scalar())
