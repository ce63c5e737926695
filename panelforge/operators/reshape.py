"""Wide and long forms."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.quantiles import number_rows


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def to_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, labels: Sequence) -> DataFrame:
    """One column per label; labels are given, so no extra job looks for them."""
    return df.groupBy(*ids).pivot(name, list(labels)).agg(F.first(value))


def map_columns(df: DataFrame, columns: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in columns})


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def rename_all(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def nest(df: DataFrame, by: Sequence[str], order: str, name: str = "data") -> DataFrame:
    """Rows of each group as one sorted array; for groups that the calendar bounds."""
    inner = [order, *[c for c in df.columns if c not in by and c != order]]
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*inner))).alias(name))


def nest_pieces(df: DataFrame, by: Sequence[str], order: str, rows: int = 100_000, name: str = "data") -> DataFrame:
    """Rows of each group as sorted arrays of ``rows`` rows, numbered by ``piece`` from 0: for groups of any size."""
    numbered = number_rows(df, list(by), [F.col(order)]).withColumn("piece", F.floor(F.col("__place") / rows))
    inner = ["__place", order, *[c for c in df.columns if c not in by and c != order]]
    arrays = numbered.groupBy(*by, "piece").agg(F.sort_array(F.collect_list(F.struct(*inner))).alias(name))
    return arrays.withColumn(name, F.transform(name, lambda e: e.dropFields("__place")))


def unnest(df: DataFrame, name: str = "data") -> DataFrame:
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(name).alias("__e")).select(*rest, "__e.*")


def unnest_parallel(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows from several arrays of equal length."""
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.explode(F.arrays_zip(*names)).alias("__e")).select(*rest, *[F.col("__e")[n].alias(n) for n in names])
