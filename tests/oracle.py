"""Side-by-side comparison with DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def make_session(cores: str = "8", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelforge")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for name in TABLES:
        duck.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return duck


def canonical(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, list | tuple):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, datetime.datetime | datetime.date):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, int | float):
        return repr(float(value))
    return str(value)


def compare(found: pd.DataFrame, expected: pd.DataFrame) -> str:
    """``ok`` or a short description of the first difference."""
    if sorted(found.columns) != sorted(expected.columns):
        return f"columns {sorted(found.columns)} != {sorted(expected.columns)}"
    columns = sorted(found.columns)
    ours = sorted(tuple(canonical(v) for v in row) for row in found[columns].itertuples(index=False))
    theirs = sorted(tuple(canonical(v) for v in row) for row in expected[columns].itertuples(index=False))
    if len(ours) != len(theirs):
        only = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
        return f"rows {len(ours)} != {len(theirs)} {only}"
    if ours != theirs:
        left, right = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
        return f"{len(left)} rows differ: {columns} {left[:2]} {right[:2]}"
    return "ok" if len(ours) else "EMPTY"


def type_differences(frame, relation) -> str:
    """Columns whose type differs between the two engines."""
    names = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    theirs = dict(zip(relation.columns, [str(t) for t in relation.types], strict=True))
    pairs = [(f.name, names.get(f.dataType.simpleString(), f.dataType.simpleString()), theirs.get(f.name)) for f in frame.schema]
    return "; ".join(f"{n} {a} {b}" for n, a, b in pairs if a != b)
