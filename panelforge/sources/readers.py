"""Readers and writers for panel tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from panelforge.functions.scalars import nan_to_null

#: Rows of a table given in the program up to which it is broadcast.
INLINE_ROWS = 100_000


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def raw_input(df: DataFrame, columns: Sequence[str], others: bool = False) -> DataFrame:
    """The named columns of a raw table, all of which must be there, and with ``others`` the rest.

    NaN, as other tools write a missing number, becomes NULL.
    """
    kept = require_columns(df, columns).columns if others else list(columns)
    real = {f.name for f in df.schema if isinstance(f.dataType, DoubleType | FloatType)}
    return df.select(*[nan_to_null(F.col(f"`{c}`")).alias(c) if c in real else F.col(f"`{c}`") for c in kept])


def table_path(data_dir: str, schema: str, table: str) -> str:
    return f"{data_dir.rstrip('/')}/{schema}/{table}.parquet"


def scan_parquet(spark: SparkSession, table: str, schema: str, data_dir: str, columns: StructType | str | None = None) -> DataFrame:
    """Lazy table at ``<data_dir>/<schema>/<table>.parquet``."""
    reader = spark.read.schema(columns) if columns is not None else spark.read
    return reader.parquet(table_path(data_dir, schema, table))


def scan_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    return spark.table(f"{schema}.{name}" if schema else name)


def scan_query(spark: SparkSession, sql: str, dates: Sequence[str] = (), **tables: DataFrame) -> DataFrame:
    """Result of a SQL text over named DataFrames, with the listed columns parsed as dates."""
    out = spark.sql(sql, **tables)
    return out.withColumns({c: F.to_date(F.col(c)) for c in dates}) if dates else out


def scan_csv(spark: SparkSession, path: str, columns: StructType | str) -> DataFrame:
    return spark.read.csv(path, schema=columns, header=True)


def scan_jdbc(spark: SparkSession, url: str, table: str, partition: tuple[str, int, int, int] | None = None, **options) -> DataFrame:
    """Remote table; ``partition`` is (column, lowest, highest, number of parallel reads)."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition:
        column, low, high, n = partition
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=n)
    return reader.load()


def inline_table(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """Table given in the program, marked for broadcast up to ``INLINE_ROWS`` rows."""
    table = spark.createDataFrame(list(rows), columns)
    return F.broadcast(table) if len(rows) <= INLINE_ROWS else table


def write_parquet(df: DataFrame, table: str, schema: str, data_dir: str, partition_by: Sequence[str] = ()) -> str:
    path = table_path(data_dir, schema, table)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalogue table; ``path`` keeps its files in a shared folder."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def catalog_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables of a database, without temporary views."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def convert_catalog(spark: SparkSession, database: str, data_dir: str, schema: str | None = None) -> dict[str, str]:
    """Write every table of a database as Parquet; the path of each."""
    return {name: write_parquet(scan_table(spark, name, database), name, schema or database, data_dir) for name in catalog_tables(spark, database)}
