"""Shared storage for intermediate tables.

Multi-pass operators cut their lineage by writing a table to the folder that the cluster names in
``spark.checkpoint.dir``.  A written Parquet table survives the loss of executors and lets each later pass read
only the columns it needs.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to every executor; a private one is made only for local sessions without the setting."""
    context = spark.sparkContext
    configured = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="panelforge-"))
    return context.getCheckpointDir()


def stage_path(spark: SparkSession, name: str = "stage") -> str:
    return f"{shared_dir(spark)}/panelforge/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, sort: Sequence[str] = (), name: str = "bucketed") -> DataFrame:
    """Write ``df`` in buckets of ``keys``, one sorted file each, and continue from the table.

    Joins, aggregates and windows that are dealt by ``keys`` then read their buckets where they lie, without an exchange.  Joins on
    further columns need ``spark.sql.requireAllClusterKeysForCoPartition`` off.  All rows of a key lie in one file: for
    keys that the calendar bounds.  The table is in the session's catalogue under a name of its own, its files in the shared folder.
    """
    spark, table = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    placed = df.repartition(buckets, *keys)
    writer = placed.write.bucketBy(buckets, *keys).sortBy(*(sort or keys)).option("path", stage_path(spark, name))
    writer.format("parquet").saveAsTable(table)
    return spark.table(table)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever Spark reads it from."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
