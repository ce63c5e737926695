"""Daily security panel with delisting returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.dates import month_of
from panelforge.plans.monthly_panel import add_excess_return
from panelforge.sources.readers import raw_input
from panelforge.storage import materialize, remove_folder


def daily_panel(returns: DataFrame, delistings: DataFrame, factors: DataFrame, end_date: str) -> DataFrame:
    """Known daily returns; the delisting return replaces or adds the delisting day, later days are dropped.

    One lookup of the delisting record per security serves replacement and cut-off.  The days to add are found by
    reducing the returns to delisting days first, so the daily table itself is never shuffled for them.
    """
    known = raw_input(delistings, ("permno", "dlstdt", "dlret")).dropna()
    exits = known.groupBy("permno").agg(F.max_by(F.struct("dlstdt", "dlret"), "dlstdt").alias("d")).select("permno", "d.*")
    daily = raw_input(returns, ("permno", "date", "ret")).dropna()
    exit_days = exits.select("permno", F.col("dlstdt").alias("date"))
    present = daily.select("permno", "date").join(exit_days, ["permno", "date"], "left_semi")
    added = exits.select("permno", F.col("dlstdt").alias("date"), F.col("dlret").alias("ret")).join(present, ["permno", "date"], "left_anti")

    looked_up = daily.join(exits, "permno", "left")
    replaced = F.when(F.col("date") == F.col("dlstdt"), F.col("dlret")).otherwise(F.col("ret"))
    kept = looked_up.where(F.col("date") <= F.coalesce("dlstdt", F.lit(end_date).cast("date")))
    full = kept.select("permno", "date", replaced.alias("ret")).unionByName(added)
    return add_excess_return(full.withColumn("month", month_of("date")), factors, "date").select(
        "permno", "date", "month", "ret", "ret_excess"
    )


def write_daily_panel(panel: DataFrame, path: str) -> None:
    """A daily panel as one folder per month."""
    panel.repartition("month").write.mode("overwrite").partitionBy("month").parquet(path)


def touched_months(returns: DataFrame, changed_returns: DataFrame | None = None, changed_delistings: DataFrame | None = None) -> DataFrame:
    """Months that changes reach: those of changed returns (``date``), and for each changed delisting (``permno``, ``dlstdt``,
    before or after the change) its own month and all of the security's months from then on, as later days are dropped.
    """
    spark = returns.sparkSession
    months = spark.createDataFrame([], "month date")
    if changed_returns is not None:
        months = months.unionByName(changed_returns.select(month_of("date").alias("month")))
    if changed_delistings is not None:
        first = changed_delistings.groupBy("permno").agg(F.min("dlstdt").alias("__first"))
        later = returns.join(first, "permno").where(F.col("date") >= F.col("__first"))
        months = months.unionByName(changed_delistings.select(month_of("dlstdt").alias("month"))).unionByName(later.select(month_of("date").alias("month")))
    return months.where("month IS NOT NULL").distinct()


def refresh_daily_panel(spark: SparkSession, path: str, returns: DataFrame, delistings: DataFrame, factors: DataFrame, end_date: str, months: DataFrame) -> list:
    """Build the given months of a written daily panel anew from the current inputs; all other folders stay as they are.

    The months, a list bounded by the calendar, go to the scan as a filter.  Only their folders are replaced; those of
    months that have no rows any more are removed.  Returns the months.
    """
    touched = [r["month"] for r in months.select("month").distinct().orderBy("month").collect()]
    if not touched:
        return touched
    low, high = min(touched), F.add_months(F.lit(max(touched)), 1)
    near = returns.where((F.col("date") >= F.lit(low)) & (F.col("date") < high) & month_of("date").isin(touched))
    rows = daily_panel(near, delistings, factors, end_date).where(F.col("month").isin(touched))
    rows = materialize(rows, "refreshed-months")
    written = {r["month"] for r in rows.select("month").distinct().collect()}
    rows.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    for month in touched:
        if month not in written:
            remove_folder(spark, f"{path}/month={month}")
    return touched
