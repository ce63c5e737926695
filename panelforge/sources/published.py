"""Factor files as they are published: text, then tables of several frequencies below each other.

A file holds lines of text before the first table, a header whose first field is empty, rows that begin with a date of four, six or eight
digits, a blank line, then perhaps a title, a header and rows of another frequency, and lines of text at the end.  Lines are numbered
and grouped into sections between blank lines; a section with rows is a table, numbered from 1 in the order of the file.  A
file is a few thousand lines, one per period, so its sections are found in one window over the lines of a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Dates of rows, and numbers that stand for a missing return.
ROW_DATE = r"^\s*(\d{4}|\d{6}|\d{8})\s*$"
MISSING = (-99.99, -999.0)


def _fields(line: Column) -> Column:
    return F.transform(F.split(line, ","), lambda x: F.trim(x))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line`` from 1, ``text``: every line of the files at ``path``."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = files.select("file", F.posexplode(F.split(F.regexp_replace("value", "^﻿", ""), r"\r\n|\r|\n")).alias("at", "text"))
    return lines.select("file", (F.col("at") + 1).alias("line"), "text")


def sections(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, with the number ``table`` of their table (NULL outside), and the ``header`` of that table."""
    line = Window.partitionBy("file").orderBy("line")
    blank = F.regexp_replace("text", r"[\s,]", "") == ""
    counted = lines.withColumn("section", F.sum(F.when(blank, 1).otherwise(0)).over(line)).where(~blank)
    dated = F.get(F.split("text", ","), F.lit(0)).rlike(ROW_DATE)
    first = F.min(F.when(dated, F.col("line"))).over(Window.partitionBy("file", "section"))
    marked = counted.withColumns({"dated": dated, "__first": first})
    # tables in the order of their first rows, numbered without gaps
    begins = F.when(F.col("line") == F.col("__first"), 1).otherwise(0)
    marked = marked.withColumn("table", F.sum(begins).over(line) + F.when(F.col("line") < F.col("__first"), 1).otherwise(0))
    marked = marked.withColumn("table", F.when(F.col("__first").isNotNull(), F.col("table")))
    above = F.max_by("text", F.when(F.col("line") < F.col("__first"), F.col("line"))).over(Window.partitionBy("file", "section"))
    return marked.withColumn("header", above).where("table IS NULL OR line >= __first").drop("section", "__first")


def published_table(spark: SparkSession, path: str, columns: Sequence[str], table: int = 1, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows of one table of a published file, and the lines of it that cannot be read.

    The rows have ``date`` as text and ``columns``, found by their names in the header, as numbers; codes of missing
    values become NULL.  A line is rejected, with its number and the reason, where it does not begin with a date as long as that of the
    first row, has another number of fields than the header, or a field that is no number.  A wanted column that the header lacks fails the job.
    """
    found = sections(numbered_lines(spark, path)).where(F.col("table") == table)
    line = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parsed = found.withColumns({"fields": _fields(F.col("text")), "names": _fields(F.col("header"))})
    parsed = parsed.withColumn("stamp", F.get("fields", F.lit(0)))
    parsed = parsed.withColumn("width", F.first(F.when(F.col("dated"), F.length("stamp")), ignorenulls=True).over(line))
    numbers = F.transform(F.slice("fields", 2, F.greatest(F.size("fields") - 1, F.lit(0))), lambda x: x.try_cast("double"))
    parsed = parsed.withColumn("numbers", numbers)
    reason = (
        F.when(~F.col("dated") | (F.length("stamp") != F.col("width")), "no date of this table")
        .when(F.size("fields") != F.size("names"), "another number of fields")
        .when(F.exists("numbers", lambda x: x.isNull()), "not a number")
    )
    parsed = parsed.withColumn("reason", reason)

    def value(name: str) -> Column:
        place = F.array_position("names", name)
        missing = F.concat(F.lit(f"no column {name} in: "), F.coalesce("header", F.lit("")))
        at = F.when(F.coalesce(place, F.lit(0)) > 1, place - 2).otherwise(F.raise_error(missing).cast("long")).cast("int")
        number = F.get("numbers", at)
        return F.when(~number.isin(*MISSING), number).alias(name)

    rows = parsed.where("reason IS NULL").select(F.col("stamp").alias(date), *[value(c) for c in columns])
    return rows, parsed.where("reason IS NOT NULL").select("file", "line", "text", "reason")
