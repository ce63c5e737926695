"""Joins that Spark has no single keyword for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.dates import shift_months
from panelforge.storage import materialize

#: Left rows of one key that may meet in one cell of a validity join.
CELL_ROWS = 100_000


def one_row_per(df: DataFrame, key: str) -> DataFrame:
    """Rows with a known ``key``; the job fails when two different rows share one, instead of choosing between them."""
    rest = [c for c in df.columns if c != key]
    known = df.where(F.col(key).isNotNull())
    if not rest:
        return known.distinct()
    message = F.concat(F.lit(f"several rows for one {key}: "), F.col(key).cast("string"))
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    single = known.groupBy(key).agg(F.min(row).alias("__low"), F.max(row).alias("__high"))  # equal only if all rows are
    checked = F.when(F.col("__low").eqNullSafe(F.col("__high")), F.col("__low")).otherwise(F.raise_error(message))
    return single.select(key, checked.alias("__row")).select(*[F.col(f"__row.`{c}`").alias(c) if c != key else F.col(key) for c in df.columns])


def one_row_per_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose ``keys`` must tell all rows apart: the job fails when two rows, even equal ones, share them."""
    rest = [c for c in df.columns if c not in keys]
    message = F.concat(F.lit(f"several rows for one {', '.join(keys)}: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
    return counted.where(F.when(F.col("__n") == 1, True).otherwise(F.raise_error(message).cast("boolean"))).select(*df.columns)


def period_lookup(df: DataFrame, period: str) -> DataFrame:
    """Broadcastable lookup with one row per calendar period.

    One row per period bounds the table by the calendar (about 120,000 months or 3.7 million days are all that a DATE
    can hold, a few thousand in practice), whatever the size of the input.
    """
    return F.broadcast(one_row_per(df, period))


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on grouping columns where NULL groups match NULL groups; key columns are kept once."""
    if not by:
        raise ValueError("by must name at least one column")
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in by else F.col(c) for c in right.columns])
    condition = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in by]
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in by])


def _no_day() -> Column:
    """The day that stands for a whole year; no record begins so early."""
    return F.lit("0001-01-01").cast("date")


def join_validity(
    left: DataFrame,
    right: DataFrame,
    key: str,
    date: str,
    start: str,
    end: str,
    open_end: Column | None = None,
    how: str = "inner",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Rows of ``left`` with every row of ``right`` whose ``[start, end]`` contains ``left.date`` under an equal ``key``.

    The validity records are spread over cells of the calendar and joined on (key, cell), so only what lies in one cell is
    compared.  A cell is a year of a key, unless the key has more than ``cell_rows`` left rows in that year: then it is a
    day on which the key has any, cut again by a hash of the row where a single day has too many.  Years outside those of
    ``left.date`` are left out, so an end in the year 9999 costs nothing.  ``how`` is "inner" or "left", which keeps rows
    without a match, their columns of ``right`` being NULL.
    """
    last = F.coalesce(F.col(end), open_end) if open_end is not None else F.col(end)
    records = right.withColumn(end, last).where(F.col(start) <= F.col(end)).withColumnRenamed(key, "__key")
    per_year = left.where(F.col(date).isNotNull()).groupBy(key, F.year(date).alias("__year")).agg(F.count(F.lit(1)).alias("__n"))
    low, high, most = per_year.agg(F.min("__year"), F.max("__year"), F.max("__n")).first()
    dated = left.withColumn("__year", F.year(date))
    years = F.sequence(F.greatest(F.year(start), F.lit(low)), F.least(F.year(end), F.lit(high)))
    reached = (F.year(start) <= F.lit(high)) & (F.year(end) >= F.lit(low))
    spread = records.where(reached).withColumn("__r_year", F.explode(years))
    cells, inside = [("__year", "__r_year")], F.col(date).between(F.col(start), F.col(end))
    if most is not None and most > cell_rows:
        hot = materialize(per_year.where(F.col("__n") > cell_rows).select(key, "__year"), "hot-years")
        days = dated.join(hot, [key, "__year"], "left_semi").groupBy(key, F.col(date).alias("__day"))
        days = materialize(days.agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("__parts")), "hot-days")
        row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
        ours = days.withColumnsRenamed({key: "__l_key", "__day": "__l_day"})
        dated = dated.join(ours, (F.col(key) == F.col("__l_key")) & (F.col(date) == F.col("__l_day")), "left")
        dated = dated.withColumns({"__part": F.coalesce(F.pmod(row, F.col("__parts")), F.lit(0)), "__cell": F.coalesce(F.col("__l_day"), _no_day())})
        dated = dated.drop("__l_key", "__l_day", "__parts")

        hot_years = hot.withColumnsRenamed({key: "__key", "__year": "__r_year"})
        cold = spread.join(hot_years, ["__key", "__r_year"], "left_anti").withColumns({"__r_part": F.lit(0).cast("long"), "__r_cell": _no_day()})
        theirs = days.select(F.col(key).alias("__key"), F.year("__day").alias("__r_year"), F.col("__day").alias("__r_cell"), "__parts")
        daily = spread.join(theirs, ["__key", "__r_year"]).where(F.col("__r_cell").between(F.col(start), F.col(end)))
        daily = daily.withColumn("__r_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts").cast("long") - 1))).drop("__parts")
        spread = cold.unionByName(daily)
        cells += [("__cell", "__r_cell"), ("__part", "__r_part")]
    matches = (F.col(key) == F.col("__key")) & inside
    for ours, theirs in cells:
        matches = matches & (F.col(ours) == F.col(theirs))
    return dated.join(spread, matches, how).drop("__key", *[c for pair in cells for c in pair])


def condense_validity(
    right: DataFrame, key: str, start: str, end: str, open_end: Column | None = None, count: str = "n", latest: str = "latest"
) -> DataFrame:
    """Disjoint periods (``key``, ``start``, ``end``) with the number of overlapping records and the latest start among them.

    What is counted over all records that are valid on a day is then looked up in one period, so rows of a key are never paired
    with its records.  Records are first added up by key and day, map-side; the rest works on that table, which the calendar
    bounds for each key whatever the number of records: counts are running sums over its days, and only days on which records
    end and none begins are compared with the records begun before, of which the one that lasts longest stands for its day.
    """
    last = F.coalesce(F.col(end), open_end) if open_end is not None else F.col(end)
    records = right.select(F.col(key).alias("k"), F.col(start).alias("first"), last.alias("last")).where("k IS NOT NULL AND first <= last")
    begins = F.struct(F.col("first").alias("day"), F.lit(1).cast("long").alias("step"), "last")
    ends = F.struct(F.date_add("last", 1).alias("day"), F.lit(-1).cast("long").alias("step"), F.lit(None).cast("date").alias("last"))
    steps = records.select("k", F.explode(F.array(begins, ends)).alias("s")).groupBy("k", "s.day")
    steps = materialize(steps.agg(F.sum("s.step").alias("step"), F.max("s.last").alias("last")), "validity-steps")

    by_day = Window.partitionBy("k").orderBy("day")
    running = F.sum("step").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    periods = steps.select("k", "day", "last", running.alias("n"), F.date_sub(F.lead("day").over(by_day), 1).alias("until")).where("n > 0")
    begun = steps.where("last IS NOT NULL").select("k", F.col("day").alias("first"), "last")
    older = join_validity(periods.where("last IS NULL").select("k", "day"), begun, "k", "day", "first", "last")
    older = older.groupBy("k", "day").agg(F.max("first").alias("older"))
    begins_here = F.when(F.col("last").isNotNull(), F.col("day"))
    return periods.join(older, ["k", "day"], "left").select(
        F.col("k").alias(key), F.col("day").alias(start), F.col("until").alias(end),
        F.col("n").alias(count), F.coalesce(begins_here, F.col("older")).alias(latest),
    )


def join_shifted_month(df: DataFrame, keys: Sequence[str], month: str, columns: dict[str, str], months: int) -> DataFrame:
    """Attach ``columns`` (old name to new name) from the row of the same entity ``months`` earlier."""
    other = df.select(
        *keys,
        shift_months(F.col(month), months).alias(month),
        *[F.col(old).alias(new) for old, new in columns.items()],
    )
    return df.join(other, [*keys, month], "left")


def join_shifted_year(df: DataFrame, keys: Sequence[str], year: str, columns: dict[str, str], years: int) -> DataFrame:
    """Same as ``join_shifted_month`` for an integer year; negative shifts look ahead."""
    other = df.select(
        *keys,
        (F.col(year) + years).alias(year),
        *[F.col(old).alias(new) for old, new in columns.items()],
    )
    return df.join(other, [*keys, year], "left")


def join_renamed(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "left") -> DataFrame:
    """Equi join whose keys are named differently on the right (left name to right name)."""
    for ours, theirs in keys.items():
        right = right.withColumnRenamed(theirs, ours)
    return left.join(right, list(keys), how)


def keep_matched(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> DataFrame:
    return _half_join(left, right, keys, "left_semi")


def drop_matched(left: DataFrame, right: DataFrame, keys: dict[str, str], hashed: bool = False) -> DataFrame:
    return _half_join(left, right, keys, "left_anti", hashed)


def _half_join(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str, hashed: bool = False) -> DataFrame:
    """Semi or anti join; the right side is reduced to distinct keys before it is shuffled.

    ``hashed`` is for wide left rows and a right side that grows with them: its keys of a partition are hashed, nothing is sorted.
    """
    probe = right.select(*[F.col(theirs).alias(ours) for ours, theirs in keys.items()]).distinct()
    return left.join(probe.hint("shuffle_hash") if hashed else probe, list(keys), how)


def join_add_missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows with matches attached, plus the right rows that matched nothing."""
    return left.join(right, list(keys), "full")
