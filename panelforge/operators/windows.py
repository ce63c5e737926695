"""Per-entity windows.

All of them partition by an entity of a panel with one row per (entity, period).  The calendar bounds such a
partition - a thousand months, some ten thousand days - whatever the share of raw rows behind one entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.dates import month_index
from panelforge.functions.scalars import finite

#: Narrower frames are added up one by one: at 90 rows that took half the time of sums by blocks, whose sorts cost the same at every width.
MIN_BLOCK_WIDTH = 250


def lag_row(value: str, by: Sequence[str], order: str, offset: int = 1) -> Column:
    return F.lag(value, offset).over(Window.partitionBy(*by).orderBy(order))


def lag_month(value: str, entity: str, month: str) -> Column:
    """Value of the previous calendar month, NULL when that month is missing (one shuffle, no self join)."""
    return _single(value, Window.partitionBy(entity).orderBy(month_index(month)).rangeBetween(-1, -1))


def shift_year(value: str, entity: str, year: str, years: int) -> Column:
    """Value of the previous (``years=1``) or next (``years=-1``) year, NULL when that year is missing."""
    return _single(value, Window.partitionBy(entity).orderBy(year).rangeBetween(-years, -years))


def _single(value: str, frame) -> Column:
    """The value in a frame of one period; the job fails where that period has different values, instead of choosing one."""
    low, high = F.min(value).over(frame), F.max(value).over(frame)
    message = F.concat(F.lit(f"several values of {value} in one period: "), low.cast("string"), F.lit(", "), high.cast("string"))
    return F.when(low.isNull() | (low == high), high).otherwise(F.raise_error(message).cast("double"))


def fill_down(value: str, by: Sequence[str], order: str) -> Column:
    """Last known value up to the current row."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(value, ignorenulls=True).over(window)


def months_window(entity: str, month_number: str, months: int):
    """The current and the ``months - 1`` preceding calendar months of one entity."""
    return Window.partitionBy(entity).orderBy(month_number).rangeBetween(-(months - 1), 0)


def label_extremes(df: DataFrame, bucket: str, by: Sequence[str], name: str = "leg", low: str = "min", high: str = "max") -> DataFrame:
    """Label the lowest and highest bucket of each group, the rest ``other``."""
    window = Window.partitionBy(*by)
    lowest, highest = F.min(bucket).over(window), F.max(bucket).over(window)
    return df.withColumn(name, F.when(F.col(bucket) == lowest, low).when(F.col(bucket) == highest, high).otherwise("other"))


def rolling_sums(df: DataFrame, terms: dict[str, Column], entity: str, order: str, frame: tuple[str, int, int], min_block_width: int = MIN_BLOCK_WIDTH) -> DataFrame:
    """Sums of ``terms`` over a moving frame ``("rows" | "range", first offset, last offset)``; ``order`` is a number for "range".

    A NaN or infinite term counts as missing.  Frames of ``min_block_width`` or more that end at or before the current row are put together
    from sums that start anew with every block as wide as the frame: the end of one block and the beginning of the next.  Work per
    row is therefore the same for every greater width.  Other frames are added up one by one.  Nothing is ever subtracted either way,
    so a huge term only touches frames that hold it.
    """
    kind, first, last = frame
    width = last - first + 1
    clean = df.withColumns({f"__t_{k}": finite(t) for k, t in terms.items()})
    if width >= min_block_width and (last == 0 or (kind == "rows" and last < 0)):
        summed = _rows_by_blocks(clean, terms, entity, order, first, last) if kind == "rows" else _range_by_blocks(clean, terms, entity, order, width)
    else:
        ordered = Window.partitionBy(entity).orderBy(order)
        window = ordered.rowsBetween(first, last) if kind == "rows" else ordered.rangeBetween(first, last)
        summed = clean.withColumns({f"__t_{k}": F.sum(f"__t_{k}").over(window) for k in terms})
    return summed.withColumns({k: F.coalesce(F.col(f"__t_{k}"), F.lit(0.0)) for k in terms}).drop(*[f"__t_{k}" for k in terms])


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def _rows_by_blocks(df: DataFrame, terms: dict[str, Column], entity: str, order: str, first: int, last: int) -> DataFrame:
    """The columns ``__t_*`` replaced by their sums over rows ``first`` to ``last`` (at or before 0)."""
    width = last - first + 1
    upto = (Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("__at", F.row_number().over(Window.partitionBy(entity).orderBy(order)) - 1)
    rows = rows.withColumn("__block", F.floor(F.col("__at") / width))
    block = Window.partitionBy(entity, "__block")
    rows = rows.withColumns({f"__b_{k}": F.sum(f"__t_{k}").over(block.orderBy("__at").rowsBetween(*upto)) for k in terms})
    rows = rows.withColumns({f"__e_{k}": F.sum(f"__t_{k}").over(block.orderBy(F.col("__at").desc()).rowsBetween(*upto)) for k in terms})
    line = Window.partitionBy(entity).orderBy("__at")
    apart = F.pmod(F.col("__at") + first, F.lit(width)) != 0
    for k in terms:
        begun = F.lag(f"__b_{k}", -last).over(line) if last else F.col(f"__b_{k}")
        rows = rows.withColumn(f"__t_{k}", _plus(F.when(apart, F.lag(f"__e_{k}", -first).over(line)), begun))
    return rows.drop("__at", "__block", *[f"__{p}_{k}" for p in "be" for k in terms])


def _range_by_blocks(df: DataFrame, terms: dict[str, Column], entity: str, order: str, width: int) -> DataFrame:
    """The columns ``__t_*`` replaced by their sums over the values ``order - width + 1`` to ``order``.

    The frame may begin between two rows, so every row also asks, from the place where its frame begins, for the sum of what follows there up to
    the end of that block.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("__asks", F.explode(F.array(F.lit(False), F.lit(True))))
    rows = rows.withColumn("__at", F.col(order).cast("long") - F.when(F.col("__asks"), width - 1).otherwise(0))
    rows = rows.withColumn("__block", F.floor(F.col("__at") / width))
    rows = rows.withColumns({f"__t_{k}": F.when(~F.col("__asks"), F.col(f"__t_{k}")) for k in terms})
    block = Window.partitionBy(entity, "__block")
    begun, ended = block.orderBy("__at").rangeBetween(*upto), block.orderBy(F.col("__at").desc()).rangeBetween(*upto)
    rows = rows.withColumns({f"__b_{k}": F.sum(f"__t_{k}").over(begun) for k in terms} | {f"__e_{k}": F.sum(f"__t_{k}").over(ended) for k in terms})
    home = Window.partitionBy(entity, order)
    apart = F.pmod(F.col("__at") - (width - 1), F.lit(width)) != 0
    asked = {f"__e_{k}": F.max(F.when(F.col("__asks"), F.col(f"__e_{k}"))).over(home) for k in terms}
    rows = rows.withColumns(asked).where("NOT __asks")
    rows = rows.withColumns({f"__t_{k}": _plus(F.when(apart, F.col(f"__e_{k}")), F.col(f"__b_{k}")) for k in terms})
    return rows.drop("__at", "__block", "__asks", *[f"__{p}_{k}" for p in "be" for k in terms])
