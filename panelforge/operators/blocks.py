"""Windows over groups of any size.

Up to ``MAX_GROUP_ROWS`` rows in the largest group a plain window does the work.  Beyond it rows are numbered by one
distributed sort and cut into blocks of equally many consecutive places of their group, so a group with a third of all
rows becomes many tasks.  A block gets copies of the rows next to its edge (the halo) that a shift needs, which lie in
one neighbouring block only, as blocks are at least as long as the shift.  What must travel further, the last known value, is carried from block to block in a
table with one row per block.

Rows that tie in ``order`` are in no defined order, as in any window; with a missing order value they come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.joins import join_groups
from panelforge.operators.quantiles import MAX_GROUP_ROWS, number_rows, profile_groups
from panelforge.storage import materialize

BLOCK_ROWS = 100_000

Order = Sequence[str | Column]


def _columns(order: Order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _fits(df: DataFrame, by: Sequence[str], max_group_rows: int) -> bool:
    return profile_groups(df.select(*by), by).largest <= max_group_rows


def _blocked(df: DataFrame, by: Sequence[str], order: Order, rows: int) -> DataFrame:
    numbered = number_rows(df, list(by), _columns(order))
    return numbered.withColumn("__block", F.floor(F.col("__place") / rows))


def number_in_group(df: DataFrame, by: Sequence[str], order: Order, name: str = "seq", max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Row numbers 1, 2, 3 ... within each group."""
    if _fits(df, by, max_group_rows):
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*_columns(order))).cast("long"))
    return number_rows(df, list(by), _columns(order)).withColumn(name, F.col("__place") + 1).drop("__place", "__size")


def shift_rows(
    df: DataFrame, columns: dict[str, str], by: Sequence[str], order: Order, offset: int = 1, max_group_rows: int = MAX_GROUP_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``columns`` (new name to old name) from the row ``offset`` places before, or after where it is negative."""
    if _fits(df, by, max_group_rows):
        line = Window.partitionBy(*by).orderBy(*_columns(order))
        return df.withColumns({new: F.lag(old, offset).over(line) for new, old in columns.items()})
    size = max(block_rows, abs(offset))
    at = F.col("__place") % size
    beside = F.when(at >= size - offset, F.col("__block") + 1) if offset > 0 else F.when(at < -offset, F.col("__block") - 1)
    blocks = F.array_compact(F.array(F.col("__block"), beside))
    spread = _blocked(df, by, order, size).withColumn("__in", F.explode(blocks))
    line = Window.partitionBy(*by, "__in").orderBy("__place")
    shifted = spread.withColumns({new: F.lag(old, offset).over(line) for new, old in columns.items()})
    return shifted.where("__in = __block").drop("__in", "__block", "__place", "__size")


def fill_rows(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], order: Order, max_group_rows: int = MAX_GROUP_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every column's last known value up to the current row."""

    def last(column: str, line) -> Column:
        return F.last(column, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    if _fits(df, by, max_group_rows):
        line = Window.partitionBy(*by).orderBy(*_columns(order))
        return df.withColumns({c: last(c, line) for c in columns})
    # written, as ties could be numbered differently by the two plans that read it
    rows = materialize(_blocked(df, by, order, block_rows), "blocks")
    carried = {c: f"__carry_{k}" for k, c in enumerate(columns)}
    ends = rows.groupBy(*by, "__block").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__place"))).alias(n) for c, n in carried.items()])
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({n: F.last(n, ignorenulls=True).over(before) for n in carried.values()})
    line = Window.partitionBy(*by, "__block").orderBy("__place")
    filled = rows.withColumns({c: last(c, line) for c in columns})
    joined = join_groups(filled, ends, [*by, "__block"])
    return joined.withColumns({c: F.coalesce(c, n) for c, n in carried.items()}).drop(*carried.values(), "__block", "__place", "__size")
