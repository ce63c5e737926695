"""As-of joins: the latest right row at or before each left row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.blocks import BLOCK_ROWS, fill_rows
from panelforge.operators.quantiles import MAX_GROUP_ROWS


def join_asof(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    fresh: Column | None = None,
    how: str = "left",
    tie: Sequence[str] = (),
    max_group_rows: int = MAX_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``left`` with ``columns`` of the latest row of ``right`` under equal ``by`` whose time is at or before the left time.

    Both sides become one stream in time order, right rows before left ones of the same time, and the last right row is
    carried on; a right row counts whether or not the left side has a row at its time.  Hot groups are cut into blocks,
    whose last right row is carried to the next ones.  Among right rows of one time the last in the order of ``tie``, then of ``columns``,
    is taken.  ``fresh`` is a condition over the columns of ``left``, ``columns`` and ``right_time``; where it does not hold
    the right row does not count.  ``how`` is "left" or "inner".  Rows with a missing key match nothing, nor do those with a missing time.
    """
    taken = [c for c in dict.fromkeys([right_time, *columns]) if c not in by]
    clash = [c for c in taken if c in left.columns]
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")
    events = right.where(F.col(right_time).isNotNull())
    for key in by:
        events = events.where(F.col(key).isNotNull())
    order = [c for c in dict.fromkeys([*tie, *columns]) if c not in by]
    stamped = events.select(
        *by,
        F.col(right_time).alias("__time"),
        F.struct(*[F.col(c) for c in order]).alias("__tie"),
        F.struct(*[F.col(c) for c in taken]).alias("__event"),
    )
    known = F.col(left_time).isNotNull()
    for key in by:
        known = known & F.col(key).isNotNull()
    rows = left.select(*by, F.col(left_time).alias("__time"), F.struct(*[F.col(c) for c in left.columns]).alias("__row"), known.alias("__known"))
    stream = stamped.unionByName(rows, allowMissingColumns=True)
    order = [F.col("__time"), F.col("__row").isNotNull(), F.col("__tie")]
    filled = fill_rows(stream, ["__event"], by, order, max_group_rows, block_rows).where("__row IS NOT NULL")
    out = filled.select("__row.*", *[F.when(F.col("__known"), F.col("__event")[c]).alias(c) for c in taken])
    if fresh is not None:
        out = out.withColumns({c: F.when(fresh, F.col(c)) for c in taken})
    return out.where(F.col(right_time).isNotNull()) if how == "inner" else out
