"""Sliding windows over periods for any mergeable state.

The rows of each (entity, period) are first reduced to a state.  States of 1, 2, 4 ... periods are built by doubling, each
from two of half the length, and a window of any number of periods is put together from the powers of two it is made of.
No state is ever taken away again, so aggregates without an inverse slide as well, and a row takes as many merges as the
width has binary digits.  Entities get the periods they lack between their first and last one, so a shift by rows is a shift by
periods; what lies behind one entity is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sliding:
    """A state as an aggregate of the rows of a period, how two states merge (earlier first), and the result.

    ``merge`` and ``finish`` only ever see states that are not NULL.
    """

    state: Column
    merge: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column]


def extreme(value: str, highest: bool = True) -> Sliding:
    aggregate, choose = (F.max, F.greatest) if highest else (F.min, F.least)
    return Sliding(aggregate(value), choose, lambda s: s)


def mean(value: str, min_obs: int = 1) -> Sliding:
    known = F.count(value)
    return Sliding(
        F.when(known > 0, F.struct(F.sum(value).alias("s"), known.alias("n"))),
        lambda a, b: F.struct((a["s"] + b["s"]).alias("s"), (a["n"] + b["n"]).alias("n")),
        lambda s: F.when(s["n"] >= min_obs, s["s"] / s["n"]),
    )


def quantiles(value: str, probs: Sequence[float], min_obs: int = 1) -> Sliding:
    """Exact quantiles with linear interpolation, as an array; the state is the window's values."""

    def finish(values: Column) -> Column:
        ordered = F.array_sort(values)

        def at(p: float) -> Column:
            place = (F.size(values) - 1) * F.lit(float(p))
            low, high = F.floor(place).cast("int"), F.ceil(place).cast("int")
            a, b = F.get(ordered, low), F.get(ordered, high)
            return a + (place - low) * (b - a)

        return F.when(F.size(values) >= min_obs, F.array(*[at(p) for p in probs]))

    values = F.collect_list(F.col(value).cast("double"))
    return Sliding(F.when(F.size(values) > 0, values), F.concat, finish)


def regression(y: str, x: str, min_obs: int = 3) -> Sliding:
    """Least squares of ``y`` on ``x``: a struct of slope, intercept and the number of pairs.

    The state holds counts, means and centred products, which merge without taking large sums from each other.
    """
    names = ("n", "mx", "my", "sxx", "sxy")

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        dx, dy, weight = b["mx"] - a["mx"], b["my"] - a["my"], a["n"] * b["n"] / n
        parts = (n, a["mx"] + dx * b["n"] / n, a["my"] + dy * b["n"] / n, a["sxx"] + b["sxx"] + dx * dx * weight, a["sxy"] + b["sxy"] + dx * dy * weight)
        return F.struct(*[p.alias(k) for p, k in zip(parts, names, strict=True)])

    def finish(s: Column) -> Column:
        slope = F.when(s["n"] >= min_obs, s["sxy"] / F.nullif(s["sxx"], F.lit(0.0)))
        return F.struct(slope.alias("slope"), (s["my"] - slope * s["mx"]).alias("intercept"), s["n"].cast("long").alias("n"))

    parts = (F.regr_count(y, x).cast("double"), F.regr_avgx(y, x), F.regr_avgy(y, x), F.regr_sxx(y, x), F.regr_sxy(y, x))
    state = F.struct(*[p.alias(k) for p, k in zip(parts, names, strict=True)])
    return Sliding(F.when(F.regr_count(y, x) > 0, state), merge, finish)


def _merged(how: Sliding, earlier: Column, later: Column) -> Column:
    return F.when(earlier.isNull(), later).when(later.isNull(), earlier).otherwise(how.merge(earlier, later))


def slide_periods(
    df: DataFrame, entity: str, period: str, windows: dict[str, Sliding], periods: int, complete: bool = False
) -> DataFrame:
    """Results of the window of ``periods`` periods that ends at each period of an entity: ``entity``, ``period``, one column per window.

    ``period`` is a whole number that counts periods, as ``month_index`` makes.  There is one row for each period that the entity has rows
    in.  With ``complete`` a window that begins before the entity's first period has no result.
    """
    states = df.where(F.col(period).isNotNull()).groupBy(entity, F.col(period).cast("long").alias("__p")).agg(*[w.state.alias(f"__s_{n}") for n, w in windows.items()])
    line = Window.partitionBy(entity).orderBy("__p")
    gap = F.coalesce(F.lead("__p").over(line) - 1, F.col("__p"))
    first = F.min("__p").over(Window.partitionBy(entity))
    spread = states.withColumns({"__first": first, "__gap": gap})
    grid = spread.select("*", F.explode(F.sequence("__p", F.greatest("__p", "__gap"))).alias("__at"))
    real = F.col("__at") == F.col("__p")
    grid = grid.withColumns({f"__s_{n}": F.when(real, F.col(f"__s_{n}")) for n in windows})
    steps = Window.partitionBy(entity).orderBy("__at")
    done, power = 0, 1
    while power <= periods:
        if periods & power:
            # the window so far covers the latest ``done`` periods; the next part lies before them
            part = {n: F.lag(f"__s_{n}", done).over(steps) if done else F.col(f"__s_{n}") for n in windows}
            grid = grid.withColumns({f"__t_{n}": c for n, c in part.items()})
            grid = grid.withColumns({f"__w_{n}": _merged(w, F.col(f"__t_{n}"), F.col(f"__w_{n}")) if done else F.col(f"__t_{n}") for n, w in windows.items()})
            done += power
        power *= 2
        if power <= periods:
            grid = grid.withColumns({f"__t_{n}": F.lag(f"__s_{n}", power // 2).over(steps) for n in windows})
            grid = grid.withColumns({f"__s_{n}": _merged(w, F.col(f"__t_{n}"), F.col(f"__s_{n}")) for n, w in windows.items()})
    whole = F.col("__at") - F.col("__first") >= periods - 1 if complete else F.lit(True)
    results = [F.when(whole & F.col(f"__w_{n}").isNotNull(), w.finish(F.col(f"__w_{n}"))).alias(n) for n, w in windows.items()]
    return grid.where(real).select(entity, F.col("__at").alias(period), *results)
