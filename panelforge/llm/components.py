"""Connected components of a distributed list of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.storage import materialize


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def stars(links: DataFrame) -> DataFrame:
    """Rows (``node``, ``root``) for every node that is not the smallest of its component.

    ``links`` has two comparable columns ``a`` and ``b``.  Each round rehangs the larger neighbours of every node on its
    smallest neighbour and then the smaller ones, so the number of links never grows and long chains shorten
    geometrically.  Minima are aggregated map-side and joined back, no neighbourhood is gathered; every round is a
    written table, so a lost executor costs one round at most.  Links with a NULL end and links of a node to itself are
    ignored; repeated links count once; without links there are no rows.
    """
    current = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialize(current, "links")
    state = _state(current)
    while state[0]:
        both = current.union(current.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        current = materialize(hung.select("x.a", "x.b").where("a <> b").distinct(), "links")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
