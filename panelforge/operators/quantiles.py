"""Exact quantiles (linear interpolation, type 7) at any group size.

Spark's ``percentile`` keeps every distinct value of a group in the memory of one task, which is right for a
cross-section of thousands of securities and wrong for a group that holds a third of a huge table.  Every entry
point therefore measures the largest group first.  Up to ``MAX_GROUP_ROWS`` the built-in aggregate runs; beyond it
the required order statistics are found by narrowing: approximate quantiles cut each group into ranges, the ranges
are counted exactly, and only the ranges that contain a required rank are looked at again.  Results are exact
because the approximate cuts only decide where to look, never what to return.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.joins import join_groups
from panelforge.storage import materialize

MAX_GROUP_ROWS = 1_000_000
RANGES = 128
BROADCAST_CELLS = 2_000_000
EVERYTHING = "__all"


@dataclass(frozen=True)
class GroupProfile:
    groups: int
    largest: int


def profile_groups(df: DataFrame, by: Sequence[str]) -> GroupProfile:
    """Number of groups and rows of the largest one (one aggregation job)."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("largest")).first()
    return GroupProfile(row["groups"], row["largest"] or 0)


def broadcast_if_small(df: DataFrame, groups: int, cells_per_group: int = 1) -> DataFrame:
    """Broadcast a per-group table only when its counted size allows it."""
    return F.broadcast(df) if groups * cells_per_group <= BROADCAST_CELLS else df


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    name: str = "quantiles",
    max_group_rows: int = MAX_GROUP_ROWS,
    profile: GroupProfile | None = None,
) -> DataFrame:
    """One row per group with an array of quantiles in the order of ``probs``; missing values are ignored."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))
    profile = profile or profile_groups(rows, by)
    if profile.largest <= max_group_rows:
        array = F.percentile("__v", F.array(*[F.lit(float(p)) for p in probs]))
        return rows.groupBy(*by).agg(array.alias(name))
    return _narrowed_quantiles(rows, probs, list(by), name, max_group_rows)


def quantile_rows(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), prob: str = "prob", name: str = "quantile", **options
) -> DataFrame:
    """One row per group and probability."""
    arrays = exact_quantiles(df, value, probs, by, "__q", **options)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("p"), F.col("__q").alias("q"))
    return arrays.select(*by, F.explode(pairs).alias("__e")).select(
        *by, F.col("__e.p").alias(prob), F.col("__e.q").alias(name)
    )


def _narrowed_quantiles(rows: DataFrame, probs: Sequence[float], by: list[str], name: str, bound: int) -> DataFrame:
    keys = by or [EVERYTHING]
    if not by:
        rows = rows.withColumn(EVERYTHING, F.lit(0))
    sizes = materialize(rows.groupBy(*keys).agg(F.count("__v").alias("__n")), "sizes")
    wanted = sizes.select(
        *keys,
        F.posexplode(F.array(*[(F.col("__n") - 1) * F.lit(float(p)) for p in probs])).alias("__i", "__pos"),
    )
    lower, upper = F.floor("__pos").cast("long"), F.ceil("__pos").cast("long")
    ranks = wanted.select(*keys, F.explode(F.array(lower, upper)).alias("__rank")).distinct()
    found = materialize(
        select_ranks(rows.withColumn("__c", F.lit(1).cast("long")), keys, ranks, bound).select(*keys, "__rank", "__v"),
        "ranks",
    )
    at_lower = found.withColumnsRenamed({"__rank": "__lo", "__v": "__vlo"})
    at_upper = found.withColumnsRenamed({"__rank": "__hi", "__v": "__vhi"})
    placed = wanted.withColumn("__lo", lower).withColumn("__hi", upper)
    placed = join_groups(placed, at_lower, [*keys, "__lo"])
    placed = join_groups(placed, at_upper, [*keys, "__hi"])
    between = (F.col("__hi") - F.col("__pos")) * F.col("__vlo") + (F.col("__pos") - F.col("__lo")) * F.col("__vhi")
    exact = F.when(F.col("__vlo") == F.col("__vhi"), F.col("__vlo")).otherwise(between)
    ordered = F.sort_array(F.collect_list(F.struct("__i", exact.alias("q"))))
    return placed.groupBy(*keys).agg(F.transform(ordered, lambda e: e["q"]).alias(name)).select(*by, name)


def select_ranks(rows: DataFrame, by: list[str], wanted: DataFrame, bound: int = MAX_GROUP_ROWS, depth: int = 0) -> DataFrame:
    """Value at each wanted 0-based rank of its group.

    ``rows`` has ``by``, a value ``__v`` and a multiplicity ``__c``; ``wanted`` has ``by`` and ``__rank``.  Returns
    ``by``, ``__rank``, ``__v`` and ``__below``, the number of rows with a smaller value.
    """
    ranks = wanted.groupBy(*by).agg(F.collect_list("__rank").alias("__ranks"))
    if profile_groups(rows, by).largest <= bound:
        running = Window.partitionBy(*by).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per_value = (
            rows.groupBy(*by, "__v")
            .agg(F.sum("__c").alias("__c"))
            .withColumn("__end", F.sum("__c").over(running))
            .withColumn("__below", F.col("__end") - F.col("__c"))
        )
        hit = F.filter("__ranks", lambda r: (r >= F.col("__below")) & (r < F.col("__end")))
        return join_groups(per_value, ranks, by).select(*by, F.explode(hit).alias("__rank"), "__v", "__below")

    steps = F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)])
    cuts = rows.groupBy(*by).agg(F.array_distinct(F.percentile_approx("__v", steps, 10_000)).alias("__cuts"))
    bin_name = f"__b{depth}"
    if by == [EVERYTHING]:
        limits = cuts.first()["__cuts"]
        position = F.size(F.filter(F.array(*[F.lit(c) for c in limits]), lambda c: c < F.col("__v")))
        binned = rows.withColumn(bin_name, position)
    else:
        joined = join_groups(rows, materialize(cuts, "cuts"), by)
        binned = joined.withColumn(bin_name, F.size(F.filter("__cuts", lambda c: c < F.col("__v")))).drop("__cuts")
    running = Window.partitionBy(*by).orderBy(bin_name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        binned.groupBy(*by, bin_name)
        .agg(F.sum("__c").alias("__m"))
        .withColumn("__end", F.sum("__m").over(running))
        .withColumn("__off", F.col("__end") - F.col("__m"))
    )
    inside = F.filter("__ranks", lambda r: (r >= F.col("__off")) & (r < F.col("__end")))
    targets = materialize(
        join_groups(ranges, ranks, by).select(*by, bin_name, "__off", inside.alias("__in")).where(F.size("__in") > 0), "targets"
    )
    deeper = [*by, bin_name]
    candidates = materialize(
        join_groups(binned, targets.select(*deeper), deeper).groupBy(*deeper, "__v").agg(F.sum("__c").alias("__c")), "candidates"
    )
    relative = targets.select(*deeper, F.explode("__in").alias("__rank")).join(
        targets.select(*[F.col(c).alias(f"__t_{c}") for c in deeper], "__off"),
        [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in deeper],
    )
    relative = relative.select(*deeper, (F.col("__rank") - F.col("__off")).alias("__rank"))
    found = select_ranks(candidates, deeper, relative, bound, depth + 1)
    offsets = targets.select(*deeper, "__off")
    return join_groups(found, offsets, deeper).select(
        *by,
        (F.col("__rank") + F.col("__off")).alias("__rank"),
        "__v",
        (F.col("__below") + F.col("__off")).alias("__below"),
    )


def ntile(
    df: DataFrame,
    value: str,
    n: int,
    by: Sequence[str],
    tie: str,
    name: str = "portfolio",
    descending: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Equal-count buckets 1..n of ``value`` within each group, ties ordered by the column ``tie``.

    Rows with a missing value are dropped.  Groups up to the bound are one window each; larger ones are numbered by
    places in one distributed sort.  Both compare value and tie in their own types and split equal rows by count.
    """
    known = df.where(F.col(value).isNotNull())
    order = [F.col(value).desc() if descending else F.col(value).asc(), F.col(tie).asc()]
    if profile_groups(known.select(*by), by).largest <= max_group_rows:
        return known.withColumn(name, F.ntile(n).over(Window.partitionBy(*by).orderBy(*order)))
    place, size = F.col("__place"), F.col("__size")
    base, extra = F.floor(size / n), size % n
    wide = extra * (base + 1)
    bucket = F.when(place < wide, F.floor(place / (base + 1))).otherwise(F.floor((place - wide) / F.greatest(base, F.lit(1))) + extra) + 1
    return number_rows(known, list(by), order).withColumn(name, bucket.cast("int")).drop("__place", "__size")


def number_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """0-based place ``__place`` of every row in its group and rows ``__size`` of the group, at any group size.

    Rows are range-partitioned by group and order and written, so a large group lies in many parts; a place is the
    rows of the group in earlier parts plus the place within the part.  Rows that tie are spread by a hash.
    """
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sorted_parts = df.repartitionByRange(*[F.col(k) for k in keys], *order, spread)
    parts = materialize(sorted_parts.withColumn("__part", F.spark_partition_id()), "ranges")
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumns({"__before": F.coalesce(F.sum("__n").over(earlier), F.lit(0)), "__size": F.sum("__n").over(group)}).drop("__n")
    within = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*order))
    numbered = join_groups(parts.withColumn("__within", within), counts, [*keys, "__part"])
    return numbered.withColumn("__place", F.col("__before") + F.col("__within") - 1).drop("__before", "__within", "__part")
