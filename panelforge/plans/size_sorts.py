"""Break-point sorts on size and the grid of sorting choices."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.buckets import bucket_index, even_probabilities
from panelforge.operators.aggregates import weighted_mean
from panelforge.operators.quantiles import GroupProfile, broadcast_if_small, exact_quantiles, profile_groups

ALL_EXCHANGES = ("NYSE", "NASDAQ", "AMEX")

# The grid of sorting choices.
GRID_PORTFOLIOS = (2, 5, 10)
GRID_EXCHANGES = {"NYSE": ("NYSE",), "NYSE, NASDAQ, AMEX": ALL_EXCHANGES}
GRID_WEIGHTS = (True, False)
GRID_SPLIT = "1990-06-01"

#: Columns that name a specification.
SPEC = ("n_portfolios", "exchanges", "value_weighted", "subsample")


def breakpoints(
    panel: DataFrame, var: str, n: int, by: Sequence[str], exchanges: Sequence[str], profile: GroupProfile | None = None, **options
) -> DataFrame:
    """Array of ``n + 1`` quantiles per group over the securities of the chosen exchanges."""
    eligible = panel.where(F.col("exchange").isin(*exchanges))
    return exact_quantiles(eligible, var, even_probabilities(n), by, "breaks", profile=profile, **options)


def breakpoint_rows(breaks: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per bucket with its half-open interval, the outer ones reaching to infinity."""
    n = F.size("breaks") - 1
    rows = breaks.select(*by, F.posexplode("breaks").alias("portfolio", "upper"), F.col("breaks").alias("__b"), n.alias("__n"))
    rows = rows.where("portfolio > 0")
    low = F.when(F.col("portfolio") == 1, F.lit(float("-inf"))).otherwise(F.get("__b", F.col("portfolio") - 1))
    high = F.when(F.col("portfolio") == F.col("__n"), F.lit(float("inf"))).otherwise(F.col("upper"))
    return rows.select(*by, "portfolio", low.alias("port_min"), high.alias("port_max"))


def assign_portfolio(
    panel: DataFrame, var: str, n: int, by: Sequence[str], exchanges: Sequence[str], name: str = "portfolio", **options
) -> DataFrame:
    """Bucket 1..n of ``var`` for every security; rows without value or break points are dropped."""
    known = panel.where(F.col(var).isNotNull())
    profile = profile_groups(known.select(*by), by)
    breaks = breakpoints(known, var, n, by, exchanges, profile=profile, **options)
    joined = known.join(broadcast_if_small(breaks, profile.groups, n + 1), list(by))
    return joined.withColumn(name, bucket_index(F.col(var), F.col("breaks"), n)).drop("breaks")


def small_minus_big(returns: DataFrame, by: Sequence[str]) -> DataFrame:
    """Return of the lowest minus the highest bucket of each group."""
    spread = F.min_by("ret", "portfolio") - F.max_by("ret", "portfolio")
    return returns.groupBy(*by).agg(spread.alias("size_premium"))


def size_portfolios(panel: DataFrame, n: int = 10, exchanges: Sequence[str] = ALL_EXCHANGES, value_weighted: bool = True, **options) -> DataFrame:
    """Monthly returns of portfolios formed on lagged size."""
    assigned = assign_portfolio(panel, "mktcap_lag", n, ["month"], exchanges, **options).dropna(subset=["ret", "mktcap_lag"])
    weight = "mktcap_lag" if value_weighted else None
    return assigned.groupBy("month", "portfolio").agg(weighted_mean("ret_excess", weight).alias("ret"))


def size_premium(panel: DataFrame, n: int = 10, exchanges: Sequence[str] = ALL_EXCHANGES, value_weighted: bool = True, **options) -> DataFrame:
    """Average of the monthly small-minus-big returns."""
    monthly = small_minus_big(size_portfolios(panel, n, exchanges, value_weighted, **options), ["month"])
    return monthly.agg(F.avg("size_premium").alias("size_premium")).select(F.lit(", ".join(exchanges)).alias("exchanges"), "size_premium")


def grid_subsamples(split: str) -> dict[str, Column]:
    """Named predicates of the subsamples."""
    cut = F.lit(split).cast("date")
    return {
        "all": F.lit(True),
        "no finance": F.col("industry") != "Finance",
        f"before {split}": F.col("month") < cut,
        f"from {split}": F.col("month") >= cut,
    }


def grid_specs(
    spark: SparkSession,
    split: str = GRID_SPLIT,
    portfolios: Sequence[int] = GRID_PORTFOLIOS,
    exchanges: Sequence[str] = tuple(GRID_EXCHANGES),
    weights: Sequence[bool] = GRID_WEIGHTS,
    samples: Mapping[str, str] | None = None,
) -> DataFrame:
    """One numbered row per specification; ``samples`` gives the description of each subsample."""
    samples = samples or {name: name for name in grid_subsamples(split)}
    rows = [(i, *spec, samples[spec[-1]]) for i, spec in enumerate(product(sorted(portfolios), sorted(exchanges), weights, samples), start=1)]
    return spark.createDataFrame(rows, "spec long, n_portfolios int, exchanges string, value_weighted boolean, subsample string, data string")


def join_results(specs: DataFrame, results: DataFrame, name: str, by: Sequence[str] = SPEC) -> DataFrame:
    """The list of results of every specification (an array column) joined back to it, one row per known result."""
    joined = specs.join(results.select(*by, name), list(by))
    rest = [c for c in joined.columns if c != name]
    return joined.select(*rest, F.explode(name).alias(name)).where(F.col(name).isNotNull()).orderBy(F.desc(name))


def specification_grid(
    panel: DataFrame,
    split: str = GRID_SPLIT,
    portfolios: Sequence[int] = GRID_PORTFOLIOS,
    exchanges: Mapping[str, Sequence[str]] = GRID_EXCHANGES,
    weights: Sequence[bool] = GRID_WEIGHTS,
    **options,
) -> DataFrame:
    """Size premium for every combination of number of portfolios, exchanges, weighting and subsample.

    One plan answers all combinations.  Each row is labelled with the subsamples it belongs to and is placed once per
    exchange set, in the finest buckets, as many as the least common multiple of the numbers of portfolios; so the buckets
    of each number are unions of finest ones and follow from the small table of sums, as do both weightings.
    """
    finest = math.lcm(*portfolios)
    labels = F.array_compact(F.array(*[F.when(p, F.lit(name)) for name, p in grid_subsamples(split).items()]))
    rows = (
        panel.where(F.col("mktcap_lag").isNotNull())
        .select("month", "exchange", "ret", "ret_excess", "mktcap_lag", F.explode(labels).alias("subsample"))
    )
    sets = F.array_compact(F.array(*[F.when(F.col("exchange").isin(*members), F.lit(name)) for name, members in exchanges.items()]))
    group = ["month", "subsample", "exchanges"]
    eligible = rows.withColumn("exchanges", F.explode(sets))
    profile = profile_groups(eligible.select(*group), group)
    breaks = exact_quantiles(eligible, "mktcap_lag", even_probabilities(finest), group, "breaks", profile=profile, **options)
    per_cell = F.collect_list(F.struct("exchanges", "breaks")).alias("sets")
    cells = breaks.groupBy("month", "subsample").agg(per_cell)

    kept = rows.dropna(subset=["ret", "mktcap_lag", "ret_excess"])
    joined = kept.join(broadcast_if_small(cells, profile.groups, finest + 1), ["month", "subsample"])
    placed = joined.withColumn("set", F.explode("sets")).select(
        "month", "subsample", F.col("set.exchanges").alias("exchanges"), "ret_excess", "mktcap_lag",
        bucket_index(F.col("mktcap_lag"), F.col("set.breaks"), finest).alias("fine"),
    )
    sums = placed.groupBy(*group, "fine").agg(
        F.sum(F.col("ret_excess") * F.col("mktcap_lag")).alias("weighted"), F.sum("mktcap_lag").alias("weight"),
        F.sum("ret_excess").alias("plain"), F.count("ret_excess").alias("rows"),
    )
    coarser = sums.withColumn("n_portfolios", F.explode(F.array(*[F.lit(n) for n in portfolios])))
    bucket = F.floor((F.col("fine") - 1) / (F.lit(finest) / F.col("n_portfolios"))).cast("int") + 1
    returns = coarser.groupBy(*group, "n_portfolios", bucket.alias("portfolio")).agg(
        (F.sum("weighted") / F.nullif(F.sum("weight"), F.lit(0.0))).alias("by_size"), (F.sum("plain") / F.sum("rows")).alias("by_count")
    )
    weightings = F.array(*[F.struct(F.lit(size).alias("w"), F.col("by_size" if size else "by_count").alias("ret")) for size in weights])
    both = returns.withColumn("e", F.explode(weightings)).select(
        *group, "n_portfolios", "portfolio", F.col("e.w").alias("value_weighted"), F.col("e.ret").alias("ret")
    )
    monthly = small_minus_big(both, ["month", *SPEC])
    out = monthly.groupBy(*SPEC).agg(F.avg("size_premium").alias("size_premium"))
    return out.where("size_premium IS NOT NULL").orderBy(F.desc("size_premium"))
