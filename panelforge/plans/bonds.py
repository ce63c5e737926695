"""Bond universe and bond market activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import months_apart, quarter_of
from panelforge.functions.scalars import all_of
from panelforge.operators.aggregates import summarize
from panelforge.operators.reshape import to_long

# Flags and codes of the corporate-bond universe.
FLAGS_NO = (
    "slob", "asset_backed", "defeased", "yankee", "canadian", "foreign_currency", "coupon_change_indicator",
    "rule_144a", "private_placement", "defaulted", "convertible", "putable", "unit_deal", "exchangeable",
    "perpetual", "preferred_security",
)
MUST_BE_MISSING = ("security_pledge", "fix_frequency", "filing_date", "settlement", "exchange")
SECURITY_LEVEL = "SEN"
BOND_TYPES = ("CDEB", "CMTN", "CMTZ", "CZ", "USBN")
COUPON_TYPES = ("F", "Z")
INTEREST_FREQUENCIES = ("0", "1", "2", "4", "12")
COUNTRY = "USA"
ISSUE_COLUMNS = (
    "complete_cusip", "maturity", "offering_amt", "offering_date", "dated_date", "interest_frequency", "coupon",
    "last_interest_date", "issue_id", "issuer_id",
)
GRID_START, GRID_END = "2014-01-01", "2016-11-30"


def universe_predicate() -> Column:
    plain = [F.col(c) == "N" for c in FLAGS_NO] + [F.col(c).isNull() for c in MUST_BE_MISSING]
    return all_of(
        *plain,
        F.col("security_level") == SECURITY_LEVEL,
        F.col("bond_type").isin(*BOND_TYPES),
        F.col("pay_in_kind") != "Y",
        F.col("coupon_type").isin(*COUPON_TYPES),
        F.col("interest_frequency").isin(*INTEREST_FREQUENCIES),
    )


def bond_universe(issues: DataFrame, issuers: DataFrame) -> DataFrame:
    """Plain senior corporate issues of domestic issuers, with the issuer's industry code."""
    domestic = issuers.where(F.col("country_domicile") == COUNTRY).select("issuer_id", "sic_code")
    return issues.where(universe_predicate()).select(*ISSUE_COLUMNS).join(domestic, "issuer_id")


def bonds_outstanding(bonds: DataFrame, start: str = GRID_START, end: str = GRID_END) -> DataFrame:
    """Number of live bonds at each quarter start of the grid.

    Each bond adds one at the first grid date on or after its offering and takes one away at the first grid date
    after its maturity; counting these changes per grid position and adding them up replaces a bond x date product.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    points = F.floor(months_apart(first, last) / 3) + 1

    def steps_before(date: Column, inclusive: bool) -> Column:
        """Number of grid dates before ``date`` (or up to it)."""
        whole = F.floor(F.months_between(date, first, False) / 3).cast("int")
        on_grid = F.add_months(first, whole * 3) == date
        count = F.when(F.lit(inclusive) | ~on_grid, whole + 1).otherwise(whole)
        return F.greatest(F.lit(0), F.least(count, points.cast("int")))

    spans = bonds.where("offering_date IS NOT NULL AND maturity IS NOT NULL").select(
        steps_before(F.col("offering_date"), False).alias("enter"), steps_before(F.col("maturity"), True).alias("leave")
    )
    spans = spans.where("enter < leave")
    changes = spans.select(
        F.explode(F.array(F.struct(F.col("enter").alias("at"), F.lit(1).alias("d")), F.struct(F.col("leave").alias("at"), F.lit(-1).alias("d")))).alias("e")
    ).groupBy("e.at").agg(F.sum("e.d").alias("d"))
    grid = changes.groupBy().agg(F.collect_list(F.struct("at", "d")).alias("changes"))
    grid = grid.select("changes", F.explode(F.sequence(F.lit(0), points.cast("int") - 1)).alias("k"))
    live = F.aggregate("changes", F.lit(0).cast("long"), lambda n, c: n + F.when(c["at"] <= F.col("k"), c["d"]).otherwise(0))
    return grid.select(F.add_months(first, F.col("k") * 3).alias("date"), live.alias("n"), F.lit("Outstanding").alias("type")).where("n > 0")


def bonds_traded(trades: DataFrame) -> DataFrame:
    """Distinct bonds traded per quarter."""
    return trades.groupBy(quarter_of("trd_exctn_dt").alias("date")).agg(F.count_distinct("cusip_id").alias("n")).withColumn(
        "type", F.lit("Traded")
    )


def bond_activity(bonds: DataFrame, trades: DataFrame) -> DataFrame:
    return bonds_outstanding(bonds).unionByName(bonds_traded(trades))


def bond_summary(bonds: DataFrame, **options) -> DataFrame:
    """Distribution of maturity in years, coupon and size in millions."""
    measures = bonds.select(
        (F.datediff("maturity", "offering_date") / 365).alias("maturity"), F.col("coupon").cast("double").alias("coupon"),
        (F.col("offering_amt") / 1000).alias("offering_amt"),
    )
    return summarize(to_long(measures, [], measures.columns, "measure"), "value", ["measure"], **options)


def trade_day_summary(trades: DataFrame, **options) -> DataFrame:
    """Distribution over days of traded volume in millions and of the number of trades."""
    days = trades.groupBy("trd_exctn_dt").agg(
        (F.coalesce(F.sum(F.col("entrd_vol_qt") * F.col("rptd_pr") / 100), F.lit(0.0)) / 1e6).alias("trade_size"),
        F.count(F.lit(1)).cast("double").alias("trade_number"),
    )
    return summarize(to_long(days, [], ["trade_size", "trade_number"], "measure"), "value", ["measure"], **options)
