"""Cleaning of corporate-bond trade reports: cancellations, corrections, reversals, agency trades.

Each removal is a semi or anti join against distinct keys, so copies of a report never multiply.  Corrections are
followed on report keys only, and reversals are paired by counting, so neither step sorts or gathers a group of
equal trades.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.scalars import null_or
from panelforge.operators.joins import drop_matched, keep_matched
from panelforge.storage import materialize

# Start of the later reporting regime, message keys and filter limits.
REGIME_START = "2012-02-06"
TERMS = ("cusip_id", "trd_exctn_dt", "entrd_vol_qt", "rptd_pr", "rpt_side_cd", "cntra_mp_id")
MESSAGE_KEY = (
    "cusip_id", "msg_seq_nb", "entrd_vol_qt", "rptd_pr", "rpt_side_cd", "cntra_mp_id", "trd_exctn_dt", "trd_exctn_tm",
)
COLUMNS = (
    "cusip_id", "msg_seq_nb", "orig_msg_seq_nb", "entrd_vol_qt", "rptd_pr", "yld_pt", "rpt_side_cd", "cntra_mp_id",
    "trd_exctn_dt", "trd_exctn_tm", "trd_rpt_dt", "trd_rpt_tm", "pr_trd_dt", "trc_st", "asof_cd", "wis_fl",
    "days_to_sttl_ct", "stlmnt_dt", "spcl_trd_fl",
)
OUTPUT_COLUMNS = (
    "cusip_id", "trd_exctn_dt", "trd_exctn_tm", "rptd_pr", "entrd_vol_qt", "yld_pt", "rpt_side_cd", "cntra_mp_id",
)
FINAL_COLUMNS = (*OUTPUT_COLUMNS, "asof_cd", "wis_fl", "days_to_sttl_ct", "stlmnt_dt", "spcl_trd_fl")
NOT_A_TRADE = ("R", "X", "D")
MAX_SETTLEMENT_DAYS = 7
COPIES_PER_ROW = 100_000


def scope(trades: DataFrame, start: str, end: str, ids: DataFrame | None = None) -> DataFrame:
    """Reports executed in the date window, optionally of listed bonds only (``ids`` has ``cusip_id``)."""
    day = F.col("trd_exctn_dt")
    inside = trades.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(*COLUMNS)
    return inside if ids is None else keep_matched(inside, ids, {"cusip_id": "cusip_id"})


def _regime(later: bool) -> Column:
    start = F.lit(REGIME_START).cast("date")
    return F.col("trd_rpt_dt") >= start if later else F.col("trd_rpt_dt") < start


def _status(trades: DataFrame, later: bool, *codes: str) -> DataFrame:
    return trades.where(F.col("trc_st").isin(*codes) & _regime(later))


def _same_message() -> dict[str, str]:
    return {c: c for c in MESSAGE_KEY}


def _original_message() -> dict[str, str]:
    return _same_message() | {"msg_seq_nb": "orig_msg_seq_nb"}


def post_cancel(trades: DataFrame) -> DataFrame:
    """Later regime: trades and corrections that no cancellation names."""
    return drop_matched(_status(trades, True, "T", "R"), _status(trades, True, "X", "C"), _same_message())


def post_reversal(kept: DataFrame, trades: DataFrame) -> DataFrame:
    """Later regime: drop reports that a reversal names as its original."""
    return drop_matched(kept, _status(trades, True, "Y"), _original_message())


def post_regime(trades: DataFrame) -> DataFrame:
    """Cancellations and reversals of the later regime in one anti join, as both match the same key of the trades."""
    cancelled = _status(trades, True, "X", "C").select(*MESSAGE_KEY)
    reversed_ = _status(trades, True, "Y").select(*[F.col(theirs).alias(ours) for ours, theirs in _original_message().items()])
    return drop_matched(_status(trades, True, "T", "R"), cancelled.unionByName(reversed_), _same_message(), hashed=True)


def pre_cancel(trades: DataFrame) -> DataFrame:
    """Earlier regime: trades that no cancellation names as its original."""
    return drop_matched(_status(trades, False, "T"), _status(trades, False, "C"), _original_message(), hashed=True)


def correction_levels(kept: DataFrame, corrections: DataFrame) -> DataFrame:
    """The round in which each corrected report key (``cusip_id``, ``trd_exctn_dt``, ``key``) first appears: 0 for keys in ``kept``.

    A key first appears one round after the earliest of the keys that it corrects, so its round is its distance from ``kept``.
    Keys that correct just one other are followed by pointers that reach four times as far with every written table; a chain of n
    links takes log4 n of them, and pointers that still move after more steps than there are keys run in a circle that no kept
    key enters.  What is left is a graph of the keys where chains begin or meet, whose distances are relaxed until they stay.
    """
    group = ["cusip_id", "trd_exctn_dt"]
    edges = corrections.where("orig_msg_seq_nb IS NOT NULL").select(
        *group, F.col("orig_msg_seq_nb").alias("original"), F.col("msg_seq_nb").alias("key")
    )
    edges = materialize(edges.distinct(), "corrections")
    originals = edges.select(*group, F.col("original").alias("key")).distinct()
    present = kept.select(*group, F.col("msg_seq_nb").alias("key")).distinct().withColumn("present", F.lit(True))
    into = edges.where("original <> key").groupBy(*group, "key").agg(F.count(F.lit(1)).alias("n"), F.min("original").alias("to"))
    nodes = originals.join(present.hint("shuffle_hash"), [*group, "key"], "left").join(into.hint("shuffle_hash"), [*group, "key"], "left")
    nodes = materialize(nodes, "corrected-keys")

    jumps = nodes.where("present IS NULL AND n = 1").select(*group, "key", "to", F.lit(1).cast("long").alias("steps"))
    jumps, reach, bound = materialize(jumps, "jumps"), 1, None
    while True:
        onward = jumps.select(*group, F.col("key").alias("to"), F.col("to").alias("__to"), F.col("steps").alias("__steps"))
        moving = jumps.join(onward.select(*group, "to"), [*group, "to"], "left_semi").count()
        bound = jumps.count() if bound is None else bound
        if not moving or reach > bound:
            break
        farther = jumps
        for _ in range(3):
            farther = farther.join(onward, [*group, "to"], "left").select(
                *group, "key", F.coalesce("__to", "to").alias("to"), (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps")
            )
        jumps, reach = materialize(farther, "jumps"), reach * 4

    roots = nodes.where("present OR n IS NULL OR n <> 1").select(*group, "key", F.col("key").alias("to"), F.lit(0).cast("long").alias("steps"))
    roots = roots.unionByName(jumps)
    meets = nodes.where("present IS NULL AND n > 1").select(*group, "key")
    links = edges.where("original <> key").join(meets, [*group, "key"], "left_semi")
    links = links.join(roots.select(*group, F.col("key").alias("original"), F.col("to").alias("origin"), "steps"), [*group, "original"])
    links = materialize(links.groupBy(*group, "key", "origin").agg((F.min("steps") + 1).alias("steps")), "meeting-chains")
    begun = materialize(nodes.where("present").select(*group, F.col("key").alias("origin"), F.lit(0).cast("long").alias("level")), "levels")
    while True:
        reached = links.join(begun, [*group, "origin"]).select(*group, F.col("key").alias("origin"), (F.col("level") + F.col("steps")).alias("level"))
        nearer = begun.unionByName(reached).groupBy(*group, "origin").agg(F.min("level").alias("level"))
        if links.isEmpty() or nearer.exceptAll(begun).isEmpty():
            break
        begun = materialize(nearer, "levels")
    found = roots.join(begun.withColumnRenamed("origin", "to"), [*group, "to"])
    return found.select(*group, "key", (F.col("level") + F.col("steps")).alias("level"))


def pre_corrections(kept: DataFrame, trades: DataFrame) -> DataFrame:
    """Earlier regime: replace each corrected report by its correction, which may itself be corrected.

    A report key is (bond, day, sequence number).  All corrections of a key apply together, in the round after the
    key first appears, and remove exactly the reports that were there at that time.  It is therefore enough to find
    the first round of every corrected key, which ``correction_levels`` does on the keys of corrections only, never on trades.
    """
    corrections = _status(trades, False, "W")
    group = ["cusip_id", "trd_exctn_dt"]
    levels = materialize(correction_levels(kept, corrections), "levels")
    removed = levels.where("level = 0").withColumnRenamed("key", "msg_seq_nb").drop("level")
    untouched = kept.join(removed.hint("shuffle_hash"), [*group, "msg_seq_nb"], "left_anti")
    named = levels.withColumnsRenamed({"key": "orig_msg_seq_nb", "level": "__l"}).hint("shuffle_hash")
    applied = corrections.join(named, [*group, "orig_msg_seq_nb"])
    gone = levels.withColumnsRenamed({"key": "msg_seq_nb", "level": "__at"}).hint("shuffle_hash")
    applied = applied.join(gone, [*group, "msg_seq_nb"], "left").where("__at IS NULL OR __l + 1 > __at")
    return untouched.unionByName(applied.select(*kept.columns))


def pre_reversals(kept: DataFrame) -> DataFrame:
    """Earlier regime: drop reversals, and for each one the next trade with the same terms, in time order.

    With c reversals of some terms the first c matching trades go.  Only terms with a reversal are looked at; their
    identical reports are counted before they are ordered, first by execution time (bounded by the seconds of a
    day) and then within one time, so a large group of copies is one row until the survivors are written out again.
    The reports are written with the count of their reversals: they are dealt by terms once, a hot key of that join is
    split by skew handling, and the copies are combined map-side by the count.  ``kept`` is read for the few columns of its
    reversals and once for the rest, so callers need not write it.
    """
    terms = list(TERMS)
    reversals = kept.where("asof_cd = 'R'").groupBy(*terms).agg(F.count(F.lit(1)).alias("__c"))
    reversals = materialize(reversals, "reversals")
    candidates = kept.where(null_or(F.col("asof_cd"), ~F.col("asof_cd").isin(*NOT_A_TRADE)))
    marked = materialize(candidates.join(reversals.hint("shuffle_hash"), terms, "left"), "candidates")

    columns = kept.columns
    safe, affected = marked.where("__c IS NULL"), marked.where("__c IS NOT NULL")
    counted = affected.groupBy(*columns, "__c").agg(F.count(F.lit(1)).alias("__copies"))
    times = counted.groupBy(*terms, "trd_exctn_tm").agg(F.sum("__copies").alias("__at_time"))
    by_time = Window.partitionBy(*terms).orderBy(F.col("trd_exctn_tm").asc_nulls_last())
    times = times.withColumn("__earlier", F.sum("__at_time").over(by_time.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__at_time"))
    first_keys = ["trd_rpt_dt", "trd_rpt_tm", "msg_seq_nb"]
    rest = [c for c in columns if c not in (*terms, "trd_exctn_tm", *first_keys)]
    order = [F.col(c).asc_nulls_last() for c in [*first_keys, *rest]]
    within = Window.partitionBy(*terms, "__tm").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same_time = F.coalesce("trd_exctn_tm", F.lit(""))
    placed = counted.withColumn("__tm", same_time).join(
        times.select(*terms, same_time.alias("__tm"), "__earlier"), [*terms, "__tm"]
    )
    last = F.col("__earlier") + F.sum("__copies").over(within)
    survivors = placed.withColumn("__keep", F.least(F.col("__copies"), last - F.col("__c"))).where("__keep > 0")
    return safe.select(*columns).unionByName(repeat_rows(survivors, "__keep").select(*columns))


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Write each row out ``copies`` times; large counts are split so that no task writes them all."""
    columns = [c for c in df.columns if c != copies]
    last_piece = F.floor((F.col(copies) - 1) / COPIES_PER_ROW)
    pieces = df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)).alias("__piece"))
    size = F.least(F.lit(COPIES_PER_ROW).cast("long"), F.col(copies) - F.col("__piece") * COPIES_PER_ROW).cast("int")
    spread = pieces.withColumn("__size", size).repartition(*columns, "__piece")
    return spread.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("__size"))).alias("__x")).drop("__x")


def agency(trades: DataFrame) -> DataFrame:
    """Customer trades, agency sells, and agency buys without a matching agency sell."""
    side, counterparty = F.col("rpt_side_cd"), F.col("cntra_mp_id")
    sells = trades.where((counterparty == "D") & (side == "S"))
    buys = trades.where((counterparty == "D") & (side == "B"))
    match = {c: c for c in ("cusip_id", "trd_exctn_dt", "entrd_vol_qt", "rptd_pr")}
    plain = trades.where((counterparty == "C") | ((counterparty == "D") & (side == "S")))
    return plain.unionByName(drop_matched(buys, sells, match, hashed=True).select(*trades.columns))


def settlement_filters(trades: DataFrame) -> DataFrame:
    """Regular settlement, not when-issued, no special or as-of flag."""
    stated = F.col("days_to_sttl_ct")
    actual = F.datediff("stlmnt_dt", "trd_exctn_dt")
    return trades.where(
        null_or(stated, stated.cast("double") <= MAX_SETTLEMENT_DAYS)
        & null_or(actual, actual <= MAX_SETTLEMENT_DAYS)
        & (F.col("wis_fl") == "N")
        & null_or(F.col("spcl_trd_fl"), F.col("spcl_trd_fl") == "")
        & null_or(F.col("asof_cd"), F.col("asof_cd") == "")
    )


def output(trades: DataFrame, ordered: bool = True) -> DataFrame:
    out = trades.select(*OUTPUT_COLUMNS)
    return out.orderBy("cusip_id", "trd_exctn_dt", "trd_exctn_tm") if ordered else out


def clean_trades(trades: DataFrame, start: str, end: str, ids: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """All cleaning steps in order.

    The scope is a filter that each branch pushes into its own narrow scan, so it is written only when a list of
    bonds has to be joined first.  Results of anti joins that several branches read are written once.
    """
    scoped = scope(trades, start, end, ids)
    if ids is not None:
        scoped = materialize(scoped, "scope")
    later = post_regime(scoped)
    kept = materialize(pre_cancel(scoped).select(*COLUMNS), "kept")
    earlier = pre_reversals(pre_corrections(kept, scoped))
    combined = later.select(*FINAL_COLUMNS).unionByName(earlier.select(*FINAL_COLUMNS))
    return output(settlement_filters(agency(materialize(combined, "combined"))), ordered)
