"""Bond universe, trade cleaning and bond activity."""

from __future__ import annotations

from panelforge.plans import bonds, trades
from panelforge.storage import materialize
from panelforge.workload import tables_sql
from panelforge.workload.bond_sql import TRADE_CTES
from panelforge.workload.registry import query
from panelforge.workload.tables import TRADE_END, TRADE_START

tables_sql.CTES.update(TRADE_CTES)
tables_sql.CTES["t_bonds"] = (
    "SELECT "
    + ", ".join(f"i.{c}" for c in bonds.ISSUE_COLUMNS)
    + ", r.sic_code FROM t_issues i JOIN t_issuers r ON i.issuer_id = r.issuer_id WHERE r.country_domicile = 'USA' AND "
    + " AND ".join(f"{c} = 'N'" for c in bonds.FLAGS_NO)
    + " AND "
    + " AND ".join(f"{c} IS NULL" for c in bonds.MUST_BE_MISSING)
    + """ AND security_level = 'SEN' AND bond_type IN ('CDEB', 'CMTN', 'CMTZ', 'CZ', 'USBN') AND pay_in_kind <> 'Y'
       AND coupon_type IN ('F', 'Z') AND interest_frequency IN ('0', '1', '2', '4', '12')"""
)

SHOWN = (
    "cusip_id, trd_exctn_dt, trd_exctn_tm, msg_seq_nb, orig_msg_seq_nb, entrd_vol_qt, rptd_pr, yld_pt, rpt_side_cd, "
    "cntra_mp_id, trd_rpt_dt, trd_rpt_tm, trc_st, asof_cd"
)
COLUMNS = SHOWN.split(", ")


def _scope(t):
    return trades.scope(t.trades, TRADE_START, TRADE_END)


def _corrected(t):
    """The scope is a filter that each branch pushes into its own narrow scan of the reports, so it is not written."""
    scoped = _scope(t)
    kept = materialize(trades.pre_cancel(scoped).select(*trades.COLUMNS), "kept")
    return trades.pre_corrections(kept, scoped)


def _combined(t, *columns):
    later = trades.post_regime(_scope(t)).select(*columns)
    earlier = trades.pre_reversals(_corrected(t))
    return materialize(later.unionByName(earlier.select(*columns)), "combined")


@query("bond_universe", "SELECT * FROM t_bonds", "offering_amt coupon", 4)
def bond_universe(t):
    return bonds.bond_universe(t.issues, t.issuers)


@query("trade_scope", f"SELECT {SHOWN} FROM t_scope", "yld_pt")
def trade_scope(t):
    return _scope(t).select(*COLUMNS)


@query(
    "trade_scope_ids",
    f"SELECT {SHOWN} FROM t_scope WHERE cusip_id IN (SELECT complete_cusip FROM t_issues WHERE bond_type = 'CDEB')",
    "yld_pt",
)
def trade_scope_ids(t):
    ids = t.issues.where("bond_type = 'CDEB'").selectExpr("complete_cusip AS cusip_id")
    return trades.scope(t.trades, TRADE_START, TRADE_END, ids).select(*COLUMNS)


@query("post_cancel", f"SELECT {SHOWN} FROM t_post_cancel", "yld_pt")
def post_cancel(t):
    return trades.post_cancel(_scope(t)).select(*COLUMNS)


@query("post_reversal", f"SELECT {SHOWN} FROM t_post", "yld_pt")
def post_reversal(t):
    scoped = _scope(t)
    return trades.post_reversal(trades.post_cancel(scoped), scoped).select(*COLUMNS)


@query("pre_cancel", f"SELECT {SHOWN} FROM t_pre_cancel", "yld_pt")
def pre_cancel(t):
    return trades.pre_cancel(_scope(t)).select(*COLUMNS)


@query("pre_corrections", f"SELECT {SHOWN} FROM t_pre_corrections", "yld_pt")
def pre_corrections(t):
    return _corrected(t).select(*COLUMNS)


@query("pre_reversals", f"SELECT {SHOWN} FROM t_pre_reversals", "yld_pt")
def pre_reversals(t):
    return trades.pre_reversals(_corrected(t)).select(*COLUMNS)


@query("agency", f"SELECT {SHOWN} FROM t_agency", "yld_pt")
def agency(t):
    return trades.agency(_combined(t, *COLUMNS))


@query("settlement_filters", f"SELECT {SHOWN} FROM t_settled", "yld_pt")
def settlement_filters(t):
    combined = _combined(t, *dict.fromkeys([*COLUMNS, *trades.FINAL_COLUMNS]))
    return trades.settlement_filters(trades.agency(combined)).select(*COLUMNS)


@query(
    "clean_trades",
    f"SELECT {', '.join(trades.OUTPUT_COLUMNS)} FROM t_settled ORDER BY cusip_id, trd_exctn_dt, trd_exctn_tm",
    "yld_pt",
)
def clean_trades(t):
    return trades.clean_trades(t.trades, TRADE_START, TRADE_END)


@query(
    "bonds_outstanding",
    """SELECT date, count(*) AS n, 'Outstanding' AS type
       FROM (SELECT CAST(unnest(generate_series(DATE '2014-01-01', DATE '2016-11-30', INTERVAL 3 MONTH)) AS DATE) AS date) g
       JOIN t_bonds b ON g.date BETWEEN b.offering_date AND b.maturity GROUP BY date""",
)
def bonds_outstanding(t):
    return bonds.bonds_outstanding(bonds.bond_universe(t.issues, t.issuers))


@query(
    "bonds_traded",
    "SELECT CAST(date_trunc('quarter', trd_exctn_dt) AS DATE) AS date, count(DISTINCT cusip_id) AS n, 'Traded' AS type FROM t_trades GROUP BY 1",
)
def bonds_traded(t):
    return bonds.bonds_traded(t.trades)


@query(
    "bond_activity",
    """SELECT date, count(*) AS n, 'Outstanding' AS type
       FROM (SELECT CAST(unnest(generate_series(DATE '2014-01-01', DATE '2016-11-30', INTERVAL 3 MONTH)) AS DATE) AS date) g
       JOIN t_issues b ON g.date BETWEEN b.offering_date AND b.maturity GROUP BY date
       UNION ALL SELECT CAST(date_trunc('quarter', trd_exctn_dt) AS DATE), count(DISTINCT cusip_id), 'Traded' FROM t_trades GROUP BY 1""",
)
def bond_activity(t):
    return bonds.bond_activity(t.issues, t.trades)


SUMMARY = """avg(value) AS mean, stddev_samp(value) AS sd, min(value) AS min, quantile_cont(value, 0.05) AS q05,
    quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.95) AS q95, max(value) AS max, count(value) AS n"""


@query(
    "bond_summary",
    f"""SELECT measure, {SUMMARY} FROM (SELECT (maturity - offering_date) / 365 AS maturity, coupon, offering_amt / 1000 AS offering_amt FROM t_bonds)
        UNPIVOT (value FOR measure IN (maturity, coupon, offering_amt)) GROUP BY measure""",
    "mean sd min q05 q50 q95 max", 8,
)
def bond_summary(t):
    return bonds.bond_summary(bonds.bond_universe(t.issues, t.issuers))


@query(
    "trade_day_summary",
    f"""SELECT measure, {SUMMARY} FROM (SELECT trd_exctn_dt, sum(entrd_vol_qt * rptd_pr / 100) / 1e6 AS trade_size, CAST(count(*) AS DOUBLE) AS trade_number
          FROM t_trades GROUP BY trd_exctn_dt) UNPIVOT (value FOR measure IN (trade_size, trade_number)) GROUP BY measure""",
    "mean sd min q05 q50 q95 max", 8,
)
def trade_day_summary(t):
    return bonds.trade_day_summary(t.trades)
