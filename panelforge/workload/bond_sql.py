"""SQL twins of the trade-cleaning steps; corrections are unrolled pass by pass."""

from __future__ import annotations

from panelforge.plans.trades import MESSAGE_KEY, TERMS
from panelforge.workload.tables import TRADE_END, TRADE_START

PASSES = 8


def _match(keys, original: bool = False) -> str:
    return " AND ".join(f"a.{k} = b.{'orig_msg_seq_nb' if original and k == 'msg_seq_nb' else k}" for k in keys)


def _anti(left: str, right: str, condition: str) -> str:
    return f"SELECT a.* FROM ({left}) a WHERE NOT EXISTS (SELECT 1 FROM ({right}) b WHERE {condition})"


def _semi(left: str, right: str, condition: str) -> str:
    return f"SELECT a.* FROM ({left}) a WHERE EXISTS (SELECT 1 FROM ({right}) b WHERE {condition})"


def _status(regime: str, codes: str) -> str:
    return f"SELECT * FROM t_scope WHERE trc_st IN ({codes}) AND trd_rpt_dt {regime} DATE '2012-02-06'"


CORRECTS = "a.cusip_id = b.cusip_id AND a.trd_exctn_dt = b.trd_exctn_dt AND a.orig_msg_seq_nb = b.msg_seq_nb"
CORRECTED = "a.cusip_id = b.cusip_id AND a.trd_exctn_dt = b.trd_exctn_dt AND a.msg_seq_nb = b.orig_msg_seq_nb"
GROUP = ", ".join(TERMS)
ORDER = (
    "trd_exctn_tm, trd_rpt_dt, trd_rpt_tm, msg_seq_nb, orig_msg_seq_nb, yld_pt, pr_trd_dt, trc_st, asof_cd, wis_fl, "
    "days_to_sttl_ct, stlmnt_dt, spcl_trd_fl"
)

TRADE_CTES = {
    "t_scope": f"SELECT * FROM t_trades WHERE trd_exctn_dt BETWEEN DATE '{TRADE_START}' AND DATE '{TRADE_END}'",
    "t_post_cancel": _anti(_status(">=", "'T', 'R'"), _status(">=", "'X', 'C'"), _match(MESSAGE_KEY)),
    "t_post": _anti("SELECT * FROM t_post_cancel", _status(">=", "'Y'"), _match(MESSAGE_KEY, True)),
    "t_pre_cancel": _anti(_status("<", "'T'"), _status("<", "'C'"), _match(MESSAGE_KEY, True)),
    "t_kept0": "SELECT * FROM t_pre_cancel",
    "t_open0": _status("<", "'W'"),
}
for _i in range(1, PASSES + 1):
    TRADE_CTES[f"t_applied{_i}"] = _semi(f"SELECT * FROM t_open{_i - 1}", f"SELECT * FROM t_kept{_i - 1}", CORRECTS)
    TRADE_CTES[f"t_open{_i}"] = _anti(f"SELECT * FROM t_open{_i - 1}", f"SELECT * FROM t_kept{_i - 1}", CORRECTS)
    TRADE_CTES[f"t_kept{_i}"] = (
        _anti(f"SELECT * FROM t_kept{_i - 1}", f"SELECT * FROM t_applied{_i}", CORRECTED) + f" UNION ALL SELECT * FROM t_applied{_i}"
    )
TRADE_CTES |= {
    "t_pre_corrections": f"SELECT * FROM t_kept{PASSES}",
    "t_pre_reversals": f"""
        SELECT c.* EXCLUDE (seq, dropped) FROM (
          SELECT a.*, row_number() OVER (PARTITION BY {", ".join("a." + k for k in TERMS)} ORDER BY {", ".join("a." + k for k in ORDER.split(", "))}) AS seq,
                 coalesce(r.n, 0) AS dropped
          FROM (SELECT * FROM t_pre_corrections WHERE asof_cd IS NULL OR asof_cd NOT IN ('R', 'X', 'D')) a
          LEFT JOIN (SELECT {GROUP}, count(*) AS n FROM t_pre_corrections WHERE asof_cd = 'R' GROUP BY ALL) r
            ON {" AND ".join(f"a.{k} = r.{k}" for k in TERMS)}) c
        WHERE seq > dropped""",
    "t_combined": "SELECT * FROM t_post UNION ALL SELECT * FROM t_pre_reversals",
    "t_agency": "SELECT * FROM t_combined WHERE cntra_mp_id = 'C' OR (cntra_mp_id = 'D' AND rpt_side_cd = 'S') UNION ALL "
    + _anti(
        "SELECT * FROM t_combined WHERE cntra_mp_id = 'D' AND rpt_side_cd = 'B'",
        "SELECT * FROM t_combined WHERE cntra_mp_id = 'D' AND rpt_side_cd = 'S'",
        _match(("cusip_id", "trd_exctn_dt", "entrd_vol_qt", "rptd_pr")),
    ),
    "t_settled": """
        SELECT * FROM t_agency WHERE (days_to_sttl_ct IS NULL OR CAST(days_to_sttl_ct AS DOUBLE) <= 7)
          AND (stlmnt_dt IS NULL OR stlmnt_dt - trd_exctn_dt <= 7) AND wis_fl = 'N'
          AND (spcl_trd_fl IS NULL OR spcl_trd_fl = '') AND (asof_cd IS NULL OR asof_cd = '')""",
}
