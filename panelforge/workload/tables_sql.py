"""SQL twins of the tables in ``tables``, as common table expressions, and the SQL text builder."""

from __future__ import annotations

import re

from panelforge.workload.tables import AS_OF, DAILY_MIN_OBS, END, INDUSTRY_COLUMNS, START


def _units(amount: str, per_unit: int) -> str:
    return f"sum(floor(({amount}) * {per_unit} + 0.5)) / {per_unit}"


def _spread(condition: str) -> str:
    return f"round((avg(CASE WHEN {condition} THEN r END) - avg(CASE WHEN NOT ({condition}) THEN r END)) * 100, 6)"


def _flag(name: str, modulus: int) -> str:
    return f"CASE WHEN p_partkey % {modulus} = 0 THEN 'Y' ELSE 'N' END AS {name}"


def _rare(name: str, modulus: int) -> str:
    return f"CASE WHEN p_partkey % {modulus} = 1 THEN 'x' END AS {name}"


_MI = "CAST(year({0}) * 12 + month({0}) AS INTEGER)"
_MONTH = "CAST(date_trunc('month', {0}) AS DATE)"
_OFFERED = "(DATE '2000-01-01' + CAST(p_partkey * 53 % 6000 AS INTEGER))"

_FLAGS = {
    "slob": 43, "asset_backed": 47, "defeased": 53, "yankee": 59, "canadian": 61, "foreign_currency": 67,
    "coupon_change_indicator": 71, "rule_144a": 31, "private_placement": 73, "defaulted": 79, "convertible": 83,
    "putable": 89, "unit_deal": 97, "exchangeable": 101, "perpetual": 103, "preferred_security": 107,
}

CTES: dict[str, str] = {
    "t_monthly_trade": f"""
        SELECT *, {_MI.format("month")} AS mi, disc / vol - 0.05 AS r FROM (
          SELECT CAST(l_suppkey AS INTEGER) AS permno, {_MONTH.format("l_shipdate")} AS month,
                 max(CAST(l_shipdate AS DATE)) AS last_date, sum(l_quantity) AS qty,
                 {_units('l_extendedprice', 100)} AS vol, {_units('l_extendedprice * l_discount', 10_000)} AS disc,
                 max(l_extendedprice) AS top
          FROM lineitem GROUP BY 1, 2)""",
    "t_daily_trade": f"""
        SELECT *, {_MI.format("date")} AS mi, disc / vol - 0.05 AS r FROM (
          SELECT CAST(l_suppkey AS INTEGER) AS permno, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS qty,
                 {_units('l_extendedprice', 100)} AS vol, {_units('l_extendedprice * l_discount', 10_000)} AS disc
          FROM lineitem GROUP BY 1, 2)""",
    "t_msf": """
        SELECT permno, last_date AS date, CASE WHEN (permno * 7 + mi) % 53 <> 0 THEN r END AS ret,
               CASE WHEN (permno * 31 + mi) % 97 = 0 THEN 0.0 ELSE qty END AS shrout,
               CASE WHEN (permno + mi) % 11 = 0 THEN -vol / qty ELSE vol / qty END AS altprc
        FROM t_monthly_trade WHERE (permno * 13 + mi) % 61 <> 0""",
    "t_dsf": "SELECT permno, date, CASE WHEN (permno * 7 + mi + day(date)) % 53 <> 0 THEN r END AS ret FROM t_daily_trade",
    "t_names": """
        SELECT CAST(s_suppkey AS INTEGER) AS permno,
               CAST(CASE WHEN s_suppkey % 9 = 8 THEN 12 ELSE 10 + s_suppkey % 2 END AS INTEGER) AS shrcd,
               CASE s_nationkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 31 WHEN 4 THEN 32 WHEN 5 THEN 33 WHEN 6 THEN 4 END AS exchcd,
               CAST(CASE WHEN s_suppkey % 13 <> 0 THEN (s_suppkey * 97 + rec * 1500) % 10000 END AS INTEGER) AS siccd,
               CASE rec WHEN 1 THEN DATE '1995-01-01' ELSE cut + CASE WHEN s_suppkey % 10 = 7 THEN 40 ELSE 1 END END AS namedt,
               CASE rec WHEN 1 THEN cut ELSE DATE '2001-12-31' END AS nameendt
        FROM (SELECT *, DATE '1997-01-01' + CAST(s_suppkey * 97 % 1400 AS INTEGER) AS cut, unnest([1, 2]) AS rec FROM supplier)""",
    "t_delistings": """
        SELECT CAST(s_suppkey AS INTEGER) AS permno, DATE '2000-01-01' + CAST(s_suppkey * 37 % 600 AS INTEGER) AS dlstdt,
               CASE WHEN s_suppkey % 10 <> 0 THEN -CAST(s_suppkey % 7 + 10 AS DOUBLE) / 100 END AS dlret,
               CASE (s_suppkey // 10) % 6 WHEN 0 THEN 100 WHEN 1 THEN 500 WHEN 2 THEN 520 WHEN 3 THEN 560 WHEN 4 THEN 200 ELSE 574 END AS dlstcd
        FROM supplier WHERE s_suppkey % 5 = 0""",
    "t_links": """
        SELECT CAST(s_suppkey AS INTEGER) AS lpermno, 'G' || CASE WHEN rec = 3 THEN s_suppkey + 1 ELSE s_suppkey END AS gvkey,
               CASE WHEN rec = 3 THEN 'LX' WHEN s_suppkey % 2 = 0 THEN 'LU' ELSE 'LC' END AS linktype,
               CASE WHEN s_suppkey % 17 = 16 THEN 'N' WHEN s_suppkey % 3 = 0 THEN 'C' ELSE 'P' END AS linkprim,
               CASE WHEN s_suppkey % 19 = 18 THEN 0 ELSE 1 END AS usedflag,
               CASE rec WHEN 2 THEN cut + 1 ELSE DATE '1994-01-01' END AS linkdt, CASE rec WHEN 1 THEN cut END AS linkenddt
        FROM (SELECT *, DATE '1998-01-01' + CAST(s_suppkey * 53 % 700 AS INTEGER) AS cut, unnest([1, 2, 3]) AS rec FROM supplier)""",
    "t_prices": f"""
        SELECT symbol, date, vol / volume AS adjusted, close, volume FROM (
          SELECT 'N' || s_nationkey AS symbol, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS volume,
                 {_units('l_extendedprice', 100)} AS vol, max(l_extendedprice) AS close
          FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2)""",
    "t_factors_raw": f"""
        SELECT strftime(month, '%Y%m') AS date, CAST(min(mi) % 5 AS DOUBLE) * 0.02 + 0.1 AS "RF",
               round(avg(r) * 100, 6) AS "Mkt-RF", {_spread("permno % 2 = 0")} AS "SMB", {_spread("permno % 3 = 0")} AS "HML",
               {_spread("permno % 5 = 0")} AS "RMW", {_spread("permno % 7 = 0")} AS "CMA"
        FROM t_monthly_trade GROUP BY month""",
    "t_factors_daily_raw": f"""
        SELECT strftime(date, '%Y%m%d') AS date, CAST(min(mi) % 5 AS DOUBLE) * 0.001 + 0.005 AS "RF",
               round(avg(r) * 100, 6) AS "Mkt-RF", {_spread("permno % 2 = 0")} AS "SMB", {_spread("permno % 3 = 0")} AS "HML"
        FROM t_daily_trade GROUP BY t_daily_trade.date""",
    "t_q_factors_raw": f"""
        SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, "R_F", "R_MKT", "R_ME", "R_IA" FROM (
          SELECT month AS m, CAST(min(mi) % 5 AS DOUBLE) * 0.02 + 0.1 AS "R_F", round(avg(r) * 100, 6) AS "R_MKT",
                 {_spread("permno % 2 = 0")} AS "R_ME", {_spread("permno % 3 = 0")} AS "R_IA"
          FROM t_monthly_trade GROUP BY 1)""",
    "t_industries_raw": "SELECT strftime(month, '%Y%m') AS date, "
    + ", ".join(f'round(avg(CASE WHEN permno % 10 = {i} THEN r END) * 100, 6) AS "{c}"' for i, c in enumerate(INDUSTRY_COLUMNS))
    + " FROM t_monthly_trade GROUP BY month",
    "t_macro_raw": """
        SELECT strftime(month, '%Y%m') AS yyyymm, vol / 1000 AS "Index", disc / 1000 AS "D12", disc / 500 AS "E12",
               CAST(mi % 5 AS DOUBLE) * 0.0002 + 0.001 AS "Rfree", CASE WHEN mi % 29 = 0 THEN 'n/a' ELSE CAST(k AS VARCHAR) END AS svar,
               qty / vol AS "b/m", top / vol AS ntis, CAST(mi % 7 AS DOUBLE) / 100 AS tbl, CAST(mi % 9 AS DOUBLE) / 100 AS lty,
               CAST(mi % 4 AS DOUBLE) / 100 AS ltr, CAST(mi % 11 AS DOUBLE) / 100 AS "BAA", CAST(mi % 6 AS DOUBLE) / 100 AS "AAA",
               CASE WHEN mi % 31 <> 0 THEN disc / vol END AS infl
        FROM (SELECT month, mi, round(sum(vol), 2) AS vol, sum(qty) AS qty, round(sum(disc), 4) AS disc, max(top) AS top, count(*) AS k
              FROM t_monthly_trade GROUP BY month, mi)""",
    "t_cpi_raw": "SELECT month AS date, round(sum(vol), 2) / sum(qty) AS price FROM t_monthly_trade GROUP BY month",
    "t_funda": f"""
        SELECT gvkey, datadate, CASE WHEN k % 19 = 0 THEN 'FS' ELSE 'INDL' END AS indfmt,
               CASE WHEN k % 43 = 0 THEN 'SUMM' ELSE 'STD' END AS datafmt, 'C' AS consol,
               CASE WHEN k % 41 = 0 THEN 0.0 ELSE x END AS "at", x * 0.55 AS lt,
               CASE WHEN k % 23 = 0 THEN -x WHEN k % 5 <> 0 THEN x * 0.4 END AS seq,
               CASE WHEN k % 7 <> 0 THEN x * 0.35 END AS ceq, CASE WHEN k % 3 <> 0 THEN x * 0.05 END AS pstk,
               CASE WHEN k % 4 <> 0 THEN x * 0.02 END AS txditc, CASE WHEN k % 11 <> 0 THEN x * 0.01 END AS txdb,
               CASE WHEN k % 2 <> 0 THEN x * 0.005 END AS itcb, CASE WHEN k % 3 <> 1 THEN x * 0.04 END AS pstkrv,
               CASE WHEN k % 5 <> 2 THEN x * 0.03 END AS pstkl,
               x * 0.1 + CAST(k % 17 AS DOUBLE) * 10 AS capx, x * 0.08 + CAST(k % 13 AS DOUBLE) * 10 AS oancf,
               x * 0.9 AS sale, CASE WHEN k % 6 <> 0 THEN x * 0.5 END AS cogs, CASE WHEN k % 8 <> 0 THEN x * 0.02 END AS xint,
               CASE WHEN k % 9 <> 0 THEN x * 0.1 END AS xsga
        FROM (SELECT 'G' || (o_custkey // 15) AS gvkey, last_day(CAST(o_orderdate AS DATE)) AS datadate,
                     {_units('o_totalprice', 100)} / 1000 AS x, min(o_orderkey) AS k
              FROM orders GROUP BY 1, 2)""",
    "t_issues": f"""
        SELECT 'B' || p_partkey AS complete_cusip, {_OFFERED} AS offering_date, {_OFFERED} + 365 * (2 + p_size % 20) AS maturity,
               {_OFFERED} AS dated_date, {_OFFERED} + 30 AS last_interest_date, p_retailprice * 100 AS offering_amt,
               p_retailprice / 200 AS coupon,
               CASE p_partkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '4' WHEN 4 THEN '12' ELSE '13' END AS interest_frequency,
               CAST(p_partkey AS INTEGER) AS issue_id, CAST(p_partkey // 20 AS INTEGER) AS issuer_id,
               CASE WHEN p_partkey % 29 = 0 THEN 'JUN' ELSE 'SEN' END AS security_level,
               CASE p_partkey % 7 WHEN 0 THEN 'CDEB' WHEN 1 THEN 'CMTN' WHEN 2 THEN 'CMTZ' WHEN 3 THEN 'CZ' WHEN 4 THEN 'USBN' WHEN 5 THEN 'CDEB' ELSE 'CCOV' END AS bond_type,
               CASE WHEN p_partkey % 37 = 0 THEN 'Y' WHEN p_partkey % 41 = 0 THEN NULL ELSE 'N' END AS pay_in_kind,
               CASE p_partkey % 8 WHEN 0 THEN 'V' WHEN 1 THEN 'Z' ELSE 'F' END AS coupon_type,
               {", ".join(_flag(n, m) for n, m in _FLAGS.items())},
               {_rare("security_pledge", 33)}, {_rare("fix_frequency", 39)}, {_rare("exchange", 45)},
               CASE WHEN p_partkey % 51 = 1 THEN DATE '2010-01-01' END AS filing_date,
               CASE WHEN p_partkey % 57 = 1 THEN DATE '2010-01-01' END AS settlement
        FROM part""",
    "t_issuers": """
        SELECT CAST(s_suppkey AS INTEGER) AS issuer_id, CAST(s_suppkey * 97 % 10000 AS VARCHAR) AS sic_code,
               CASE WHEN s_suppkey % 10 = 9 THEN 'CAN' ELSE 'USA' END AS country_domicile FROM supplier""",
    "t_trades": """
        SELECT 'B' || (l_partkey // 16 * 16) AS cusip_id, CAST(l_linenumber AS VARCHAR) AS msg_seq_nb,
               CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber - 1 AS VARCHAR) END AS orig_msg_seq_nb,
               1000.0::DOUBLE * (1 + CAST(l_quantity AS INTEGER) % 2) AS entrd_vol_qt, 98.0::DOUBLE + l_orderkey % 2 AS rptd_pr,
               l_tax * 100 AS yld_pt, CASE WHEN l_suppkey // 4 % 2 = 0 THEN 'B' ELSE 'S' END AS rpt_side_cd,
               CASE WHEN l_orderkey % 7 = 0 THEN 'E' WHEN l_orderkey % 3 = 0 THEN 'D' ELSE 'C' END AS cntra_mp_id,
               exec_day AS trd_exctn_dt, CASE WHEN l_suppkey % 2 = 0 THEN '09:30:00' ELSE '14:15:00' END AS trd_exctn_tm,
               reported AS trd_rpt_dt, CASE WHEN l_orderkey % 2 = 0 THEN '15:00:00' ELSE '16:30:00' END AS trd_rpt_tm,
               exec_day - 1 AS pr_trd_dt,
               CASE WHEN l_returnflag = 'A' OR l_returnflag || l_linestatus = 'NF' THEN 'T'
                    WHEN l_returnflag = 'N' THEN CASE WHEN l_orderkey % 2 = 0 THEN 'C' ELSE 'X' END
                    WHEN reported >= DATE '2012-02-06' THEN CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'Y' END
                    ELSE 'W' END AS trc_st,
               CASE WHEN l_partkey % 5 = 0 THEN 'R' WHEN l_partkey % 11 = 1 THEN 'A' WHEN l_partkey % 13 = 1 THEN 'D' WHEN l_partkey % 17 = 1 THEN '' END AS asof_cd,
               CASE WHEN l_partkey % 23 = 1 THEN 'Y' ELSE 'N' END AS wis_fl,
               CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_orderkey % 9 AS VARCHAR) END AS days_to_sttl_ct,
               CASE WHEN l_partkey % 3 <> 0 THEN exec_day + CAST(l_partkey % 9 AS INTEGER) END AS stlmnt_dt,
               CASE WHEN l_suppkey % 31 = 1 THEN 'S' WHEN l_suppkey % 2 = 0 THEN '' END AS spcl_trd_fl
        FROM (SELECT *, exec_day + CAST(l_orderkey % 3 AS INTEGER) AS reported FROM (
                SELECT *, DATE '2010-01-04' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) // 90 * 45 AS INTEGER) AS exec_day
                FROM lineitem))""",
    # -- panels built by the library ---------------------------------------------------------------------------
    "t_ff3": f"""
        SELECT * FROM (SELECT CAST(strptime(date || '01', '%Y%m%d') AS DATE) AS month, "RF" / 100 AS rf, "Mkt-RF" / 100 AS mkt_excess,
                              "SMB" / 100 AS smb, "HML" / 100 AS hml FROM t_factors_raw)
        WHERE month BETWEEN DATE '{START}' AND DATE '{END}'""",
    "t_ff3_daily": f"""
        SELECT * FROM (SELECT CAST(strptime(date, '%Y%m%d') AS DATE) AS date, "RF" / 100 AS rf, "Mkt-RF" / 100 AS mkt_excess,
                              "SMB" / 100 AS smb, "HML" / 100 AS hml FROM t_factors_daily_raw)
        WHERE date BETWEEN DATE '{START}' AND DATE '{END}'""",
    "t_cpi": f"SELECT {_MONTH.format('date')} AS month, price / (SELECT arg_max(price, date) FROM t_cpi_raw) AS cpi FROM t_cpi_raw",
    "t_valid": f"""
        SELECT m.permno, m.date, {_MONTH.format("m.date")} AS month, m.ret, m.shrout, m.altprc, n.exchcd, n.siccd
        FROM t_msf m JOIN t_names n ON m.permno = n.permno AND m.date BETWEEN n.namedt AND n.nameendt
        WHERE n.shrcd IN (10, 11)""",
    "t_sized": f"""
        SELECT v.*, d.dlret, d.dlstcd, CASE WHEN abs(shrout * 1000 * altprc) / 1e6 <> 0 THEN abs(shrout * 1000 * altprc) / 1e6 END AS mktcap
        FROM t_valid v LEFT JOIN t_delistings d ON v.permno = d.permno AND v.month = {_MONTH.format("d.dlstdt")}""",
    "t_classified": """
        SELECT s.*, l.mktcap AS mktcap_lag,
          CASE WHEN s.exchcd IN (1, 31) THEN 'NYSE' WHEN s.exchcd IN (2, 32) THEN 'AMEX' WHEN s.exchcd IN (3, 33) THEN 'NASDAQ' ELSE 'Other' END AS exchange,
          CASE WHEN s.siccd BETWEEN 1 AND 999 THEN 'Agriculture' WHEN s.siccd BETWEEN 1000 AND 1499 THEN 'Mining'
               WHEN s.siccd BETWEEN 1500 AND 1799 THEN 'Construction' WHEN s.siccd BETWEEN 2000 AND 3999 THEN 'Manufacturing'
               WHEN s.siccd BETWEEN 4000 AND 4899 THEN 'Transportation' WHEN s.siccd BETWEEN 4900 AND 4999 THEN 'Utilities'
               WHEN s.siccd BETWEEN 5000 AND 5199 THEN 'Wholesale' WHEN s.siccd BETWEEN 5200 AND 5999 THEN 'Retail'
               WHEN s.siccd BETWEEN 6000 AND 6799 THEN 'Finance' WHEN s.siccd BETWEEN 7000 AND 8999 THEN 'Services'
               WHEN s.siccd BETWEEN 9000 AND 9999 THEN 'Public' ELSE 'Missing' END AS industry,
          CASE WHEN s.dlstcd IS NULL THEN s.ret WHEN s.dlret IS NOT NULL THEN s.dlret
               WHEN s.dlstcd IN (500, 520, 580, 584) OR s.dlstcd BETWEEN 551 AND 574 THEN -0.30
               WHEN s.dlstcd = 100 THEN s.ret ELSE -1.0 END AS ret_adj
        FROM t_sized s LEFT JOIN t_sized l ON s.permno = l.permno AND s.month = CAST(l.month + INTERVAL 1 MONTH AS DATE)""",
    "t_excess": """
        SELECT c.*, CASE WHEN c.ret_adj - f.rf IS NOT NULL THEN greatest(c.ret_adj - f.rf, -1) END AS ret_excess
        FROM t_classified c LEFT JOIN t_ff3 f ON c.month = f.month""",
    "t_panel": """
        SELECT permno, date, month, ret, shrout, altprc, exchcd, siccd, mktcap, mktcap_lag, exchange, industry, ret_excess
        FROM t_excess WHERE ret_excess IS NOT NULL AND mktcap IS NOT NULL AND mktcap_lag IS NOT NULL""",
    "t_valid_links": f"""
        SELECT lpermno AS permno, gvkey, linkdt, coalesce(linkenddt, DATE '{AS_OF}') AS linkenddt FROM t_links
        WHERE linktype IN ('LU', 'LC') AND linkprim IN ('P', 'C') AND usedflag = 1 AND gvkey IS NOT NULL""",
    "t_linked": """
        SELECT p.*, k.gvkey FROM t_panel p LEFT JOIN t_valid_links k ON p.permno = k.permno AND p.date BETWEEN k.linkdt AND k.linkenddt""",
    "t_daily": f"""
        SELECT e.permno, e.date, {_MONTH.format("e.date")} AS month, e.ret,
               CASE WHEN e.ret - f.rf IS NOT NULL THEN greatest(e.ret - f.rf, -1) END AS ret_excess
        FROM (SELECT coalesce(s.permno, d.permno) AS permno, coalesce(s.date, d.dlstdt) AS date, coalesce(d.dlret, s.ret) AS ret
              FROM (SELECT * FROM t_dsf WHERE ret IS NOT NULL) s
              FULL JOIN (SELECT * FROM t_delistings WHERE dlret IS NOT NULL) d ON s.permno = d.permno AND s.date = d.dlstdt) e
        LEFT JOIN (SELECT permno, dlstdt FROM t_delistings WHERE dlret IS NOT NULL) x ON e.permno = x.permno
        LEFT JOIN t_ff3_daily f ON e.date = f.date
        WHERE e.date <= coalesce(x.dlstdt, DATE '{END}')""",
    "t_equity": """
        SELECT *, (sale - coalesce(cogs, 0) - coalesce(xsga, 0) - coalesce(xint, 0)) / be AS op FROM (
          SELECT *, CASE WHEN v > 0 THEN v END AS be FROM (
            SELECT *, coalesce(seq, ceq + pstk, "at" - lt) + coalesce(txditc, txdb + itcb, 0) - coalesce(pstkrv, pstkl, pstk, 0) AS v
            FROM t_funda WHERE indfmt = 'INDL' AND datafmt = 'STD' AND consol = 'C'))""",
    "t_yearly": """
        SELECT * FROM (SELECT *, CAST(year(datadate) AS INTEGER) AS year,
                              max(datadate) OVER (PARTITION BY gvkey, year(datadate)) AS last_filing FROM t_equity)
        WHERE datadate = last_filing""",
    "t_accounts": """
        SELECT a.*, b."at" AS at_lag, CASE WHEN b."at" > 0 THEN a."at" / b."at" - 1 END AS inv
        FROM t_yearly a LEFT JOIN t_yearly b ON a.gvkey = b.gvkey AND a.year = b.year + 1""",
    "t_beta_monthly": """
        SELECT permno, month, beta_monthly, n_obs FROM (
          SELECT p.permno, p.month, CASE WHEN regr_sxx(p.ret_excess, f.mkt_excess) OVER w > 0 THEN regr_slope(p.ret_excess, f.mkt_excess) OVER w END AS beta_monthly,
                 CAST(regr_count(p.ret_excess, f.mkt_excess) OVER w AS BIGINT) AS n_obs
          FROM t_panel p LEFT JOIN t_ff3 f ON p.month = f.month
          WINDOW w AS (PARTITION BY p.permno ORDER BY p.month RANGE BETWEEN INTERVAL 59 MONTH PRECEDING AND CURRENT ROW))
        WHERE n_obs >= 48 AND beta_monthly IS NOT NULL""",
    "t_beta_daily": f"""
        SELECT permno, month, beta_daily, n_obs FROM (
          SELECT m.permno, m.month, CASE WHEN regr_sxx(d.ret_excess, f.mkt_excess) > 0 THEN regr_slope(d.ret_excess, f.mkt_excess) END AS beta_daily,
                 CAST(regr_count(d.ret_excess, f.mkt_excess) AS BIGINT) AS n_obs
          FROM (SELECT DISTINCT permno, month FROM t_daily) m
          JOIN t_daily d ON d.permno = m.permno AND d.month BETWEEN m.month - INTERVAL 2 MONTH AND m.month
          LEFT JOIN t_ff3_daily f ON d.date = f.date
          GROUP BY 1, 2)
        WHERE n_obs >= {DAILY_MIN_OBS} AND beta_daily IS NOT NULL""",
    "t_beta": """
        SELECT coalesce(m.permno, d.permno) AS permno, coalesce(m.month, d.month) AS month, m.beta_monthly, d.beta_daily
        FROM t_beta_monthly m FULL JOIN t_beta_daily d ON m.permno = d.permno AND m.month = d.month""",
    "t_book": f"""
        SELECT p.permno, a.gvkey, CAST(p.month + INTERVAL 6 MONTH AS DATE) AS sorting_date,
               CAST(p.month + INTERVAL 6 MONTH AS DATE) AS comp_date, a.be / p.mktcap AS bm
        FROM t_accounts a JOIN t_linked p ON a.gvkey = p.gvkey AND {_MONTH.format("a.datadate")} = p.month WHERE a.be IS NOT NULL""",
    "t_sorting": """
        SELECT permno, gvkey, month, ret_excess, mktcap_lag, me, bm, exchange FROM (
          SELECT p.permno, p.gvkey, p.month, p.ret_excess, p.mktcap_lag, m.mktcap AS me, p.exchange,
                 last_value(b.bm IGNORE NULLS) OVER w AS bm, last_value(b.comp_date IGNORE NULLS) OVER w AS comp_date
          FROM t_linked p
          LEFT JOIN t_book b ON p.permno = b.permno AND p.gvkey = b.gvkey AND p.month = b.sorting_date
          LEFT JOIN t_linked m ON p.permno = m.permno AND p.month = CAST(m.month + INTERVAL 1 MONTH AS DATE)
          WHERE p.gvkey IS NOT NULL
          WINDOW w AS (PARTITION BY p.permno, p.gvkey ORDER BY p.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        WHERE comp_date > month - INTERVAL 12 MONTH AND me IS NOT NULL AND bm IS NOT NULL""",
}


def _needed(text: str) -> list[str]:
    """Names of the table expressions that ``text`` uses, dependencies first."""
    out: list[str] = []

    def visit(body: str) -> None:
        for name in CTES:
            if name not in out and re.search(rf"\b{name}\b", body):
                visit(CTES[name])
                out.append(name)

    visit(text)
    return out


def build_sql(body: str, rounded: str = "", digits: int = 6) -> str:
    """Complete SQL text: the needed table expressions, the query, and rounding of the listed columns."""
    needed = _needed(body)
    parts = [f"{name} AS ({CTES[name].strip()})" for name in needed]
    parts.append(f"result AS ({body.strip()})")
    replaced = ", ".join(f'round("{c}", {digits}) + 0.0 AS "{c}"' for c in rounded.split())
    select = f"SELECT * REPLACE ({replaced}) FROM result" if replaced else "SELECT * FROM result"
    return "WITH " + ",\n".join(parts) + "\n" + select
