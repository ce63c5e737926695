"""Single relational operators: sources, filters, joins, aggregates, windows, reshaping, scalar functions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions import buckets, dates, scalars
from panelforge.operators import aggregates, asof, blocks, joins, quantiles, reshape, sliding, windows
from panelforge.plans import betas, size_sorts, trades, univariate
from panelforge.sources import factors as factor_tables
from panelforge.sources import published, readers, schemas
from panelforge.storage import materialize, materialize_bucketed, stage_path
from panelforge.workload.registry import query
from panelforge.workload.sorting import EXAMPLES_SQL, SPLIT, VALUE_WEIGHTED, assigned_sql, breaks_sql, examples, grid_sql
from panelforge.workload.tables import END, START

ORDERS = "SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders"


def _orders(t):
    return t.driver("orders").withColumn("d", F.to_date("o_orderdate"))


# -- sources and sinks -----------------------------------------------------------------------------------------------


@query("scan_parquet", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey >= 10")
def scan_parquet(t):
    data_dir = stage_path(t.spark, "data")
    readers.write_parquet(t.driver("customer"), "customer", "raw", data_dir)
    table = readers.scan_parquet(t.spark, "customer", "raw", data_dir, schemas.DRIVER["customer"])
    return table.where("c_nationkey >= 10").select("c_custkey", "c_mktsegment")


def _through_catalog(t, df, name: str):
    """``df`` written as a catalogue table of its own and scanned by name; the entry goes, the files stay for the result."""
    name = f"{name}_{uuid.uuid4().hex}"
    readers.write_table(df, name, stage_path(t.spark, name))
    out = readers.scan_table(t.spark, name)
    t.spark.sql(f"DROP TABLE {name}")
    return out


@query("scan_table", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def scan_table(t):
    return _through_catalog(t, t.driver("customer"), "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("scan_query", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1")
def scan_query(t):
    text = "SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, count(*) AS n FROM {orders} GROUP BY 1"
    return readers.scan_query(t.spark, text, ["day"], orders=t.driver("orders"))


@query("scan_csv", "SELECT year, month, \"R_F\" AS r_f, \"R_MKT\" AS r_mkt FROM t_q_factors_raw", "r_f r_mkt")
def scan_csv(t):
    path = stage_path(t.spark, "csv")
    t.q_factors_raw.write.csv(path, header=True)
    out = readers.scan_csv(t.spark, path, "year int, month int, R_F double, R_MKT double, R_ME double, R_IA double")
    return out.select("year", "month", F.col("R_F").alias("r_f"), F.col("R_MKT").alias("r_mkt"))


PUBLISHED = ("Mkt-RF", "SMB", "HML", "RF")


def _published_file(t) -> str:
    """A factor file as it is published: text, the monthly table, a title, the annual table, text."""
    raw = t.factors_raw.select("date", *PUBLISHED)
    header = "," + ",".join(PUBLISHED)
    fields = [F.format_string("%12.6f", F.coalesce(F.col(f"`{c}`"), F.lit(-99.99))) for c in PUBLISHED]
    monthly = raw.select(F.lit(10).alias("part"), F.col("date").cast("int").alias("at"), F.concat_ws(",", "date", *fields).alias("value"))
    yearly = raw.groupBy(F.substring("date", 1, 4).alias("date")).agg(*[F.sum(f"`{c}`").alias(c) for c in PUBLISHED])
    annual = yearly.select(F.lit(30).alias("part"), F.col("date").cast("int").alias("at"), F.concat_ws(",", F.concat(F.lit("  "), "date"), *fields).alias("value"))
    text = [
        (0, 0, "This file was created from monthly returns, in percent, of 1995 and later years"), (0, 1, "Missing data are indicated by -99.99 or -999."),
        (0, 2, ""), (0, 3, header), (20, 0, ""), (20, 1, " Annual Factors: January-December "), (20, 2, header), (40, 0, ""), (40, 1, "Copyright, the authors"),
    ]
    lines = t.spark.createDataFrame(text, "part int, at int, value string").unionByName(monthly).unionByName(annual)
    path = stage_path(t.spark, "published")
    lines.repartition(1).sortWithinPartitions("part", "at").select("value").write.text(path)
    return path


@query("scan_factor_csv", "SELECT * FROM t_ff3", "rf mkt_excess smb hml", 8)
def scan_factor_csv(t):
    rows, _ = published.published_table(t.spark, _published_file(t), PUBLISHED)
    return factor_tables.monthly_factors(rows, START, END)


@query(
    "scan_factor_csv_annual",
    """SELECT CAST(date AS INTEGER) // 100 AS year, sum("RF") AS rf, sum("Mkt-RF") AS mkt_excess, sum("SMB") AS smb, sum("HML") AS hml FROM t_factors_raw GROUP BY 1""",
    "rf mkt_excess smb hml", 4,
)
def scan_factor_csv_annual(t):
    """The second table of the same file."""
    rows, _ = published.published_table(t.spark, _published_file(t), PUBLISHED, table=2)
    return rows.select(F.col("date").cast("int").alias("year"), *[F.col(f"`{old}`").alias(new) for old, new in factor_tables.THREE_FACTORS.items()])


@query("scan_macro_sheet", 'SELECT yyyymm, "Index" AS level, TRY_CAST(svar AS DOUBLE) AS svar FROM t_macro_raw', "level")
def scan_macro_sheet(t):
    path = stage_path(t.spark, "macro")
    t.macro_raw.write.csv(path, header=True)
    sheet = readers.scan_csv(t.spark, path, schemas.MACRO)
    return sheet.select("yyyymm", F.col("Index").alias("level"), scalars.text_to_number(F.col("svar")).alias("svar"))


@query("inline_table", f"SELECT p.permno, company, count(*) AS n FROM t_panel p JOIN {EXAMPLES_SQL} ON p.permno = e.permno GROUP BY ALL")
def inline_table(t):
    return t.panel.join(examples(t), "permno").groupBy("permno", "company").agg(F.count(F.lit(1)).alias("n"))


@query("write_parquet", "SELECT permno, date, ret FROM t_dsf", "ret", 9)
def write_parquet(t):
    data_dir = stage_path(t.spark, "data")
    readers.write_parquet(t.dsf, "dsf", "stocks", data_dir)
    return readers.scan_parquet(t.spark, "dsf", "stocks", data_dir, schemas.DAILY_STOCK)


@query(
    "write_table_bucketed",
    "SELECT p.permno, p.month, lag(p.mktcap) OVER (PARTITION BY p.permno ORDER BY p.month) AS prev, b.beta_monthly FROM t_panel p LEFT JOIN t_beta_monthly b ON p.permno = b.permno AND p.month = b.month",
    "prev beta_monthly",
)
def write_table_bucketed(t):
    """A stored panel and stored betas, both in buckets of securities."""
    panel = materialize_bucketed(t.panel.select("permno", "month", "mktcap"), ["permno"], 8, ["permno", "month"], "panel")
    beta = materialize_bucketed(t.beta_monthly.select("permno", "month", "beta_monthly"), ["permno"], 8, ["permno", "month"], "beta")
    lagged = panel.select("permno", "month", windows.lag_row("mktcap", ["permno"], "month").alias("prev"))
    return lagged.join(beta, ["permno", "month"], "left")


@query("write_table", "SELECT * FROM t_delistings", "dlret")
def write_table(t):
    return _through_catalog(t, t.delistings, "delistings")


GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("convert_catalog", " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM {name}" for name in GIVEN))
def convert_catalog(t):
    database = f"panel_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{stage_path(t.spark, database)}'")
    for name in GIVEN:
        t.spark.catalog.createTable(f"{database}.{name}", f"{t.sf_dir}/{name}.parquet", "parquet")
    paths = readers.convert_catalog(t.spark, database, stage_path(t.spark, "data"))
    t.spark.sql(f"DROP DATABASE {database} CASCADE")
    counts = [t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, path in paths.items()]
    return reduce(DataFrame.unionAll, counts)


@query("materialize", "SELECT exchange, count(*) AS n FROM t_panel GROUP BY 1")
def materialized(t):
    return materialize(t.panel.select("permno", "exchange")).groupBy("exchange").agg(F.count(F.lit(1)).alias("n"))


# -- projections and filters ------------------------------------------------------------------------------------------


@query("project", "SELECT l_orderkey AS id, l_quantity AS qty FROM lineitem")
def project(t):
    return t.driver("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("qty"))


@query("derive", "SELECT o_orderkey, o_totalprice / 1000 AS size, ln(o_totalprice / 1000) AS log_size FROM orders", "log_size")
def derive(t):
    sized = t.driver("orders").withColumn("size", F.col("o_totalprice") / 1000)
    return sized.withColumn("log_size", F.ln("size")).select("o_orderkey", "size", "log_size")


@query("derive_only", "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_discount / 100 AS rate FROM lineitem", "rate", 8)
def derive_only(t):
    return t.driver("lineitem").select(dates.month_of("l_shipdate").alias("month"), (F.col("l_discount") / 100).alias("rate"))


@query("rename_with_fn", "SELECT n_nationkey AS nationkey, n_name AS name, n_regionkey AS regionkey FROM nation")
def rename_with_fn(t):
    return reshape.rename_all(t.driver("nation"), lambda c: c.removeprefix("n_").lower())


@query("map_columns", 'SELECT date, "RF" / 100 AS "RF", "SMB" / 100 AS "SMB" FROM t_factors_raw', "RF SMB", 9)
def map_columns(t):
    raw = t.factors_raw.select("date", "RF", "SMB")
    return reshape.map_columns(raw, reshape.numeric_columns(raw), lambda c: c / 100)


@query("filter_range", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate <= DATE '1997-06-30'")
def filter_range(t):
    return factor_tables.between_dates(_orders(t), "o_orderdate", "1996-01-01", "1997-06-30").select("o_orderkey", "d")


@query("filter_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def filter_in(t):
    return t.driver("orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", "o_orderpriority")


@query(
    "filter_conjunction",
    "SELECT complete_cusip FROM t_issues WHERE security_level = 'SEN' AND slob = 'N' AND pay_in_kind <> 'Y' AND exchange IS NULL AND coupon_type IN ('F', 'Z')",
)
def filter_conjunction(t):
    wanted = scalars.all_of(
        F.col("security_level") == "SEN", F.col("slob") == "N", F.col("pay_in_kind") != "Y", F.col("exchange").isNull(), F.col("coupon_type").isin("F", "Z")
    )
    return t.issues.where(wanted).select("complete_cusip")


@query("filter_null", "SELECT permno, date FROM t_msf WHERE ret IS NOT NULL AND shrout IS NOT NULL")
def filter_null(t):
    return t.msf.dropna(subset=["ret", "shrout"]).select("permno", "date")


@query("filter_null_or", "SELECT cusip_id, msg_seq_nb, days_to_sttl_ct FROM t_trades WHERE days_to_sttl_ct IS NULL OR CAST(days_to_sttl_ct AS DOUBLE) <= 7")
def filter_null_or(t):
    days = F.col("days_to_sttl_ct")
    return t.trades.where(scalars.null_or(days, days.cast("double") <= 7)).select("cusip_id", "msg_seq_nb", "days_to_sttl_ct")


@query(
    "filter_group_extreme",
    f"SELECT o_custkey, o_orderkey, d FROM (SELECT *, max(d) OVER (PARTITION BY o_custkey) AS last FROM ({ORDERS})) WHERE d = last",
)
def filter_group_extreme(t):
    return aggregates.keep_group_maximum(_orders(t).select("o_custkey", "o_orderkey", "d"), "d", ["o_custkey"])


@query("filter_global_extreme", f"SELECT o_orderkey, d FROM ({ORDERS}) WHERE d = (SELECT max(d) FROM ({ORDERS}))")
def filter_global_extreme(t):
    return aggregates.keep_global_maximum(_orders(t).select("o_orderkey", "d"), "d")


@query(
    "filter_full_history",
    """SELECT permno, month FROM t_monthly_trade WHERE permno IN (SELECT permno FROM t_monthly_trade GROUP BY permno
       HAVING count(*) = (SELECT max(n) FROM (SELECT count(*) AS n FROM t_monthly_trade GROUP BY permno)))""",
)
def filter_full_history(t):
    return aggregates.keep_full_history(t.monthly_trade.select("permno", "month"), "permno")


@query("filter_min_obs", "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12)")
def filter_min_obs(t):
    return aggregates.keep_min_rows(t.driver("orders").select("o_custkey", "o_orderkey"), "o_custkey", 12)


@query("distinct", "SELECT DISTINCT cusip_id FROM t_trades")
def distinct(t):
    return t.trades.select("cusip_id").distinct()


@query(
    "case_bins",
    "SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size BETWEEN 11 AND 30 THEN 'medium' ELSE 'large' END AS bin FROM part",
)
def case_bins(t):
    size = F.col("p_size")
    return t.driver("part").select("p_partkey", F.when(size.between(1, 10), "small").when(size.between(11, 30), "medium").otherwise("large").alias("bin"))


@query("case_two_way", "SELECT permno, date, CASE WHEN ret <= 0 THEN 'low' WHEN ret > 0 THEN 'high' END AS side FROM t_msf")
def case_two_way(t):
    return t.msf.select("permno", "date", F.when(F.col("ret") <= 0, "low").when(F.col("ret") > 0, "high").alias("side"))


@query(
    "column_argument",
    f"SELECT permno, month, portfolio FROM ({assigned_sql('SELECT *, abs(altprc) AS price FROM t_panel', 'price', 3, 'month', chr(39) + 'NYSE' + chr(39), 'portfolio')})",
)
def column_argument(t):
    priced = t.stored_panel("permno", "month", "exchange", "altprc").withColumn("price", F.abs("altprc"))
    return size_sorts.assign_portfolio(priced, "price", 3, ["month"], ("NYSE",)).select("permno", "month", "portfolio")


@query(
    "subsample_argument",
    """SELECT 'all' AS subsample, count(*) AS n FROM t_panel UNION ALL SELECT 'no finance', count(*) FROM t_panel WHERE industry <> 'Finance'
       UNION ALL SELECT 'before 1998-01-01', count(*) FROM t_panel WHERE month < DATE '1998-01-01'
       UNION ALL SELECT 'from 1998-01-01', count(*) FROM t_panel WHERE month >= DATE '1998-01-01'""",
)
def subsample_argument(t):
    samples = size_sorts.grid_subsamples("1998-01-01")
    counts = t.panel.agg(*[F.count(F.when(p, F.lit(1))).alias(name) for name, p in samples.items()])
    return reshape.to_long(counts, [], list(samples), "subsample", "n")


# -- joins -----------------------------------------------------------------------------------------------------------


@query("join_inner", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner(t):
    return joins.join_renamed(t.driver("customer"), t.driver("nation"), {"c_nationkey": "n_nationkey"}, "inner").select("c_custkey", "n_name")


@query("join_left", "SELECT d.permno, d.date, f.rf FROM t_dsf d LEFT JOIN t_ff3_daily f ON d.date = f.date", "rf", 9)
def join_left(t):
    return t.dsf.join(joins.period_lookup(t.ff3_daily.select("date", "rf"), "date"), "date", "left").select("permno", "date", "rf")


@query("join_left_renamed", "SELECT s.permno, s.date, d.dlret FROM t_dsf s LEFT JOIN t_delistings d ON s.permno = d.permno AND s.date = d.dlstdt", "dlret")
def join_left_renamed(t):
    return joins.join_renamed(t.dsf, t.delistings, {"permno": "permno", "date": "dlstdt"}).select("permno", "date", "dlret")


@query(
    "join_full",
    """SELECT coalesce(a.k, b.k) AS k, a.orders, b.parts FROM (SELECT o_custkey AS k, count(*) AS orders FROM orders GROUP BY 1) a
       FULL JOIN (SELECT p_partkey AS k, p_size AS parts FROM part) b ON a.k = b.k""",
)
def join_full(t):
    left = t.driver("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("orders"))
    return left.join(t.driver("part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("parts")), "k", "full")


@query("join_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def join_semi(t):
    return joins.keep_matched(t.driver("customer").select("c_custkey"), t.driver("orders").where("o_orderstatus = 'P'"), {"c_custkey": "o_custkey"})


_EIGHT = " AND ".join(f"a.{k} = b.{k}" for k in trades.MESSAGE_KEY)


@query("join_anti", f"SELECT a.cusip_id, a.msg_seq_nb FROM t_trades a WHERE trc_st = 'T' AND NOT EXISTS (SELECT 1 FROM t_trades b WHERE b.trc_st = 'C' AND {_EIGHT})")
def join_anti(t):
    kept = joins.drop_matched(t.trades.where("trc_st = 'T'"), t.trades.where("trc_st = 'C'"), {k: k for k in trades.MESSAGE_KEY})
    return kept.select("cusip_id", "msg_seq_nb")


@query(
    "join_anti_asym",
    """SELECT a.cusip_id, a.trd_exctn_dt, a.msg_seq_nb FROM t_trades a WHERE trc_st = 'T' AND NOT EXISTS (
         SELECT 1 FROM t_trades b WHERE b.trc_st = 'W' AND a.cusip_id = b.cusip_id AND a.trd_exctn_dt = b.trd_exctn_dt AND a.msg_seq_nb = b.orig_msg_seq_nb)""",
)
def join_anti_asym(t):
    keys = {"cusip_id": "cusip_id", "trd_exctn_dt": "trd_exctn_dt", "msg_seq_nb": "orig_msg_seq_nb"}
    return joins.drop_matched(t.trades.where("trc_st = 'T'"), t.trades.where("trc_st = 'W'"), keys).select("cusip_id", "trd_exctn_dt", "msg_seq_nb")


VALIDITY = f"SELECT o_custkey, d AS valid_from, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) - 1 AS valid_to FROM (SELECT DISTINCT o_custkey, d FROM ({ORDERS}))"


def _validity(t):
    """Order dates of a customer as consecutive validity records; distinct dates bound the window by the calendar."""
    days = _orders(t).select("o_custkey", "d").distinct()
    following = F.lead("d").over(Window.partitionBy("o_custkey").orderBy("d"))
    return days.select("o_custkey", F.col("d").alias("valid_from"), F.date_sub(following, 1).alias("valid_to"))


@query(
    "join_validity",
    f"""SELECT c.c_custkey, c.at, v.valid_from FROM (SELECT c_custkey, DATE '1995-06-01' + CAST(c_custkey * 31 % 2000 AS INTEGER) AS at FROM customer) c
        JOIN ({VALIDITY}) v ON c.c_custkey = v.o_custkey AND c.at BETWEEN v.valid_from AND coalesce(v.valid_to, DATE '2002-12-31')""",
)
def join_validity(t):
    looked_up = t.driver("customer").selectExpr("c_custkey", "date_add(DATE'1995-06-01', CAST(c_custkey * 31 % 2000 AS INT)) AS at")
    records = _validity(t).withColumnRenamed("o_custkey", "c_custkey")
    open_end = F.lit("2002-12-31").cast("date")
    return joins.join_validity(looked_up, records, "c_custkey", "at", "valid_from", "valid_to", open_end).select("c_custkey", "at", "valid_from")


@query(
    "join_validity_hot",
    f"""SELECT e.event_id, count(v.valid_from) AS n, max(v.valid_from) AS latest
        FROM (SELECT event_id, user_id % 100 AS k, DATE '1996-01-01' + CAST(event_id * event_id % 1500 // 3 AS INTEGER) AS at FROM events) e
        LEFT JOIN (SELECT o_custkey % 100 AS k, valid_from, valid_to FROM ({VALIDITY})) v ON e.k = v.k AND e.at BETWEEN v.valid_from AND coalesce(v.valid_to, DATE '1996-09-01') GROUP BY e.event_id""",
)
def join_validity_hot(t):
    """Every (key, year) taken for a hot one and cut into days and parts of days; rows without a match stay.

    Records of a key overlap, so they are condensed to disjoint periods first: an event meets one period, not all records of its key.
    """
    looked_up = t.driver("events").selectExpr("event_id", "user_id % 100 AS k", "date_add(DATE'1996-01-01', CAST(event_id * event_id % 1500 div 3 AS INT)) AS at")
    records = _validity(t).withColumn("k", F.col("o_custkey") % 100).drop("o_custkey")
    periods = joins.condense_validity(records, "k", "valid_from", "valid_to", F.lit("1996-09-01").cast("date"))
    out = joins.join_validity(looked_up, periods, "k", "at", "valid_from", "valid_to", how="left", cell_rows=3)
    return out.groupBy("event_id").agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n"), F.max("latest").alias("latest"))


@query("join_interval_bucket", f"SELECT permno, month, bucket FROM ({assigned_sql('SELECT * FROM t_panel', 'mktcap', 4, 'month, industry', chr(39) + 'NYSE' + chr(39) + ', ' + chr(39) + 'AMEX' + chr(39), 'bucket')})")
def join_interval_bucket(t):
    out = size_sorts.assign_portfolio(t.stored_panel("permno", "month", "exchange", "industry", "mktcap"), "mktcap", 4, ["month", "industry"], ("NYSE", "AMEX"), "bucket")
    return out.select("permno", "month", "bucket")


@query(
    "join_self_shift",
    """SELECT a.gvkey, a.year, a."at", b."at" AS at_lag, c."at" AS at_lead FROM t_yearly a
       LEFT JOIN t_yearly b ON a.gvkey = b.gvkey AND a.year = b.year + 1 LEFT JOIN t_yearly c ON a.gvkey = c.gvkey AND a.year = c.year - 1""",
)
def join_self_shift(t):
    yearly = t.accounts.select("gvkey", "year", "at")
    lagged = joins.join_shifted_year(yearly, ["gvkey"], "year", {"at": "at_lag"}, 1)
    lead = yearly.select("gvkey", (F.col("year") - 1).alias("year"), F.col("at").alias("at_lead"))
    return lagged.join(lead, ["gvkey", "year"], "left")


@query(
    "join_self_shift_month",
    """SELECT a.permno, a.month, b.vol AS vol_lag FROM t_monthly_trade a
       LEFT JOIN t_monthly_trade b ON a.permno = b.permno AND a.month = CAST(b.month + INTERVAL 3 MONTH AS DATE)""",
)
def join_self_shift_month(t):
    return joins.join_shifted_month(t.monthly_trade.select("permno", "month", "vol"), ["permno"], "month", {"vol": "vol_lag"}, 3).drop("vol")


@query(
    "join_cross",
    """SELECT complete_cusip, CAST(date AS DATE) AS date FROM t_issues,
         (SELECT unnest(generate_series(DATE '2014-01-01', DATE '2016-11-30', INTERVAL 3 MONTH)) AS date) g WHERE date BETWEEN offering_date AND maturity""",
)
def join_cross(t):
    grid = F.expr("sequence(DATE'2014-01-01', DATE'2016-11-30', INTERVAL 3 MONTH)")
    live = F.filter(grid, lambda d: d.between(F.col("offering_date"), F.col("maturity")))
    return t.issues.select("complete_cusip", F.explode(live).alias("date"))


FILED = "SELECT gvkey, CAST(date_trunc('month', datadate) AS DATE) AS filed, be FROM t_accounts WHERE be IS NOT NULL"
ASOF = f"""SELECT p.gvkey, p.month, a.be AS last_be FROM (SELECT DISTINCT gvkey, month FROM t_linked WHERE gvkey IS NOT NULL) p
    ASOF JOIN ({FILED}) a ON p.gvkey = a.gvkey AND p.month >= a.filed WHERE a.filed > p.month - INTERVAL 12 MONTH"""


@query("join_asof_stale", ASOF, "last_be", 9)
def join_asof_stale(t):
    """The latest filing at or before each month, whether or not the panel has the filing's month, not older than a year."""
    months = t.linked.where("gvkey IS NOT NULL").select("gvkey", "month").distinct()
    filed = t.accounts.where("be IS NOT NULL").select("gvkey", dates.month_of("datadate").alias("filed"), "be")
    fresh = F.col("filed") > dates.shift_months(F.col("month"), -12)
    return asof.join_asof(months, filed, ["gvkey"], "month", "filed", ["be"], fresh, "inner").select("gvkey", "month", F.col("be").alias("last_be"))


@query(
    "join_asof_blocks",
    """SELECT e.event_id, o.o_orderkey, o.d FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'O' ELSE 'F' END AS status, DATE '1995-01-01' + CAST(event_id * 7 % 2500 AS INTEGER) AS at FROM events) e
       ASOF LEFT JOIN (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS d, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) o ON e.status = o.o_orderstatus AND e.at >= o.d""",
)
def join_asof_blocks(t):
    """The plan for hot keys, forced: two keys, cut into blocks that carry their last row on."""
    asked = t.driver("events").selectExpr("event_id", "CASE WHEN event_id % 3 = 0 THEN 'O' ELSE 'F' END AS status", "date_add(DATE'1995-01-01', CAST(event_id * 7 % 2500 AS INT)) AS at")
    orders = _orders(t).select(F.col("o_orderstatus").alias("status"), "d", "o_orderkey")
    out = asof.join_asof(asked, orders, ["status"], "at", "d", ["o_orderkey"], max_group_rows=100, block_rows=300)
    return out.select("event_id", "o_orderkey", "d")


@query("join_m2m", "SELECT p.permno, p.date, k.gvkey, k.linktype FROM t_panel p JOIN t_links k ON p.permno = k.lpermno AND p.date BETWEEN k.linkdt AND coalesce(k.linkenddt, DATE '2001-12-31')")
def join_m2m(t):
    links = t.links.withColumnRenamed("lpermno", "permno")
    matched = joins.join_validity(t.panel.select("permno", "date"), links, "permno", "date", "linkdt", "linkenddt", F.lit(END).cast("date"))
    return matched.select("permno", "date", "gvkey", "linktype")


@query("join_inline", f"SELECT d.permno, company, d.date FROM t_dsf d JOIN {EXAMPLES_SQL} ON d.permno = e.permno")
def join_inline(t):
    return t.dsf.join(examples(t), "permno").select("permno", "company", "date")


@query("join_add_missing", "SELECT coalesce(s.permno, d.permno) AS permno, coalesce(s.date, d.dlstdt) AS date, s.ret, d.dlret FROM t_dsf s FULL JOIN t_delistings d ON s.permno = d.permno AND s.date = d.dlstdt", "ret dlret", 9)
def join_add_missing(t):
    exits = t.delistings.select("permno", F.col("dlstdt").alias("date"), "dlret")
    return joins.join_add_missing(t.dsf, exits, ["permno", "date"]).select("permno", "date", "ret", "dlret")


# -- aggregates --------------------------------------------------------------------------------------------------------

MOMENTS = "avg(value) AS daily_mean, stddev_samp(value) AS daily_sd, min(value) AS daily_min, max(value) AS daily_max"
SUMMARY = """avg(value) AS mean, stddev_samp(value) AS sd, min(value) AS min, quantile_cont(value, 0.05) AS q05,
    quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.95) AS q95, max(value) AS max, count(value) AS n"""
SUMMARY_COLUMNS = "mean sd min q05 q50 q95 max"


@query("agg_moments", f"SELECT event_type, {MOMENTS} FROM events GROUP BY 1", "daily_mean daily_sd daily_min daily_max")
def agg_moments(t):
    return t.driver("events").groupBy("event_type").agg(*aggregates.moments("value", "daily_{fn}"))


@query("agg_summary", f"SELECT event_type, {SUMMARY} FROM events GROUP BY 1", SUMMARY_COLUMNS)
def agg_summary(t):
    return aggregates.summarize(t.driver("events"), "value", ["event_type"])


@query("agg_summary_overall", f"SELECT event_type, {SUMMARY} FROM (SELECT unnest([event_type, 'Overall']) AS event_type, value FROM events) GROUP BY 1", SUMMARY_COLUMNS)
def agg_summary_overall(t):
    return aggregates.summarize_with_overall(t.driver("events"), "value", "event_type")


@query("agg_count", "SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2")
def agg_count(t):
    return t.driver("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("agg_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def agg_count_distinct(t):
    return t.driver("events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("agg_count_distinct_if", "SELECT event_type, count(DISTINCT CASE WHEN value > 20 THEN user_id END) / count(DISTINCT user_id) AS share FROM events GROUP BY 1", "share")
def agg_count_distinct_if(t):
    return t.driver("events").groupBy("event_type").agg(aggregates.distinct_share("user_id", F.col("value") > 20).alias("share"))


@query("agg_sum_if", "SELECT o_orderstatus, sum(CASE WHEN o_totalprice >= 250000 THEN o_totalprice / 1e6 END) AS large FROM orders GROUP BY 1", "large", 4)
def agg_sum_if(t):
    return t.driver("orders").groupBy("o_orderstatus").agg(F.sum(F.when(F.col("o_totalprice") >= 250000, F.col("o_totalprice") / 1e6)).alias("large"))


@query("agg_sum_expr", "SELECT l_returnflag, sum(l_extendedprice * (1 - l_discount) / 1e9) AS revenue FROM lineitem GROUP BY 1", "revenue")
def agg_sum_expr(t):
    return t.driver("lineitem").groupBy("l_returnflag").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1e9).alias("revenue"))


@query("agg_ratio", "SELECT l_linestatus, sum(l_extendedprice) / avg(l_quantity) / 1e6 AS ratio FROM lineitem GROUP BY 1", "ratio", 4)
def agg_ratio(t):
    return t.driver("lineitem").groupBy("l_linestatus").agg((F.sum("l_extendedprice") / F.avg("l_quantity") / 1e6).alias("ratio"))


@query(
    "agg_weighted_mean",
    "SELECT month, sum(ret * shrout) / nullif(sum(shrout), 0) AS ret FROM (SELECT *, CAST(date_trunc('month', date) AS DATE) AS month FROM t_msf WHERE ret IS NOT NULL AND shrout IS NOT NULL) GROUP BY 1",
    "ret", 9,
)
def agg_weighted_mean(t):
    return t.msf.groupBy(dates.month_of("date").alias("month")).agg(aggregates.weighted_mean("ret", "shrout").alias("ret"))


@query("agg_weighted_switch", f"SELECT 'size' AS weighting, exchange, {VALUE_WEIGHTED} AS ret FROM t_panel GROUP BY 2 UNION ALL SELECT 'equal', exchange, avg(ret_excess) FROM t_panel GROUP BY 2", "ret", 9)
def agg_weighted_switch(t):
    both = t.panel.groupBy("exchange").agg(
        aggregates.weighted_mean("ret_excess", "mktcap_lag").alias("size"), aggregates.weighted_mean("ret_excess", None).alias("equal")
    )
    return reshape.to_long(both, ["exchange"], ["size", "equal"], "weighting", "ret")


@query("agg_quantile", "SELECT event_type, quantile_cont(value, 0.25) AS q25 FROM events GROUP BY 1", "q25")
def agg_quantile(t):
    return quantiles.exact_quantiles(t.driver("events"), "value", [0.25], ["event_type"], "__q").select("event_type", F.col("__q")[0].alias("q25"))


@query(
    "agg_quantile_narrowed",
    "SELECT event_type, unnest([0.01, 0.5, 0.99]::DOUBLE[]) AS prob, unnest(quantile_cont(value, [0.01, 0.5, 0.99])) AS quantile FROM events GROUP BY 1",
    "quantile",
)
def agg_quantile_narrowed(t):
    """The plan for groups beyond one task's memory, forced on small groups."""
    values = t.driver("events").select("event_type", "value")
    return quantiles.quantile_rows(values, "value", [0.01, 0.5, 0.99], ["event_type"], max_group_rows=1000)


@query(
    "agg_quantile_array",
    "SELECT event_type, unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS prob, unnest(quantile_cont(value, [0.25, 0.5, 0.75])) AS quantile FROM events GROUP BY 1",
    "quantile",
)
def agg_quantile_array(t):
    return quantiles.quantile_rows(t.driver("events"), "value", [0.25, 0.5, 0.75], ["event_type"])


@query("agg_median", "SELECT c_mktsegment, median(c_acctbal) AS median FROM customer GROUP BY 1", "median", 3)
def agg_median(t):
    out = quantiles.exact_quantiles(t.driver("customer"), "c_acctbal", [0.5], ["c_mktsegment"], "__q")
    return out.select("c_mktsegment", F.col("__q")[0].alias("median"))


@query("agg_regr", "SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1", "slope")
def agg_regr(t):
    return t.driver("lineitem").groupBy("l_returnflag").agg(
        F.regr_slope("l_extendedprice", "l_quantity").alias("slope"), F.regr_count("l_extendedprice", "l_quantity").alias("n")
    )


@query("agg_product", "SELECT CAST(year(month) AS INTEGER) AS year, product(1 + mkt_excess) AS growth FROM t_ff3 GROUP BY 1", "growth", 9)
def agg_product(t):
    return t.ff3.groupBy(F.year("month").alias("year")).agg(F.product(1 + F.col("mkt_excess")).alias("growth"))


@query("agg_share_nonnull", "SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(ret) / count(*) AS share FROM t_dsf GROUP BY 1", "share")
def agg_share_nonnull(t):
    return t.dsf.groupBy(dates.month_of("date").alias("month")).agg(aggregates.share_known("ret").alias("share"))


@query("agg_last", "SELECT symbol, arg_max(adjusted, date) AS price FROM t_prices GROUP BY 1")
def agg_last(t):
    return t.prices.groupBy("symbol").agg(F.max_by("adjusted", "date").alias("price"))


@query("agg_extreme_diff", "SELECT symbol, arg_max(adjusted, date) - arg_min(adjusted, date) AS change FROM t_prices GROUP BY 1", "change")
def agg_extreme_diff(t):
    return t.prices.groupBy("symbol").agg((F.max_by("adjusted", "date") - F.min_by("adjusted", "date")).alias("change"))


@query(
    "agg_group_floor",
    "SELECT month, CAST(d AS INTEGER) AS d, min(mktcap) AS floor FROM (SELECT month, mktcap, ntile(4) OVER (PARTITION BY month ORDER BY mktcap, permno) AS d FROM t_panel) GROUP BY 1, 2",
)
def agg_group_floor(t):
    ranked = quantiles.ntile(t.stored_panel("permno", "month", "mktcap"), "mktcap", 4, ["month"], "permno", "d")
    return ranked.groupBy("month", "d").agg(F.min("mktcap").alias("floor"))


@query("agg_describe", "SELECT event_type, avg(value) AS mean, stddev_samp(value) AS sd, min(value) AS min, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max, count(value) AS n FROM events GROUP BY 1", "mean sd min q25 q50 q75 max")
def agg_describe(t):
    return aggregates.summarize(t.driver("events"), "value", ["event_type"], {"q25": 0.25, "q50": 0.5, "q75": 0.75})


@query("agg_global", "SELECT avg(l_discount) AS mean FROM lineitem", "mean")
def agg_global(t):
    return t.driver("lineitem").agg(F.avg("l_discount").alias("mean"))


@query(
    "agg_rescale_base",
    """WITH level AS (SELECT date, max(adjusted) AS adjusted FROM t_prices GROUP BY 1)
       SELECT date, adjusted / (SELECT arg_max(adjusted, date) FROM level) AS adjusted FROM level""",
    "adjusted",
)
def agg_rescale_base(t):
    return aggregates.rescale_to_last(t.prices.groupBy("date").agg(F.max("adjusted").alias("adjusted")), "adjusted", "date")


# -- windows over panels with one row per (entity, period) ----------------------------------------------------------------


@query("win_lag", "SELECT permno, month, lag(vol) OVER (PARTITION BY permno ORDER BY month) AS prev FROM t_monthly_trade")
def win_lag(t):
    return blocks.shift_rows(t.stored_monthly.select("permno", "month", "vol"), {"prev": "vol"}, ["permno"], ["month"]).drop("vol")


@query("win_lead", "SELECT permno, month, lead(vol) OVER (PARTITION BY permno ORDER BY month) AS next FROM t_monthly_trade")
def win_lead(t):
    return blocks.shift_rows(t.stored_monthly.select("permno", "month", "vol"), {"next": "vol"}, ["permno"], ["month"], -1).drop("vol")


@query(
    "win_shift_blocks",
    "SELECT o_orderkey, lag(o_totalprice, 3) OVER w AS before, lead(o_totalprice, 3) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY CAST(o_orderdate AS DATE), o_orderkey)",
)
def win_shift_blocks(t):
    """The plan for groups beyond one task, forced: blocks of 250 rows with copies of their neighbours' edges."""
    rows = _orders(t).select("o_orderkey", "o_orderstatus", "d", "o_totalprice")
    size = {"max_group_rows": 100, "block_rows": 250}
    rows = materialize(blocks.shift_rows(rows, {"before": "o_totalprice"}, ["o_orderstatus"], ["d", "o_orderkey"], 3, **size), "shifted")
    out = blocks.shift_rows(rows, {"after": "o_totalprice"}, ["o_orderstatus"], ["d", "o_orderkey"], -3, **size)
    return out.select("o_orderkey", "before", "after")


@query("win_group_max", "SELECT permno, month, max(vol) OVER (PARTITION BY permno) AS top FROM t_monthly_trade")
def win_group_max(t):
    return t.monthly_trade.select("permno", "month", F.max("vol").over(Window.partitionBy("permno")).alias("top"))


@query("win_group_count", "SELECT permno, month, count(*) OVER (PARTITION BY permno) AS n FROM t_monthly_trade")
def win_group_count(t):
    return t.monthly_trade.select("permno", "month", F.count(F.lit(1)).over(Window.partitionBy("permno")).alias("n"))


@query("win_share", "SELECT permno, month, mktcap / sum(mktcap) OVER (PARTITION BY month) AS share FROM t_panel", "share", 9)
def win_share(t):
    return aggregates.share_of_group(t.panel.select("permno", "month", "mktcap"), "mktcap", ["month"], "share").drop("mktcap")


@query("win_ntile", "SELECT permno, month, CAST(ntile(10) OVER (PARTITION BY month ORDER BY mktcap, permno) AS INTEGER) AS decile FROM t_panel")
def win_ntile(t):
    return quantiles.ntile(t.stored_panel("permno", "month", "mktcap"), "mktcap", 10, ["month"], "permno", "decile").drop("mktcap")


@query(
    "win_ntile_narrowed",
    "SELECT o_orderstatus, o_orderkey, CAST(ntile(10) OVER (PARTITION BY o_orderstatus ORDER BY round(o_totalprice / 1000), o_orderkey) AS INTEGER) AS decile FROM orders",
)
def win_ntile_narrowed(t):
    """The plan for groups beyond one task's memory, forced on small groups with many ties."""
    rows = t.driver("orders").select("o_orderstatus", "o_orderkey", F.round(F.col("o_totalprice") / 1000).alias("v"))
    return quantiles.ntile(rows, "v", 10, ["o_orderstatus"], "o_orderkey", "decile", max_group_rows=500).drop("v")


@query("win_row_number", "SELECT gvkey, datadate, row_number() OVER (PARTITION BY gvkey ORDER BY datadate) AS seq FROM t_funda")
def win_row_number(t):
    return blocks.number_in_group(materialize(t.funda.select("gvkey", "datadate"), "funda"), ["gvkey"], ["datadate"])


@query("win_row_number_blocks", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS seq FROM orders")
def win_row_number_blocks(t):
    rows = t.driver("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return blocks.number_in_group(rows, ["o_orderstatus"], [F.col("o_totalprice").desc(), "o_orderkey"], max_group_rows=100).select("o_orderkey", "seq")


@query("win_rows_frame", "SELECT permno, month, sum(qty) OVER (PARTITION BY permno ORDER BY month ROWS BETWEEN 60 PRECEDING AND CURRENT ROW) AS qty, count(*) OVER (PARTITION BY permno ORDER BY month ROWS BETWEEN 60 PRECEDING AND CURRENT ROW) AS n FROM t_monthly_trade")
def win_rows_frame(t):
    terms = {"qty": F.col("qty"), "n": F.lit(1.0)}
    out = windows.rolling_sums(t.monthly_trade.select("permno", "month", "qty"), terms, "permno", "month", ("rows", -60, 0), min_block_width=8)
    return out.select("permno", "month", "qty", F.col("n").cast("long").alias("n"))


# One value in a hundred is NaN and one is huge; frames that do not hold them must not feel them.
SPOILT = "CASE WHEN (permno + mi) % 101 = 0 THEN {nan} WHEN (permno + mi) % 103 = 0 THEN 1e12 ELSE qty END"


@query(
    "win_rows_frame_spoilt",
    f"""SELECT permno, month, coalesce(sum(CASE WHEN NOT isnan(q) THEN q END) OVER w, 0) AS qty
        FROM (SELECT permno, month, {SPOILT.format(nan="'NaN'::DOUBLE")} AS q FROM (SELECT *, CAST(12 * year(month) + month(month) AS INTEGER) AS mi FROM t_monthly_trade))
        WINDOW w AS (PARTITION BY permno ORDER BY month ROWS BETWEEN 25 PRECEDING AND 2 PRECEDING)""",
    "qty", 4,
)
def win_rows_frame_spoilt(t):
    rows = t.monthly_trade.select("permno", "month", "qty", (12 * F.year("month") + F.month("month")).alias("mi"))
    spoilt = rows.withColumn("q", F.expr(SPOILT.format(nan="DOUBLE('NaN')")))
    return windows.rolling_sums(spoilt, {"total": F.col("q")}, "permno", "month", ("rows", -25, -2), min_block_width=8).select("permno", "month", F.col("total").alias("qty"))


@query("win_rows_excl_current", "SELECT permno, date, sum(qty) OVER (PARTITION BY permno ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS qty FROM t_daily_trade")
def win_rows_excl_current(t):
    terms = {"total": F.col("qty"), "n": F.lit(1.0)}
    out = windows.rolling_sums(t.daily_trade.select("permno", "date", "qty"), terms, "permno", "date", ("rows", -20, -1))
    return out.select("permno", "date", F.when(F.col("n") > 0, F.col("total")).alias("qty"))


@query("win_range_months", "SELECT permno, month, sum(qty) OVER (PARTITION BY permno ORDER BY month RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW) AS qty FROM t_monthly_trade")
def win_range_months(t):
    out = windows.rolling_sums(t.monthly_trade.select("permno", "month", "mi", "qty"), {"total": F.col("qty")}, "permno", "mi", ("range", -11, 0), min_block_width=8)
    return out.select("permno", "month", F.col("total").alias("qty"))


@query(
    "win_frame_minmax",
    """SELECT permno, month, CAST(date_diff('month', min(month) OVER w, max(month) OVER w) AS INTEGER) AS span, count(*) OVER w AS n FROM t_panel
       WINDOW w AS (PARTITION BY permno ORDER BY month RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW)""",
)
def win_frame_minmax(t):
    rows = t.panel.select("permno", "month").withColumn("mi", dates.month_index("month"))
    frame = windows.months_window("permno", "mi", 12)
    span = dates.months_apart(F.min("month").over(frame), F.max("month").over(frame))
    return rows.select("permno", "month", span.alias("span"), F.count(F.lit(1)).over(frame).alias("n"))


def _slid(t, windows_: dict, periods: int, **options):
    rows = t.panel.select("permno", "month", "ret_excess", "mktcap").withColumn("mi", dates.month_index("month"))
    out = sliding.slide_periods(rows, "permno", "mi", windows_, periods, **options)
    return out.withColumn("month", dates.month_at("mi")).drop("mi")


SLIDE = """SELECT permno, month, {result} FROM t_panel
       WINDOW w AS (PARTITION BY permno ORDER BY month RANGE BETWEEN INTERVAL {before} MONTH PRECEDING AND CURRENT ROW)"""


@query("win_slide_period", SLIDE.format(result="CASE WHEN count(ret_excess) OVER w >= 24 THEN avg(ret_excess) OVER w END AS mean", before=35), "mean", 9)
def win_slide_period(t):
    return _slid(t, {"mean": sliding.mean("ret_excess", 24)}, 36)


@query("win_slide_extremes", SLIDE.format(result="min(ret_excess) OVER w AS lowest, max(mktcap) OVER w AS highest", before=18), "lowest highest", 9)
def win_slide_extremes(t):
    return _slid(t, {"lowest": sliding.extreme("ret_excess", highest=False), "highest": sliding.extreme("mktcap")}, 19)


@query(
    "win_slide_quantiles",
    SLIDE.format(result=", ".join(f"CASE WHEN count(ret_excess) OVER w >= 6 THEN quantile_cont(ret_excess, {p}) OVER w END AS {n}" for n, p in (("q10", 0.1), ("q50", 0.5))), before=20),
    "q10 q50", 9,
)
def win_slide_quantiles(t):
    out = _slid(t, {"q": sliding.quantiles("ret_excess", (0.1, 0.5), 6)}, 21)
    return out.select("permno", "month", F.col("q")[0].alias("q10"), F.col("q")[1].alias("q50"))


@query(
    "win_slide_regression",
    SLIDE.format(
        result="""CASE WHEN date_diff('month', min(month) OVER (PARTITION BY permno), month) >= 23 AND regr_count(ret_excess, ln(mktcap)) OVER w >= 12 THEN regr_slope(ret_excess, ln(mktcap)) OVER w END AS slope,
               CASE WHEN date_diff('month', min(month) OVER (PARTITION BY permno), month) >= 23 AND regr_count(ret_excess, ln(mktcap)) OVER w >= 12 THEN regr_intercept(ret_excess, ln(mktcap)) OVER w END AS intercept""",
        before=23,
    ),
    "slope intercept",
)
def win_slide_regression(t):
    """Regression in complete windows only."""
    rows = t.panel.select("permno", "month", "ret_excess", F.ln("mktcap").alias("size")).withColumn("mi", dates.month_index("month"))
    out = sliding.slide_periods(rows, "permno", "mi", {"fit": sliding.regression("ret_excess", "size", 12)}, 24, complete=True)
    return out.select("permno", dates.month_at("mi").alias("month"), F.col("fit.slope").alias("slope"), F.col("fit.intercept").alias("intercept"))


@query(
    "win_fill_down",
    "SELECT permno, date, last_value(ret IGNORE NULLS) OVER (PARTITION BY permno ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ret FROM t_dsf",
    "ret", 9,
)
def win_fill_down(t):
    return blocks.fill_rows(materialize(t.dsf.select("permno", "date", "ret"), "daily"), ["ret"], ["permno"], ["date"])


@query(
    "win_fill_down_blocks",
    """SELECT o_orderkey, last_value(v IGNORE NULLS) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
       FROM (SELECT *, CASE WHEN o_orderkey % 997 = 5 THEN o_totalprice END AS v FROM orders)""",
)
def win_fill_down_blocks(t):
    """Known values a thousand rows apart, blocks of two hundred: most are carried over several blocks."""
    rows = t.driver("orders").selectExpr("o_orderkey", "o_orderstatus", "CASE WHEN o_orderkey % 997 = 5 THEN o_totalprice END AS v")
    return blocks.fill_rows(rows, ["v"], ["o_orderstatus"], ["o_orderkey"], max_group_rows=100, block_rows=200).select("o_orderkey", "v")


@query(
    "win_unnest_lag",
    f"""SELECT month, CAST(k AS INTEGER) AS k, breaks[k] AS low, breaks[k + 1] AS high FROM (
          SELECT *, unnest(range(1, 5)) AS k FROM ({breaks_sql("SELECT * FROM t_panel", "mktcap", 4, "month", "'NYSE'")}))""",
    "low high", 9,
)
def win_unnest_lag(t):
    arrays = size_sorts.breakpoints(t.stored_panel("month", "exchange", "mktcap"), "mktcap", 4, ["month"], ("NYSE",))
    rows = arrays.select("month", F.posexplode("breaks").alias("k", "high"))
    return rows.withColumn("low", windows.lag_row("high", ["month"], "k")).where("k > 0").select("month", "k", "low", "high")


# -- order, union, reshape ---------------------------------------------------------------------------------------------


@query("sort", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey")
def sort(t):
    return t.driver("orders").select("o_custkey", "o_orderkey").orderBy("o_custkey", "o_orderkey")


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC")
def sort_desc(t):
    return t.driver("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"))


@query("sort_category_by_stat", "SELECT c_mktsegment AS industry, median(c_acctbal) AS median_beta FROM customer GROUP BY 1 ORDER BY 2", "median_beta", 3)
def sort_category_by_stat(t):
    return betas.industry_order(t.driver("customer").select(F.col("c_mktsegment").alias("industry"), F.col("c_acctbal").alias("beta_monthly")))


@query("union_all", "SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t):
    return t.driver("customer").select(F.col("c_nationkey").alias("nationkey")).unionByName(t.driver("supplier").select(F.col("s_nationkey").alias("nationkey")))


@query("union_rows", "SELECT c_custkey AS id, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, NULL FROM supplier")
def union_rows(t):
    left = t.driver("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return left.unionByName(t.driver("supplier").select(F.col("s_suppkey").alias("id")), allowMissingColumns=True)


@query("pivot_wider", "SELECT month, max(CASE WHEN exchange = 'NYSE' THEN n END) AS \"NYSE\", max(CASE WHEN exchange = 'AMEX' THEN n END) AS \"AMEX\" FROM (SELECT month, exchange, count(*) AS n FROM t_panel GROUP BY 1, 2) GROUP BY 1")
def pivot_wider(t):
    counts = t.panel.groupBy("month", "exchange").agg(F.count(F.lit(1)).alias("n"))
    return reshape.to_wide(counts, ["month"], "exchange", "n", ["NYSE", "AMEX"])


@query("pivot_longer", "SELECT month, name, value FROM (SELECT month, rf, mkt_excess FROM t_ff3) UNPIVOT (value FOR name IN (rf, mkt_excess))", "value", 9)
def pivot_longer(t):
    return reshape.to_long(t.ff3, ["month"], ["rf", "mkt_excess"])


@query("nest", "SELECT gvkey, count(*) AS filings, min(datadate) AS first, max(datadate) AS last FROM t_funda GROUP BY 1")
def nest(t):
    nested = reshape.nest(t.funda.select("gvkey", "datadate", "at"), ["gvkey"], "datadate")
    return nested.select("gvkey", F.size("data").cast("long").alias("filings"), F.col("data")[0]["datadate"].alias("first"), F.element_at("data", -1)["datadate"].alias("last"))


@query("nest_pieces", "SELECT o_orderstatus, (r - 1) // 400 AS piece, count(*) AS n, max(o_orderkey) AS last FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS r FROM orders) GROUP BY ALL")
def nest_pieces(t):
    """Three large groups in arrays of bounded size."""
    pieces = reshape.nest_pieces(t.driver("orders").select("o_orderstatus", "o_orderkey", "o_totalprice"), ["o_orderstatus"], "o_orderkey", 400)
    return pieces.select("o_orderstatus", "piece", F.size("data").cast("long").alias("n"), F.element_at("data", -1)["o_orderkey"].alias("last"))


@query("unnest", 'SELECT gvkey, datadate, "at" FROM t_funda')
def unnest(t):
    return reshape.unnest(reshape.nest(t.funda.select("gvkey", "datadate", "at"), ["gvkey"], "datadate"))


@query(
    "unnest_parallel",
    "SELECT event_type, unnest([0.1, 0.9]::DOUBLE[]) AS probs, unnest(quantile_cont(value, [0.1, 0.9])) AS values FROM events GROUP BY 1",
    "values",
)
def unnest_parallel(t):
    arrays = quantiles.exact_quantiles(t.driver("events"), "value", [0.1, 0.9], ["event_type"], "values")
    return reshape.unnest_parallel(arrays.withColumn("probs", F.array(F.lit(0.1), F.lit(0.9))), ["probs", "values"])


@query(
    "row_per_quantile",
    "SELECT month, CAST(k AS INTEGER) AS k, breaks[k + 1] AS breakpoint FROM (SELECT *, unnest(range(0, 6)) AS k FROM (SELECT month, quantile_cont(mktcap_lag, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS breaks FROM t_panel GROUP BY 1))",
    "breakpoint", 9,
)
def row_per_quantile(t):
    arrays = quantiles.exact_quantiles(t.stored_panel("month", "mktcap_lag"), "mktcap_lag", buckets.even_probabilities(5), ["month"], "breaks")
    return arrays.select("month", F.posexplode("breaks").alias("k", "breakpoint"))


SPEC_SAMPLES = {"all": "data", "no finance": "industry <> Finance", f"before {SPLIT}": f"month < {SPLIT}", f"from {SPLIT}": f"month >= {SPLIT}"}


@query(
    "spec_grid_unnest",
    f"""SELECT row_number() OVER (ORDER BY n_portfolios, exchanges, NOT value_weighted, place) AS spec, n_portfolios, value_weighted, data, size_premium
        FROM ({grid_sql()}) g JOIN (VALUES {", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(SPEC_SAMPLES.items()))}) s(place, subsample, data)
        ON g.subsample = s.subsample WHERE size_premium IS NOT NULL""",
    "size_premium", 9,
)
def spec_grid_unnest(t):
    specs = size_sorts.grid_specs(t.spark, samples=SPEC_SAMPLES)
    premiums = size_sorts.specification_grid(t.stored_panel("permno", "month", "exchange", "ret", "ret_excess", "mktcap_lag", "industry"), SPLIT)
    results = premiums.groupBy(*size_sorts.SPEC).agg(F.collect_list("size_premium").alias("size_premium"))
    return size_sorts.join_results(specs, results, "size_premium").drop("exchanges", "subsample")


# -- scalar functions ----------------------------------------------------------------------------------------------------


@query("date_floor", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter FROM orders")
def date_floor(t):
    return t.driver("orders").select("o_orderkey", dates.month_of("o_orderdate").alias("month"), dates.quarter_of("o_orderdate").alias("quarter"))


@query("date_part", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def date_part(t):
    return t.driver("orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@query("date_parse", "SELECT month AS from_month, month AS from_day, month AS from_parts FROM t_monthly_trade")
def date_parse(t):
    text = t.monthly_trade.select(F.date_format("month", "yyyyMM").alias("ym"), F.date_format("month", "yyyyMMdd").alias("ymd"), F.year("month").alias("y"), F.month("month").alias("m"))
    return text.select(
        dates.parse_yyyymm(F.col("ym")).alias("from_month"), dates.parse_yyyymmdd(F.col("ymd")).alias("from_day"), F.make_date("y", "m", F.lit(1)).alias("from_parts")
    )


@query("date_shift", f"SELECT o_orderkey, CAST(d + INTERVAL 1 MONTH AS DATE) AS next, CAST(d - INTERVAL 12 MONTH AS DATE) AS year_ago, CAST(d + INTERVAL 6 MONTH AS DATE) AS half FROM ({ORDERS})")
def date_shift(t):
    day = F.col("d")
    return _orders(t).select("o_orderkey", dates.shift_months(day, 1).alias("next"), dates.shift_months(day, -12).alias("year_ago"), dates.shift_months(day, 6).alias("half"))


@query("date_diff", "SELECT complete_cusip, CAST(date_diff('month', offering_date, maturity) AS INTEGER) AS months, CAST(maturity - offering_date AS INTEGER) AS days, (maturity - offering_date) / 365 AS years FROM t_issues", "years")
def date_diff(t):
    start, end = F.col("offering_date"), F.col("maturity")
    return t.issues.select("complete_cusip", dates.months_apart(start, end).alias("months"), F.datediff(end, start).alias("days"), (F.datediff(end, start) / 365).alias("years"))


@query("date_generate", "SELECT symbol, CAST(unnest(generate_series(low, high, INTERVAL 3 MONTH)) AS DATE) AS date FROM (SELECT symbol, date_trunc('quarter', min(date)) AS low, date_trunc('quarter', max(date)) AS high FROM t_prices GROUP BY 1)")
def date_generate(t):
    spans = t.prices.groupBy("symbol").agg(dates.quarter_of(F.min("date")).alias("low"), dates.quarter_of(F.max("date")).alias("high"))
    return spans.select("symbol", F.explode(F.expr("sequence(low, high, INTERVAL 3 MONTH)")).alias("date"))


@query("as_of_date", "SELECT lpermno, gvkey, coalesce(linkenddt, DATE '2001-12-31') AS linkenddt FROM t_links")
def as_of_date(t):
    return t.links.select("lpermno", "gvkey", F.coalesce("linkenddt", F.lit("2001-12-31").cast("date")).alias("linkenddt"))


@query("math", "SELECT l_orderkey, abs(l_discount - 0.05) AS a, ln(l_extendedprice) AS b, sqrt(l_quantity) AS c, l_extendedprice / 10 ** 6 AS d FROM lineitem", "a b c d", 9)
def math(t):
    return t.driver("lineitem").select(
        "l_orderkey", F.abs(F.col("l_discount") - 0.05).alias("a"), F.ln("l_extendedprice").alias("b"), F.sqrt("l_quantity").alias("c"),
        (F.col("l_extendedprice") / F.pow(F.lit(10), F.lit(6))).alias("d"),
    )


@query("row_max", "SELECT permno, date, CASE WHEN ret IS NOT NULL THEN greatest(ret, -0.01) END AS floored FROM t_msf", "floored", 9)
def row_max(t):
    return t.msf.select("permno", "date", scalars.floor_at(F.col("ret"), -0.01).alias("floored"))


@query("null_handling", "SELECT permno, date, coalesce(ret, 0) AS filled, nullif(shrout, 0) AS shrout, ret IS NULL AS missing, CASE WHEN ret > 0 THEN NULL ELSE ret END AS losses FROM t_msf", "filled losses", 9)
def null_handling(t):
    ret = F.col("ret")
    return t.msf.select(
        "permno", "date", F.coalesce(ret, F.lit(0.0)).alias("filled"), scalars.zero_to_null(F.col("shrout")).alias("shrout"),
        ret.isNull().alias("missing"), F.when(ret > 0, None).otherwise(ret).alias("losses"),
    )


@query("cast", "SELECT yyyymm, TRY_CAST(svar AS DOUBLE) AS svar, CAST(yyyymm AS INTEGER) AS number FROM t_macro_raw")
def cast(t):
    return t.macro_raw.select("yyyymm", scalars.text_to_number(F.col("svar")).alias("svar"), F.col("yyyymm").cast("int").alias("number"))


@query(
    "string",
    """SELECT n_nationkey, lower(n_name) AS lower, replace(n_name, 'NATION_', '') AS short, n_name || '-' || n_regionkey AS joined,
              concat_ws(', ', n_name, CAST(n_regionkey AS VARCHAR)) AS flat FROM nation""",
)
def string(t):
    name, region = F.col("n_name"), F.col("n_regionkey").cast("string")
    return t.driver("nation").select(
        "n_nationkey", F.lower(name).alias("lower"), F.regexp_replace(name, "^NATION_", "").alias("short"),
        F.concat_ws("-", name, region).alias("joined"), F.array_join(F.array(name, region), ", ").alias("flat"),
    )


@query(
    "interval_search",
    "SELECT p_partkey, CAST(greatest(1, least(4, (p_size >= 1)::INT + (p_size >= 10)::INT + (p_size >= 20)::INT + (p_size >= 35)::INT + (p_size >= 50)::INT)) AS INTEGER) AS bucket FROM part",
)
def interval_search(t):
    breaks = F.array(*[F.lit(b) for b in (1, 10, 20, 35, 50)])
    return t.driver("part").select("p_partkey", buckets.bucket_index(F.col("p_size"), breaks, 4).alias("bucket"))


@query("array_literal", "SELECT n_nationkey, unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS prob FROM nation")
def array_literal(t):
    return t.driver("nation").select("n_nationkey", F.explode(F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])).alias("prob"))


# -- regression families listed on their own --------------------------------------------------------------------------------


@query(
    "ols_rolling",
    """SELECT permno, month, beta_monthly, n_obs FROM (
         SELECT p.permno, p.month, regr_slope(p.ret_excess, f.mkt_excess) OVER w AS beta_monthly, CAST(regr_count(p.ret_excess, f.mkt_excess) OVER w AS BIGINT) AS n_obs
         FROM t_panel p LEFT JOIN t_ff3 f ON p.month = f.month
         WINDOW w AS (PARTITION BY p.permno ORDER BY p.month RANGE BETWEEN INTERVAL 23 MONTH PRECEDING AND CURRENT ROW)) WHERE n_obs >= 18""",
    "beta_monthly",
)
def ols_rolling(t):
    return betas.beta_monthly(t.panel, t.ff3, 24, 18)


@query(
    "ols_cross_section",
    """SELECT regr_intercept(ret, beta) AS intercept, regr_slope(ret, beta) AS slope, CAST(regr_count(ret, beta) AS BIGINT) AS n FROM (
         SELECT permno, regr_slope(ret_excess, mkt_excess) AS beta, avg(ret_excess) AS ret FROM t_panel p LEFT JOIN t_ff3 f ON p.month = f.month GROUP BY permno)""",
    "intercept slope",
)
def ols_cross_section(t):
    joined = betas.with_market(t.panel, t.ff3, "month")
    each = joined.groupBy("permno").agg(F.regr_slope("ret_excess", "mkt_excess").alias("beta"), F.avg("ret_excess").alias("ret"))
    return univariate.market_line(each)
