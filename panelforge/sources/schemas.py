"""Declared schemas of the raw inputs."""

MONTHLY_STOCK = "permno int, date date, ret double, shrout double, altprc double"
DAILY_STOCK = "permno int, date date, ret double"
NAMES = "permno int, shrcd int, exchcd int, siccd int, namedt date, nameendt date"
DELISTINGS = "permno int, dlstdt date, dlret double, dlstcd int"
LINKS = "lpermno int, gvkey string, linktype string, linkprim string, usedflag int, linkdt date, linkenddt date"
PRICES = "symbol string, date date, adjusted double, close double, volume double"
FACTORS3 = "date string, RF double, `Mkt-RF` double, SMB double, HML double"
FACTORS5 = "date string, RF double, `Mkt-RF` double, SMB double, HML double, RMW double, CMA double"
Q_FACTORS = "year int, month int, R_F double, R_MKT double, R_ME double, R_IA double, R_ROE double, R_EG double"
MACRO = (
    "yyyymm string, Index double, D12 double, E12 double, Rfree double, svar string, `b/m` double, ntis double, "
    "tbl double, lty double, ltr double, BAA double, AAA double, infl double"
)
CPI = "date date, price double"

# Driver tables that stand in for the raw inputs; a declared schema saves the job that would infer it.
DRIVER = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
