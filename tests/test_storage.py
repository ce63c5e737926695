import datetime as dt
import random
import re
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelforge.operators import windows
from panelforge.operators.joins import condense_validity, join_validity
from panelforge.plans import betas, daily_panel
from panelforge.sources import published
from panelforge.sources.schemas import DRIVER
from panelforge.storage import materialize, materialize_bucketed, remove_folder
from panelforge.workload import relational
from panelforge.workload.catalog import REGISTRY

FILE = """﻿This file was created by hand, with commas, too
Missing data are indicated by -99.99 or -999.

,Mkt-RF,SMB,HML,RF
192607,   2.96,  -2.56,  -2.43,   0.22
192608,   2.64,  -99.99,   3.82,   0.25
192609,   0.36,  -1.40,   0.13
192610,   x,  -1.40,   0.13, 0.23
1926,   1.0,  1.0,   1.0, 1.0
192611,  -3.24,  -0.10,  -999,   0.32

  Annual Factors: January-December 
,Mkt-RF,SMB,HML,RF
  1927,  29.47,  -2.04,  -4.54,   3.12
  1928,  35.39,   4.51,  -6.17,   3.56

Copyright 2023, the authors
"""


@pytest.fixture
def factor_file(tmp_path):
    path = tmp_path / "factors.CSV"
    path.write_text(FILE.replace("\n", "\r\n"), encoding="utf-8")
    return str(path)


def test_tables_of_a_published_file(spark, factor_file):
    rows, rejected = published.published_table(spark, factor_file, ["RF", "SMB", "HML"])
    assert sorted(map(tuple, rows.collect())) == [("192607", 0.22, -2.56, -2.43), ("192608", 0.25, None, 3.82), ("192611", 0.32, -0.10, None)]
    assert [(r["line"], r["reason"]) for r in rejected.orderBy("line").collect()] == [(7, "another number of fields"), (8, "not a number"), (9, "no date of this table")]
    annual, none = published.published_table(spark, factor_file, ["Mkt-RF"], table=2)
    assert sorted(map(tuple, annual.collect())) == [("1927", 29.47), ("1928", 35.39)] and none.count() == 0
    assert published.published_table(spark, factor_file, ["RF"], table=3)[0].count() == 0


def test_a_missing_column_fails(spark, factor_file):
    with pytest.raises(PySparkException, match="no column RMW"):
        published.published_table(spark, factor_file, ["RMW"])[0].collect()


def exchanges(df):
    return re.findall(r"hashpartitioning\(([^)]*)", df._jdf.queryExecution().executedPlan().toString())


def test_bucketed_panels_need_no_exchange(spark):
    """Rolling windows, the reduction of days to months and the join of both betas read buckets where they lie."""
    days = spark.range(4_000).selectExpr("CAST(id % 5 AS INT) AS permno", "date_add(DATE'2000-01-01', CAST(id div 5 AS INT)) AS date", "CAST(id * id % 17 AS DOUBLE) / 100 AS ret_excess")
    days = days.withColumn("month", F.trunc("date", "month"))
    months = days.groupBy("permno", "month").agg(F.sum("ret_excess").alias("ret_excess"))
    factors = days.groupBy("date").agg(F.avg("ret_excess").alias("mkt_excess"))
    monthly_factors = days.groupBy("month").agg(F.avg("ret_excess").alias("mkt_excess"))
    daily = materialize_bucketed(days, ["permno"], 4, ["permno", "date"], "days")
    monthly = materialize_bucketed(months, ["permno"], 4, ["permno", "month"], "months")
    factors, monthly_factors = materialize(factors), materialize(monthly_factors)
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(setting, "false")
    try:
        table = betas.beta_table(betas.beta_monthly(monthly, monthly_factors, 12, 6), betas.beta_daily(daily, factors, 3, 20))
        assert not [e for e in exchanges(table) if "permno" in e]
        assert table.count() > 0
    finally:
        spark.conf.unset(setting)
    plain = betas.beta_table(betas.beta_monthly(months, monthly_factors, 12, 6), betas.beta_daily(days, factors, 3, 20))
    assert [e for e in exchanges(plain) if "permno" in e]
    rounded = [F.round(c, 9).alias(c) for c in betas.BETAS]
    assert table.select("permno", "month", *rounded).exceptAll(plain.select("permno", "month", *rounded)).count() == 0
    lagged = monthly.select("permno", windows.lag_row("ret_excess", ["permno"], "month"))
    assert not exchanges(lagged)


def panel_inputs(spark):
    rng = random.Random(1)
    day = dt.date(2020, 1, 1)
    days = [day + dt.timedelta(k) for k in range(200)]
    returns = [(p, d, rng.random()) for p in range(6) for d in days if rng.random() < 0.8]
    factors = spark.createDataFrame([(d, 0.01) for d in days], "date date, rf double")
    exits = [(0, days[100], -0.5), (1, days[150], 0.1), (2, days[30], -0.3)]
    return returns, exits, factors


def snapshot(path):
    return {str(f.relative_to(path)): (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path).rglob("*.parquet")}


def test_refresh_equals_a_full_build_and_leaves_other_months_alone(spark, tmp_path):
    returns, exits, factors = panel_inputs(spark)
    frame = lambda rows: spark.createDataFrame(rows, "permno int, date date, ret double")
    leavers = lambda rows: spark.createDataFrame(rows, "permno int, dlstdt date, dlret double")
    changed = [r for r in returns if r[1].month == 2 and r[0] == 3]
    old = [r for r in returns if r not in changed]
    path = str(tmp_path / "daily")
    daily_panel.write_daily_panel(daily_panel.daily_panel(frame(old), leavers(exits[1:]), factors, "2020-12-31"), path)
    before = snapshot(path)
    months = daily_panel.touched_months(frame(returns), frame(changed), leavers(exits[:1]))
    touched = daily_panel.refresh_daily_panel(spark, path, frame(returns), leavers(exits), factors, "2020-12-31", months)
    assert [m.month for m in touched] == [2, 4, 5, 6, 7]  # the changed month, and all months after the new delisting
    full = daily_panel.daily_panel(frame(returns), leavers(exits), factors, "2020-12-31")
    now = spark.read.parquet(path).select(full.columns)
    assert now.exceptAll(full).count() == 0 and full.exceptAll(now).count() == 0
    after = snapshot(path)
    assert {f for f in before if f.startswith(("month=2020-01", "month=2020-03"))} == {f for f in before if after.get(f) == before[f]}


def test_refresh_removes_months_without_rows(spark, tmp_path):
    returns, exits, factors = panel_inputs(spark)
    frame = lambda rows: spark.createDataFrame(rows, "permno int, date date, ret double")
    path = str(tmp_path / "daily")
    none = spark.createDataFrame([], "permno int, dlstdt date, dlret double")
    daily_panel.write_daily_panel(daily_panel.daily_panel(frame(returns), none, factors, "2020-12-31"), path)
    rest = [r for r in returns if r[1].month != 5]
    gone = frame([r for r in returns if r[1].month == 5])
    daily_panel.refresh_daily_panel(spark, path, frame(rest), none, factors, "2020-12-31", daily_panel.touched_months(frame(rest), gone))
    found = spark.read.parquet(path)
    assert found.count() == len(rest) and found.where("month(month) = 5").count() == 0
    assert daily_panel.refresh_daily_panel(spark, path, frame(rest), none, factors, "2020-12-31", daily_panel.touched_months(frame(rest))) == []


def test_remove_folder(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("x")
    remove_folder(spark, str(tmp_path / "a"))
    assert not (tmp_path / "a").exists()


@pytest.mark.parametrize("cell_rows", [100_000, 20, 1])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_validity_cells_of_hot_keys(spark, cell_rows, how):
    """Half of all dates on one day of one key; open ends, ends in 9999, records that overlap or are empty."""
    rng = random.Random(6)
    day = dt.date(2000, 12, 20)
    left = [(i, "hot", day if i % 2 else day + dt.timedelta(rng.randrange(40))) for i in range(120)]
    left += [(200 + i, rng.choice(["a", "b", None]), rng.choice([None, day, dt.date(1990, 5, 1)])) for i in range(30)]
    right = [("hot", day + dt.timedelta(a), day + dt.timedelta(a + rng.randrange(-3, 30)), a) for a in range(-20, 30, 4)]
    right += [("a", dt.date(1980, 1, 1), None, 100), ("b", dt.date(2000, 1, 1), dt.date(9999, 12, 31), 101), (None, day, None, 102)]
    open_end = dt.date(2001, 1, 5)
    rows = spark.createDataFrame(left, "i int, k string, at date")
    records = spark.createDataFrame(right, "k string, first date, last date, r int")
    found = join_validity(rows, records, "k", "at", "first", "last", F.lit(open_end), how, cell_rows)
    expected = []
    for i, k, at in left:
        hits = [r for g, a, b, r in right if at is not None and g is not None and g == k and a <= (b or open_end) and a <= at <= (b or open_end)]
        expected += [(i, r) for r in hits] or ([(i, None)] if how == "left" else [])
    assert sorted(map(tuple, found.select("i", "r").collect()), key=repr) == sorted(expected, key=repr)
    assert set(found.columns) == {"i", "k", "at", "first", "last", "r"}


@pytest.mark.parametrize("seed", range(3))
def test_condensed_periods_count_what_is_valid(spark, seed):
    """Periods of a key are disjoint and hold, for every day, the records valid on it and the latest start of these."""
    rng = random.Random(seed)
    day, open_end = dt.date(1999, 12, 1), dt.date(2000, 2, 10)
    right = []
    for _ in range(60):
        first = rng.choice([None, *[day + dt.timedelta(rng.randrange(80))] * 9])
        right.append((rng.choice(["a", "a", "b", None]), first, rng.choice([None, (first or day) + dt.timedelta(rng.choice([-2, 0, 1, 3, 40, 400]))])))
    right += [right[0], right[0], ("c", day, dt.date(9999, 12, 31)), ("d", dt.date(2001, 1, 1), None)]
    records = spark.createDataFrame(right, "k string, f date, t date")
    found = condense_validity(records, "k", "f", "t", F.lit(open_end)).collect()
    for k in "abcd":
        for at in (day + dt.timedelta(i) for i in range(-5, 500)):
            hits = [f for g, f, t in right if g == k and f is not None and f <= at <= (t or open_end)]
            period = [(r["n"], r["latest"]) for r in found if r["k"] == k and r["f"] <= at <= r["t"]]
            assert period == ([(len(hits), max(hits))] if hits else [])
    assert all(r["k"] for r in found)


def test_overlapping_records_of_a_hot_key_are_not_paired(spark, tmp_path, monkeypatch):
    """Three times the customers and events of one key: the rows that the join deals out grow three times, not nine."""
    dealt, plain = [], relational.joins.join_validity
    records_of = lambda left, right, *a, **k: dealt.append((left.count(), right.count())) or plain(left, right, *a, **k)
    monkeypatch.setattr(relational.joins, "join_validity", records_of)
    ordered = [dt.datetime(1996, 1, 1) + dt.timedelta(days=d) for d in (0, 40, 90, 200)]
    for size in (20, 60):
        orders = [(i, 100 * (i // 4), "O", 1.0, ordered[i % 4] + dt.timedelta(days=i // 4 % 7), "p") for i in range(4 * size)]
        events = [(i, dt.datetime(1996, 1, 1), 100 * (i % size), "e", 1.0, None) for i in range(size)] + [(None, None, 0, "e", 1.0, None), (1, None, None, "e", 1.0, None)]
        at = tmp_path / str(size)
        spark.createDataFrame(orders, DRIVER["orders"]).write.parquet(str(at / "orders.parquet"))
        spark.createDataFrame(events, DRIVER["events"]).write.parquet(str(at / "events.parquet"))
        got = {r["event_id"]: (r["n"], r["latest"]) for r in REGISTRY["join_validity_hot"].run(spark, str(at)).collect()}
        expected = {None: (0, None)}
        days = [sorted(o[4].date() for o in orders if o[1] == 100 * c) for c in range(size)]
        for i in range(size):
            day = dt.date(1996, 1, 1) + dt.timedelta(days=i * i % 1500 // 3)
            valid = [max(d for d in mine if d <= day) for mine in days if mine[0] <= day and (day < mine[-1] or day <= dt.date(1996, 9, 1))]
            expected[i] = (len(valid), max(valid, default=None))
        assert got == expected
    (few, few_periods), (many, many_periods) = dealt[1], dealt[3]
    assert many <= 3.2 * few and many_periods == few_periods  # as many periods as there are days on which records begin or end


def test_hot_keys_are_spread_over_days(spark):
    rows = spark.range(50_000).selectExpr("id", "1 AS k", "date_add(DATE'2003-01-01', CAST(id % 300 AS INT)) AS at")
    records = spark.createDataFrame([(1, "2003-01-01", "2003-12-31")], "k int, first string, last string").selectExpr("k", "DATE(first) AS first", "DATE(last) AS last")
    adaptive = "spark.sql.adaptive.enabled"
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    kept = {s: spark.conf.get(s) for s in (adaptive, broadcast)}
    spark.conf.set(adaptive, "false")
    spark.conf.set(broadcast, "-1")
    try:
        out = join_validity(rows, records, "k", "at", "first", "last", cell_rows=1_000)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for s, v in kept.items():
            spark.conf.set(s, v)
    assert sum(sizes) == 50_000 and len(sizes) > 1 and max(sizes) < 35_000
