import datetime as dt

import pytest

from panelforge.operators.joins import join_validity
from panelforge.plans import accounting, size_sorts, univariate
from panelforge.plans import monthly_panel as mp
from panelforge.plans.daily_panel import daily_panel
from panelforge.plans.value_sorts import book_to_market, sorting_panel
from panelforge.sources import schemas
from panelforge.sources.factors import deflator, macro_predictors, q_factors
from pyspark.sql import functions as F


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def inputs(spark):
    months = ["2000-01-31", "2000-02-29", "2000-04-28", "2000-05-31"]
    rows = [(1, day(m), 0.01 * k if k != 1 else None, 10.0, -5.0 if k == 2 else 5.0 + k) for k, m in enumerate(months)]
    rows += [(2, day("2000-01-31"), 0.02, 10.0, 3.0), (2, day("2000-02-29"), 0.03, 0.0, 3.0), (3, day("2000-01-31"), 0.1, 1.0, 1.0)]
    returns = spark.createDataFrame(rows, schemas.MONTHLY_STOCK)
    names = spark.createDataFrame(
        [(1, 10, 1, 6500, day("1999-01-01"), day("2001-01-01")), (2, 11, None, None, day("1999-01-01"), day("2001-01-01")),
         (3, 12, 1, 100, day("1999-01-01"), day("2001-01-01"))], schemas.NAMES)
    exits = spark.createDataFrame([(1, day("2000-05-10"), None, 560)], schemas.DELISTINGS)
    factors = spark.createDataFrame([(day(f"2000-0{m}-01"), 0.005) for m in range(1, 6)], "month date, rf double")
    return returns, names, exits, factors


def test_missing_return_is_not_floored(inputs):
    returns, names, exits, factors = inputs
    panel = mp.add_excess_return(mp.classified_returns(returns, names, exits), factors, "month", "ret_adj")
    got = {(r["permno"], r["month"].month): r["ret_excess"] for r in panel.collect()}
    assert got[(1, 2)] is None
    assert got[(1, 1)] == pytest.approx(-0.005)
    assert got[(1, 5)] == pytest.approx(-0.305)


def test_gap_month_has_no_lagged_size(inputs):
    returns, names, exits, _ = inputs
    rows = {(r["permno"], r["month"].month): r for r in mp.classified_returns(returns, names, exits).collect()}
    assert rows[(1, 4)]["mktcap_lag"] is None
    assert rows[(1, 2)]["mktcap_lag"] == pytest.approx(0.05)
    assert rows[(1, 4)]["mktcap"] == pytest.approx(0.05)
    assert rows[(2, 2)]["mktcap"] is None
    assert rows[(2, 1)]["exchange"] == "Other" and rows[(2, 1)]["industry"] == "Missing"
    assert rows[(1, 1)]["exchange"] == "NYSE" and rows[(1, 1)]["industry"] == "Finance"
    assert not [k for k in rows if k[0] == 3]


def test_panel_keeps_complete_rows(inputs):
    got = mp.monthly_panel(*inputs).collect()
    assert sorted((r["permno"], r["month"].month) for r in got) == [(1, 5)]


def test_delisting_branches(spark):
    cases = [(None, None, 0.1, 0.1), (-0.2, 500, 0.1, -0.2), (None, 500, 0.1, -0.3), (None, 551, 0.1, -0.3), (None, 574, 0.1, -0.3),
             (None, 100, 0.1, 0.1), (None, 200, 0.1, -1.0), (None, 550, 0.1, -1.0)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, dlret double, code int, ret double, want double")
    got = rows.withColumn("got", mp.delisting_adjusted_return(F.col("ret"), F.col("dlret"), F.col("code")))
    assert all(r["got"] == r["want"] for r in got.collect())


def test_links_open_and_overlapping(spark):
    panel = spark.createDataFrame([(1, day("2000-06-30")), (2, day("2000-06-30")), (3, day("2000-06-30"))], "permno int, date date")
    rows = [(1, "A", "LU", "P", 1, day("1999-01-01"), None), (2, "B", "LC", "C", 1, day("1999-01-01"), day("2000-12-31")),
            (2, "C", "LU", "P", 1, day("2000-01-01"), None), (3, "D", "LX", "P", 1, day("1990-01-01"), None)]
    links = spark.createDataFrame(rows, schemas.LINKS)
    got = sorted((r["permno"], r["gvkey"] or "") for r in mp.link_entities(panel, links, "2001-01-01").collect())
    assert got == [(1, "A"), (2, "B"), (2, "C"), (3, "")]
    assert [(r["permno"], r["links"]) for r in mp.overlapping_links(panel, links, "2001-01-01").collect()] == [(2, 2)]
    closed = mp.link_entities(panel, links, "2000-01-15").where("permno = 1").first()
    assert closed["gvkey"] is None


def test_daily_panel_adds_and_cuts(spark):
    days = spark.createDataFrame(
        [(1, day("2000-01-03"), 0.01), (1, day("2000-01-05"), 0.02), (2, day("2000-01-03"), 0.03), (2, day("2000-01-04"), None), (2, day("2000-01-05"), 0.04)],
        schemas.DAILY_STOCK)
    exits = spark.createDataFrame([(1, day("2000-01-04"), -0.5, 500), (2, day("2000-01-05"), -0.1, 500)], schemas.DELISTINGS)
    factors = spark.createDataFrame([(day(f"2000-01-0{d}"), 0.0) for d in (3, 4, 5)], "date date, rf double")
    got = sorted((r["permno"], r["date"].day, r["ret"]) for r in daily_panel(days, exits, factors, "2000-12-31").collect())
    assert got == [(1, 3, 0.01), (1, 4, -0.5), (2, 3, 0.03), (2, 5, -0.1)]


def test_book_equity_sources(spark):
    columns = "seq ceq pstk at lt txditc txdb itcb pstkrv pstkl".split()
    cases = [((10.0, None, None, None, None, 1.0, None, None, 2.0, None), 9.0), ((None, 4.0, 1.0, None, None, None, 1.0, 2.0, None, 3.0), 5.0),
             ((None, None, None, 9.0, 4.0, None, None, 5.0, None, None), 5.0), ((None, 4.0, None, 9.0, 4.0, None, None, None, None, None), 5.0),
             ((-1.0, None, None, None, None, None, None, None, None, None), None)]
    rows = spark.createDataFrame([c for c, _ in cases], ", ".join(f"{c} double" for c in columns))
    assert [r["be"] for r in rows.select(accounting.book_equity().alias("be")).collect()] == [w for _, w in cases]


def test_stale_book_value(spark):
    months = [dt.date(2000 + (m // 12), m % 12 + 1, 1) for m in range(24)]
    panel = spark.createDataFrame(
        [(1, "A", m, m, 0.01, 1.0, 2.0, "NYSE") for m in months], "permno int, gvkey string, date date, month date, ret_excess double, mktcap_lag double, mktcap double, exchange string")
    accounts = spark.createDataFrame([("A", day("2000-03-31"), 4.0)], "gvkey string, datadate date, be double")
    got = sorted(r["month"] for r in sorting_panel(panel, book_to_market(accounts, panel)).collect())
    assert got[0] == day("2000-09-01") and got[-1] == day("2001-08-01") and len(got) == 12


def test_small_ingests(spark):
    cpi = spark.createDataFrame([(day("2000-01-15"), 50.0), (day("2000-02-15"), 100.0)], schemas.CPI)
    assert {r["month"].month: r["cpi"] for r in deflator(cpi).collect()} == {1: 0.5, 2: 1.0}
    q = spark.createDataFrame([(2000, 1, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)], schemas.Q_FACTORS)
    row = q_factors(q, "1990-01-01", "2010-01-01").first()
    assert (row["rf"], row["mkt_excess"], row["eg"]) == (0.01, 0.02, 0.06)
    sheet = spark.createDataFrame(
        [(f"2000{m:02d}", 100.0 + m, 2.0, 3.0, 0.01, "bad" if m == 5 else "0.5", *([0.1] * 8)) for m in range(1, 8)], schemas.MACRO)
    got = sorted(r["month"].month for r in macro_predictors(sheet, "2000-01-01", "2000-12-31").collect())
    assert got == [2, 3, 4, 6]


def test_two_delistings_of_one_security_each_count_in_their_month(spark):
    from panelforge.plans.monthly_panel import delistings_by_month

    rows = spark.createDataFrame(
        [(1, "2001-03-05", 0.1, 500), (1, "2004-07-09", 0.2, 100), (1, "2004-07-20", 0.3, 100)], "permno int, dlstdt string, dlret double, dlstcd int"
    ).selectExpr("permno", "to_date(dlstdt) AS dlstdt", "dlret", "dlstcd")
    found = sorted((str(r["month"]), r["dlret"]) for r in delistings_by_month(rows).collect())
    assert found == [("2001-03-01", 0.1), ("2004-07-01", 0.3)]


def test_two_rows_for_one_period_are_an_error(spark):
    import pytest

    from panelforge.operators.joins import period_lookup

    rows = spark.createDataFrame([("2001-01", 0.1), ("2001-01", 0.1), ("2001-02", 0.2)], "month string, rf double")
    assert period_lookup(rows, "month").count() == 2
    with pytest.raises(Exception, match="several rows for one month"):
        period_lookup(rows.union(spark.createDataFrame([("2001-02", 0.3)], rows.schema)), "month").collect()


def test_lag_month_with_two_rows_in_a_month(spark):
    from panelforge.operators.windows import lag_month

    rows = spark.createDataFrame([(1, "2001-01-01", 5.0), (1, "2001-02-01", 6.0), (1, "2001-02-01", 7.0), (1, "2001-04-01", 8.0)], "id int, m string, v double")
    rows = rows.selectExpr("id", "to_date(m) AS m", "v")
    assert sorted((r["v"], r["l"]) for r in rows.withColumn("l", lag_month("v", "id", "m")).collect()) == [(5.0, None), (6.0, 5.0), (7.0, 5.0), (8.0, None)]


def test_rolling_betas_forget_bad_values(spark):
    import datetime

    import numpy as np

    from panelforge.plans.betas import beta_monthly

    rng = np.random.default_rng(1)
    months = [datetime.date(2000 + i // 12, i % 12 + 1, 1) for i in range(60)]
    market = rng.normal(0.5, 0.02, 60)
    returns = 1.3 * market + rng.normal(0, 0.01, 60)
    returns[0], returns[1], returns[2] = np.nan, 1e12, np.inf
    panel = spark.createDataFrame([(1, m, float(r)) for m, r in zip(months, returns)], "permno int, month date, ret_excess double")
    factors = spark.createDataFrame([(m, float(x)) for m, x in zip(months, market)], "month date, mkt_excess double")
    found = {r["month"]: r["beta_monthly"] for r in beta_monthly(panel, factors, months=12, min_obs=6).collect()}
    for i in range(14, 60):
        expected = np.polyfit(market[i - 11 : i + 1], returns[i - 11 : i + 1], 1)[0]
        assert abs(found[months[i]] - expected) < 1e-9 * max(1, abs(expected))


def test_validity_without_end(spark):
    rows = spark.createDataFrame([(1, dt.date(2001, 5, 1)), (1, dt.date(2003, 5, 1)), (2, dt.date(2002, 1, 1))], "k int, at date")
    records = spark.createDataFrame(
        [(1, dt.date(1, 1, 1), dt.date(2001, 12, 31), "a"), (1, dt.date(2002, 1, 1), dt.date(9999, 12, 31), "b"), (2, dt.date(2005, 1, 1), None, "c"), (2, dt.date(1990, 1, 1), dt.date(1995, 1, 1), "d")],
        "k int, first date, last date, name string",
    )
    matched = join_validity(rows, records, "k", "at", "first", "last", F.lit("9999-12-31").cast("date"))
    assert {(r["k"], r["at"].year, r["name"]) for r in matched.collect()} == {(1, 2001, "a"), (1, 2003, "b")}
    assert join_validity(rows.where("k > 9"), records, "k", "at", "first", "last").count() == 0


def test_grid_of_numbers_that_do_not_divide_each_other(spark):
    months = [day("1990-01-01"), day("1990-07-01")]
    rows = [(i, m, "NYSE" if i % 2 else "AMEX", 0.01 * i, 0.01 * (i * 7 % 13), float(i * i), "Finance" if i % 5 else "Other") for m in months for i in range(1, 31)]
    panel = spark.createDataFrame(rows, "permno int, month date, exchange string, ret double, ret_excess double, mktcap_lag double, industry string")
    grid = size_sorts.specification_grid(panel, portfolios=(2, 3), exchanges={"NYSE": ("NYSE",)}, weights=(True,))
    found = {r["n_portfolios"]: r["size_premium"] for r in grid.where("subsample = 'all'").collect()}
    for n in (2, 3):
        assert found[n] == pytest.approx(size_sorts.size_premium(panel, n, ("NYSE",)).first()["size_premium"])
    specs = size_sorts.grid_specs(spark, portfolios=(2, 3), exchanges=("NYSE",), weights=(True,))
    results = grid.groupBy(*size_sorts.SPEC).agg(F.collect_list("size_premium").alias("size_premium"))
    joined = size_sorts.join_results(specs, results, "size_premium").collect()
    assert len(joined) == 2 * 4 and len({r["spec"] for r in joined}) == 8


def test_extreme_portfolios_are_those_of_the_month(spark):
    a, b, c = day("2000-01-01"), day("2000-02-01"), day("2000-03-01")
    rows = [(1, a, 0.1), (2, a, 0.2), (10, a, 0.5), (2, b, 0.3), (7, b, 0.1), (4, c, 0.2)]
    spread = univariate.long_short_extremes(spark.createDataFrame(rows, "portfolio int, month date, ret double"))
    found = {r["month"]: (r["low"], r["high"]) for r in spread.collect()}
    assert found == {a: (0.1, 0.5), b: (0.3, 0.1), c: (None, 0.2)}


def test_equal_rows_of_a_period_are_one_and_missing_values_count(spark):
    from panelforge.operators.joins import period_lookup

    nan = float("nan")
    rows = spark.createDataFrame([("a", None, nan)] * 500 + [("b", 1.0, None)] * 3 + [(None, 1.0, 2.0), (None, 3.0, 4.0)], "month string, x double, y double")
    found = {r["month"]: (r["x"], str(r["y"])) for r in period_lookup(rows, "month").collect()}
    assert found == {"a": (None, "nan"), "b": (1.0, "None")}
    for other in (("b", None, None), ("b", 1.0, 0.0), ("a", None, None)):
        with pytest.raises(Exception, match="several rows for one month"):
            period_lookup(rows.union(spark.createDataFrame([other], rows.schema)), "month").collect()


def test_inline_tables_are_broadcast_up_to_a_bound(spark, monkeypatch):
    from panelforge.sources import readers

    def plan():
        return readers.inline_table(spark, [(1, "a"), (2, "b")], "k int, v string")._jdf.queryExecution().analyzed().toString()

    assert "ResolvedHint" in plan()
    monkeypatch.setattr(readers, "INLINE_ROWS", 1)
    assert "ResolvedHint" not in plan()
