import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.operators import asof, blocks, sliding, windows

SIZES = [(1_000_000, 100_000), (5, 7), (5, 64)]


@pytest.fixture(scope="module")
def rows(spark):
    """One group with most rows, a NULL group, a group of one row; values often missing."""
    rng = random.Random(4)
    groups = ["hot"] * 300 + [None] * 40 + ["a"] * 25 + ["single"]
    rng.shuffle(groups)
    data = [(g, i, rng.randrange(1000) if rng.random() < 0.1 else None, float(i)) for i, g in enumerate(groups)]
    return spark.createDataFrame(data, "g string, at int, v int, x double").repartition(5).cache()


def same(found, expected):
    columns = expected.columns
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


@pytest.mark.parametrize(("bound", "size"), SIZES)
@pytest.mark.parametrize("offset", [1, 3, 20, -1, -20])
def test_shifts_equal_the_plain_window(rows, bound, size, offset):
    line = Window.partitionBy("g").orderBy("at")
    expected = rows.withColumns({"p": F.lag("v", offset).over(line), "q": F.lag("x", offset).over(line)})
    same(blocks.shift_rows(rows, {"p": "v", "q": "x"}, ["g"], ["at"], offset, bound, size), expected)


@pytest.mark.parametrize(("bound", "size"), SIZES)
def test_fill_and_numbers_equal_the_plain_window(rows, bound, size):
    line = Window.partitionBy("g").orderBy(F.col("at").desc())
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    sparse = rows.withColumn("x", F.when(F.col("at") % 90 == 1, F.col("x")))
    expected = sparse.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in ("v", "x")})
    same(blocks.fill_rows(sparse, ["v", "x"], ["g"], [F.col("at").desc()], bound, size), expected)
    numbered = rows.withColumn("seq", F.row_number().over(line).cast("long"))
    same(blocks.number_in_group(rows, ["g"], [F.col("at").desc()], max_group_rows=bound), numbered)


def test_an_empty_table_stays_empty(rows):
    none = rows.where("false")
    for bound in (5, -1):
        assert blocks.shift_rows(none, {"p": "v"}, ["g"], ["at"], 1, bound, 5).count() == 0
        assert blocks.fill_rows(none, ["v"], ["g"], ["at"], bound, 5).count() == 0


@pytest.mark.parametrize(("bound", "size"), [(1_000_000, 1000), (3, 5)])
def test_asof_takes_the_latest_at_or_before(spark, bound, size):
    rng = random.Random(9)
    left = [(k, rng.choice(["a", "b", None, "c"]), rng.choice([None, *range(200)])) for k in range(250)]
    right = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(0, 200, 9)]), rng.choice([None, *range(50)])) for _ in range(120)]

    def latest(key, at):
        seen = [(t, v is not None, v or 0, v) for g, t, v in right if g == key and t is not None and at is not None and key is not None and t <= at]
        return max(seen, default=(None, 0, 0, None))[::3]

    asked = spark.createDataFrame(left, "k int, g string, at int")
    events = spark.createDataFrame(right, "g string, t int, v int")
    found = asof.join_asof(asked, events, ["g"], "at", "t", ["v"], max_group_rows=bound, block_rows=size)
    assert sorted(map(tuple, found.select("k", "t", "v").collect())) == [(k, *latest(g, at)) for k, g, at in left]
    recent = asof.join_asof(asked, events, ["g"], "at", "t", ["v"], F.col("at") - F.col("t") < 4, "inner", max_group_rows=bound, block_rows=size)
    expected = [(k, *latest(g, at)) for k, g, at in left if latest(g, at)[0] is not None and at - latest(g, at)[0] < 4]
    assert sorted(map(tuple, recent.select("k", "t", "v").collect())) == expected


def test_asof_refuses_clashing_columns(spark):
    one = spark.createDataFrame([("a", 1)], "g string, t int")
    with pytest.raises(ValueError, match="both sides"):
        asof.join_asof(one, one, ["g"], "t", "t", [])


@pytest.fixture(scope="module")
def history(spark):
    """Periods with gaps and repeats, missing values, a NaN, an infinity and a huge value."""
    rng = random.Random(2)
    data = []
    for entity in (1, 2, 3):
        at = 0
        for k in range(90 if entity < 3 else 4):
            at += rng.choice([0, 1, 1, 1, 2, 15])
            value = {40: math.nan, 41: 1e12, 60: math.inf, 20: None}.get(k, float(rng.randrange(100)))
            data.append((entity, k, at, value))
    return spark.createDataFrame(data, "e int, k int, at int, v double").repartition(4).cache(), data


def total(values):
    return float(sum(v for v in values if v is not None and math.isfinite(v)))


@pytest.mark.parametrize(("first", "last"), [(-7, 0), (-8, -1), (-12, -5), (-29, 0), (-200, -1), (-3, 0), (-5, 5)])
def test_rows_frames_hold_nothing_of_what_they_passed(history, first, last):
    df, data = history
    found = windows.rolling_sums(df, {"s": F.col("v"), "n": F.lit(1.0)}, "e", "k", ("rows", first, last), min_block_width=8)
    assert found.columns == [*df.columns, "s", "n"]
    for r in found.collect():
        inside = [v for e, k, _, v in data if e == r["e"] and r["k"] + first <= k <= r["k"] + last]
        assert r["s"] == total(inside) and r["n"] == len(inside)


@pytest.mark.parametrize("width", [1, 8, 11, 60, 500])
def test_range_frames_with_gaps_and_repeated_periods(history, width):
    df, data = history
    found = windows.rolling_sums(df, {"s": F.col("v"), "n": F.lit(1.0)}, "e", "at", ("range", 1 - width, 0), min_block_width=8).collect()
    assert len(found) == len(data)
    for r in found:
        inside = [v for e, _, at, v in data if e == r["e"] and r["at"] - width < at <= r["at"]]
        assert r["s"] == total(inside) and r["n"] == len(inside)


@pytest.mark.parametrize("width", [1, 2, 3, 7, 12, 40])
@pytest.mark.parametrize("complete", [False, True])
def test_sliding_states_against_plain_windows(spark, history, width, complete):
    _, data = history
    rows = [(e, at, v if v is None or math.isfinite(v) and v < 1e6 else 3.0, float((k * k) % 37)) for e, k, at, v in data]
    df = spark.createDataFrame(rows, "e int, at int, y double, x double")
    kinds = {
        "low": sliding.extreme("y", highest=False), "high": sliding.extreme("y"), "mean": sliding.mean("y", 2),
        "q": sliding.quantiles("y", (0.0, 0.3, 1.0), 2), "fit": sliding.regression("y", "x", 4),
    }
    found = sliding.slide_periods(df, "e", "at", kinds, width, complete).collect()
    assert {(r["e"], r["at"]) for r in found} == {(e, at) for e, at, _, _ in rows} and len(found) == len({(e, at) for e, at, _, _ in rows})
    first = {e: min(at for f, at, _, _ in rows if f == e) for e, _, _, _ in rows}
    for r in found:
        pairs = [(y, x) for e, at, y, x in rows if e == r["e"] and r["at"] - width < at <= r["at"] and y is not None]
        ys = [y for y, _ in pairs]
        if not ys or (complete and r["at"] - first[r["e"]] < width - 1):
            assert [r[c] for c in kinds] == [None] * 5
            continue
        assert (r["low"], r["high"]) == (min(ys), max(ys))
        if len(ys) < 2:
            assert r["mean"] is None and r["q"] is None
        else:
            np.testing.assert_allclose(r["mean"], np.mean(ys))
            np.testing.assert_allclose(r["q"], np.quantile(ys, [0, 0.3, 1]))
        assert r["fit"]["n"] == len(ys)
        if len(ys) >= 4 and len({x for _, x in pairs}) > 1:
            np.testing.assert_allclose([r["fit"]["slope"], r["fit"]["intercept"]], np.polyfit([x for _, x in pairs], ys, 1), rtol=1e-6, atol=1e-8)
        else:
            assert r["fit"]["slope"] is None


def test_previous_month_with_two_values_fails(spark):
    df = spark.createDataFrame([(1, "2020-01-01", 5.0), (1, "2020-01-01", 6.0), (1, "2020-02-01", 7.0)], "e int, m string, v double").withColumn("m", F.to_date("m"))
    with pytest.raises(PySparkException, match="several values of v"):
        df.select(windows.lag_month("v", "e", "m")).collect()
    same_value = df.withColumn("v", F.lit(5.0)).select("m", windows.lag_month("v", "e", "m").alias("p")).where("p IS NOT NULL")
    assert [r["p"] for r in same_value.collect()] == [5.0]
