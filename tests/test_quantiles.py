import numpy as np
import pandas as pd
import pytest

from panelforge.functions.buckets import bucket_index, even_probabilities
from panelforge.operators.aggregates import summarize
from panelforge.operators.quantiles import exact_quantiles, ntile, quantile_rows
from pyspark.sql import functions as F

PROBS = [0.0, 0.01, 0.2, 0.5, 0.777, 0.99, 1.0]


@pytest.fixture(scope="module")
def skewed():
    """A third of all rows share one value, and one group holds most rows."""
    rng = np.random.default_rng(7)
    groups = rng.choice(["a", "b", "c"], 4000, p=[0.8, 0.15, 0.05])
    values = np.where(rng.random(4000) < 0.33, 0.25, rng.lognormal(0, 3, 4000).round(2))
    frame = pd.DataFrame({"g": groups, "v": values, "id": rng.permutation(4000)})
    frame.loc[::97, "v"] = np.nan
    return frame


@pytest.fixture(scope="module")
def table(spark, skewed):
    return spark.createDataFrame(skewed).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).cache()


@pytest.mark.parametrize("bound", [10**6, 300, 40])
def test_quantiles_by_group(table, skewed, bound):
    got = {r["g"]: r["q"] for r in exact_quantiles(table, "v", PROBS, ["g"], "q", bound).collect()}
    for group, rows in skewed.dropna().groupby("g"):
        np.testing.assert_allclose(got[group], np.quantile(rows["v"], PROBS), rtol=1e-12)


@pytest.mark.parametrize("bound", [10**6, 200])
def test_quantiles_of_everything(table, skewed, bound):
    got = exact_quantiles(table, "v", PROBS, (), "q", bound).first()["q"]
    np.testing.assert_allclose(got, np.quantile(skewed["v"].dropna(), PROBS), rtol=1e-12)


def test_quantile_rows_null_group(spark):
    rows = spark.createDataFrame([(None, float(i)) for i in range(50)] + [("x", 1.0)], "g string, v double")
    for bound in (10**6, 10):
        got = {r["g"]: r["quantile"] for r in quantile_rows(rows, "v", [0.5], ["g"], max_group_rows=bound).collect()}
        assert got == {None: 24.5, "x": 1.0}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("bound", [10**6, 150])
def test_ntile_with_ties(table, skewed, bound, descending):
    got = ntile(table, "v", 7, ["g"], "id", "bucket", descending, bound).toPandas()
    known = skewed.dropna()
    for group, rows in known.groupby("g"):
        ordered = rows.sort_values(["v", "id"], ascending=[not descending, True])
        size, base, extra = len(rows), len(rows) // 7, len(rows) % 7
        expected = np.repeat(np.arange(1, 8), [base + (k < extra) for k in range(7)])
        assert len(expected) == size
        found = got[got["g"] == group].set_index("id")["bucket"]
        np.testing.assert_array_equal(found.loc[ordered["id"]].to_numpy(), expected)


def test_ntile_fewer_rows_than_buckets(spark):
    rows = spark.createDataFrame([("g", 1.0, i) for i in range(3)], "g string, v double, id int")
    for bound in (10, 1):
        got = ntile(rows, "v", 5, ["g"], "id", "b", max_group_rows=bound)
        assert sorted((r["id"], r["b"]) for r in got.collect()) == [(0, 1), (1, 2), (2, 3)]


@pytest.mark.parametrize(("schema", "ids"), [
    ("g string, v double, id string", [f"k{i:04d}" for i in range(101)]),
    ("g string, v bigint, id bigint", [(1 << 60) + i for i in range(101)]),
    ("g string, v double, id int", [None if i % 2 else 7 for i in range(101)]),
])
def test_ntile_is_the_same_at_every_size(spark, schema, ids):
    """Text ties, integers beyond 2^53, and repeated or missing ties."""
    whole = "v bigint" in schema
    rows = [("g" if i % 3 else None, (1 << 60) + i // 2 if whole else float(i // 10), k) for i, k in enumerate(ids)]
    frame = spark.createDataFrame(rows, schema)
    found = []
    for bound in (10**6, 5):
        got = ntile(frame, "v", 4, ["g"], "id", "b", max_group_rows=bound).collect()
        found.append(sorted((str(r["g"]), r["v"], str(r["id"]), r["b"]) for r in got))
    assert found[0] == found[1]


def test_bucket_index_matches_range_join(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 12, 200).astype(float)
    for n in (1, 2, 5, 10):
        breaks = np.quantile(values, even_probabilities(n))
        low, high = np.concatenate([[-np.inf], breaks[1:-1]]), np.concatenate([breaks[1:-1], [np.inf]])
        expected = [int(np.flatnonzero((v >= low) & (v < high))[0]) + 1 for v in values]
        rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
        got = rows.select("i", bucket_index(F.col("v"), F.array(*[F.lit(float(b)) for b in breaks]), n).alias("k"))
        assert [r["k"] for r in got.orderBy("i").collect()] == expected


def test_bucket_index_of_missing(spark):
    rows = spark.createDataFrame([(None, [1.0, 2.0]), (1.5, None), (1.5, [1.0, 2.0])], "v double, b array<double>")
    assert [r[0] for r in rows.select(bucket_index(F.col("v"), F.col("b"), 1)).collect()] == [None, None, 1]


def test_summary_same_beyond_bound(table):
    small, large = (summarize(table, "v", ["g"], max_group_rows=b).orderBy("g").toPandas() for b in (10**6, 100))
    pd.testing.assert_frame_equal(small, large)
    overall_small, overall_large = (summarize(table, "v", max_group_rows=b).toPandas() for b in (10**6, 100))
    pd.testing.assert_frame_equal(overall_small, overall_large)
