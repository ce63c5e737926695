import numpy as np
import pandas as pd
import pytest

from panelforge.operators.covariance import covariance_matrix
from panelforge.operators.fixed_effects import connected_parts, residualize_two_way, two_way_fit, within_fit
from panelforge.operators.hac import automatic_lag, newey_west
from panelforge.operators.regression import cluster_covariance, fit_products, ols, winsorize
from panelforge.plans import betas, portfolio


@pytest.fixture(scope="module")
def unbalanced():
    rng = np.random.default_rng(11)
    rows = [(f"f{i}", 2000 + t, i, t) for i in range(30) for t in range(8) if rng.random() < 0.7]
    frame = pd.DataFrame(rows, columns=["firm", "year", "i", "t"])
    frame["x"] = rng.normal(size=len(frame)) + frame["i"] / 10
    frame["z"] = rng.normal(size=len(frame)) + frame["t"] / 3
    frame["y"] = 0.5 * frame["x"] - 0.2 * frame["z"] + frame["i"] / 5 + frame["t"] / 4 + rng.normal(size=len(frame))
    return frame


@pytest.fixture(scope="module")
def panel(spark, unbalanced):
    return spark.createDataFrame(unbalanced).cache()


def dense(frame, *effects):
    parts = [frame[["x", "z"]].to_numpy()]
    for k, effect in enumerate(effects):
        dummies = pd.get_dummies(frame[effect]).to_numpy(float)
        parts.append(dummies if k == 0 else dummies[:, 1:])
    if not effects:
        parts.insert(0, np.ones((len(frame), 1)))
    design = np.hstack(parts)
    inverse = np.linalg.inv(design.T @ design)
    beta = inverse @ design.T @ frame["y"].to_numpy()
    residual = frame["y"].to_numpy() - design @ beta
    return design, inverse, beta, residual


def test_pooled(panel, unbalanced):
    design, inverse, beta, residual = dense(unbalanced)
    fit = ols(panel, "y", ["x", "z"])
    np.testing.assert_allclose(fit.beta, beta, rtol=1e-9)
    np.testing.assert_allclose(fit.iid(), residual @ residual / (len(residual) - 3) * inverse, rtol=1e-8)


def test_one_way(panel, unbalanced):
    design, inverse, beta, residual = dense(unbalanced, "firm")
    fit, firms = within_fit(panel, "y", ["x", "z"], "firm")
    np.testing.assert_allclose(fit.beta, beta[:2], rtol=1e-9)
    expected = residual @ residual / (len(residual) - design.shape[1]) * inverse[:2, :2]
    np.testing.assert_allclose(fit.iid(absorbed=firms), expected, rtol=1e-8)


def test_two_way_unbalanced_and_clusters(panel, unbalanced):
    design, inverse, beta, residual = dense(unbalanced, "firm", "year")
    fit, rows, effects = two_way_fit(panel, "y", ["x", "z"], "firm", "year")
    np.testing.assert_allclose(fit.beta, beta[:2], rtol=1e-8)
    expected = residual @ residual / (len(residual) - design.shape[1]) * inverse[:2, :2]
    np.testing.assert_allclose(fit.iid(absorbed=effects.rank), expected, rtol=1e-7)
    assert effects.parts == 1

    def sandwich(*keys):
        scores = pd.DataFrame(design * residual[:, None]).groupby([unbalanced[k] for k in keys]).sum().to_numpy()
        return (inverse @ scores.T @ scores @ inverse)[:2, :2], len(scores)

    one, groups = sandwich("firm")
    np.testing.assert_allclose(cluster_covariance(rows, "y", fit, ["firm"], small_sample=False), one, rtol=1e-6)
    scale = groups / (groups - 1) * (fit.n - 1) / (fit.n - 10)
    np.testing.assert_allclose(cluster_covariance(rows, "y", fit, ["firm"], estimated=10), one * scale, rtol=1e-6)
    both = one + sandwich("year")[0] - sandwich("firm", "year")[0]
    np.testing.assert_allclose(cluster_covariance(rows, "y", fit, ["firm", "year"], small_sample=False), both, rtol=1e-6)


@pytest.mark.parametrize("dense_periods", [2_000, 0])
def test_two_way_rank_of_a_panel_in_parts(spark, unbalanced, dense_periods):
    """Firms of three kinds seen in years of their own: a dense regression on all dummies loses one for each part."""
    apart = unbalanced[unbalanced["i"] % 3 == unbalanced["t"] % 3]
    residual, effects = residualize_two_way(spark.createDataFrame(apart), ["x", "z", "y"], "firm", "year", dense_periods)
    design = np.hstack([apart[["x", "z"]].to_numpy(), pd.get_dummies(apart["firm"]).to_numpy(float), pd.get_dummies(apart["year"]).to_numpy(float)])
    assert effects.parts == 3 and effects.rank + 2 == np.linalg.matrix_rank(design)
    beta = np.linalg.lstsq(design, apart["y"].to_numpy(), rcond=None)[0]
    left = apart["y"].to_numpy() - design @ beta
    fit = fit_products(residual, "y", ["x", "z"])
    np.testing.assert_allclose(fit.beta, beta[:2], rtol=1e-7)
    expected = left @ left / (len(apart) - np.linalg.matrix_rank(design)) * np.linalg.pinv(design.T @ design)[:2, :2]
    np.testing.assert_allclose(fit.iid(absorbed=effects.rank), expected, rtol=1e-6)


def test_parts_of_a_long_chain(spark):
    """Firms that each link two neighbouring years: one part, two when a link is missing."""
    chain = pd.DataFrame([(f, f + k) for f in range(60) for k in (0, 1)], columns=["firm", "year"])
    for frame, parts in ((chain, 1), (chain[chain["firm"] != 30], 2)):
        periods = sorted(int(y) for y in frame["year"].unique())
        assert connected_parts(spark.createDataFrame(frame).repartition(7), "firm", "year", periods) == parts


def test_negative_variances_are_repaired(spark):
    """Scores that cancel within both clusters but not within their intersection."""
    frame = pd.DataFrame({"g": [0, 0, 1, 1] * 6, "h": [0, 1, 0, 1] * 6, "x": np.tile([1.0, -1.0, -1.0, 1.0], 6), "y": np.tile([1.0, 1.0, 1.0, 1.0], 6)})
    frame["z"] = np.linspace(-1, 1, len(frame)) ** 3
    rows = spark.createDataFrame(frame)
    fit = fit_products(rows, "y", ["x", "z"])
    raw = cluster_covariance(rows, "y", fit, ["g", "h"], small_sample=False)
    assert np.linalg.eigvalsh(raw).min() < -1e-6
    fixed = cluster_covariance(rows, "y", fit, ["g", "h"], small_sample=False, repair=True)
    values, vectors = np.linalg.eigh(raw)
    np.testing.assert_allclose(fixed, vectors @ np.diag(np.maximum(values, 0)) @ vectors.T, atol=1e-12)
    assert np.linalg.eigvalsh(fixed).min() > -1e-12
    same = cluster_covariance(rows, "y", fit, ["g"], repair=True)
    np.testing.assert_allclose(same, cluster_covariance(rows, "y", fit, ["g"]), atol=1e-12)


def test_two_way_by_gradients(panel):
    columns = ["x", "z", "y"]
    solved = [residualize_two_way(panel, columns, "firm", "year", dense_periods=n)[0].toPandas().sort_values(["firm", "year"]) for n in (2_000, 0)]
    np.testing.assert_allclose(solved[1][columns].to_numpy(), solved[0][columns].to_numpy(), atol=1e-9)


def test_two_way_by_gradients_with_separate_parts(spark):
    rows = [(f"{part}{i}", 10 * part + t, float((i * 7 + t * 3) % 5 + part)) for part in (1, 2) for i in range(6) for t in range(5) if (i + t) % 4]
    frame = spark.createDataFrame(rows, "firm string, year int, x double")
    solved = [residualize_two_way(frame, ["x"], "firm", "year", dense_periods=n)[0].toPandas().sort_values(["firm", "year"]) for n in (2_000, 0)]
    np.testing.assert_allclose(solved[1]["x"].to_numpy(), solved[0]["x"].to_numpy(), atol=1e-9)


def test_newey_west_wants_one_row_per_period(spark):
    series = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 2.0), (3, 1.5), (4, 1.0)], "month int, ret double")
    with pytest.raises(Exception, match="several rows for one month"):
        newey_west(series, "ret", lag=1, prewhite=False).collect()
    assert newey_west(series.distinct().union(spark.createDataFrame([(None, 9.0)], "month int, ret double")), "ret", lag=1, prewhite=False).first()["n"] == 4


def test_given_design(panel, unbalanced):
    design = unbalanced[["x", "z"]].to_numpy()
    expected = np.linalg.lstsq(design, unbalanced["y"].to_numpy(), rcond=None)[0]
    np.testing.assert_allclose(fit_products(panel, "y", ["x", "z"]).beta, expected, rtol=1e-9)


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(5)
    x, e = rng.normal(size=120), np.zeros(120)
    for t in range(1, 120):
        e[t] = 0.5 * e[t - 1] + rng.normal()
    return pd.DataFrame({"month": np.arange(120), "x": x, "y": 1 + 0.3 * x + e})


def test_newey_west_fixed_lag(spark, series):
    got = newey_west(spark.createDataFrame(series), "y", ["x"], "month", lag=4, prewhite=False).toPandas().set_index("term")
    design = np.column_stack([np.ones(120), series["x"]])
    inverse = np.linalg.inv(design.T @ design)
    beta = inverse @ design.T @ series["y"].to_numpy()
    u = design * (series["y"].to_numpy() - design @ beta)[:, None]
    middle = u.T @ u
    for j in range(1, 5):
        gamma = u[j:].T @ u[:-j]
        middle = middle + (1 - j / 5) * (gamma + gamma.T)
    np.testing.assert_allclose(got["std_error"], np.sqrt(np.diag(inverse @ middle @ inverse)), rtol=1e-9)
    np.testing.assert_allclose(got["estimate"], beta, rtol=1e-9)


def test_newey_west_prewhitened_mean(spark, series):
    """With one score series and no lag the recoloured variance has a closed form."""
    got = newey_west(spark.createDataFrame(series), "y", [], "month", lag=0, prewhite=True).first()
    u = series["y"].to_numpy() - series["y"].mean()
    rho = (u[1:] @ u[:-1]) / (u[:-1] @ u[:-1])
    v = u[1:] - rho * u[:-1]
    assert got["std_error"] == pytest.approx(np.sqrt(v @ v) / (1 - rho) / 120, rel=1e-9)


def test_automatic_lag(series):
    u = (series["y"] - series["y"].mean()).to_numpy()
    first = int(np.floor(4 * (120 / 100) ** (2 / 9)))
    sigma = [u[: 120 - j] @ u[j:] / 120 for j in range(first + 1)]
    s0, s1 = sigma[0] + 2 * sum(sigma[1:]), 2 * sum(j * s for j, s in enumerate(sigma))
    assert automatic_lag(u[:, None], True, False) == int(1.1447 * (s1 / s0) ** (2 / 3) * 120 ** (1 / 3))


def test_covariance_blocks(spark):
    rng = np.random.default_rng(2)
    wide = rng.normal(size=(20, 9))
    rows = [(f"s{j}", int(t), float(wide[t, j])) for t in range(20) for j in range(9)]
    table = spark.createDataFrame(rows, "symbol string, month int, ret double")
    for block in (2, 4, 256):
        got = covariance_matrix(table, "symbol", "month", "ret", block).toPandas()
        assert len(got) == 81
        np.testing.assert_allclose(got.pivot(index="i", columns="j", values="cov").to_numpy(), np.cov(wide.T), rtol=1e-9)
    holed = covariance_matrix(table.where("NOT (symbol = 's3' AND month = 4)"), "symbol", "month", "ret", 2).toPandas()
    assert set(holed[holed["cov"].isna()]["i"]) >= {"s3"} and holed[(holed["i"] != "s3") & (holed["j"] != "s3")]["cov"].notna().all()


def test_two_funds(spark):
    rng = np.random.default_rng(4)
    wide = rng.normal(0.01, 0.05, size=(60, 5)) + np.arange(5) / 500
    rows = [(f"s{j}", int(t), float(wide[t, j])) for t in range(60) for j in range(5)]
    table = spark.createDataFrame(rows, "symbol string, month int, ret double")
    got = portfolio.two_funds(table).toPandas().sort_values("symbol")
    sigma, mu = np.cov(wide.T), wide.mean(axis=0)
    mvp = np.linalg.solve(sigma, np.ones(5))
    mvp /= mvp.sum()
    np.testing.assert_allclose(got["mvp"], mvp, rtol=1e-8)
    efficient = got["efficient"].to_numpy()
    assert efficient.sum() == pytest.approx(1) and efficient @ mu == pytest.approx(3 * mvp @ mu)
    # First-order condition of the minimum-variance problem with that mean: sigma w lies in the span of iota and mu.
    basis = np.column_stack([np.ones(5), mu])
    target = sigma @ efficient
    np.testing.assert_allclose(basis @ np.linalg.lstsq(basis, target, rcond=None)[0], target, atol=1e-12)
    frontier = portfolio.efficient_frontier(portfolio.two_funds(table)).toPandas()
    assert len(frontier) == 231 and frontier["c"].min() == -0.4 and frontier["c"].max() == 1.9
    at = frontier[frontier["c"] == 1.0].iloc[0]
    assert at["mu"] == pytest.approx(1200 * efficient @ mu)
    assert at["sd"] == pytest.approx(100 * np.sqrt(12 * efficient @ sigma @ efficient))
    with pytest.raises(ValueError):
        portfolio.two_funds(table.where("month < 5"))


def test_winsorize_keeps_missing(spark):
    values = [float(v) for v in range(100)] + [None]
    table = spark.createDataFrame([(v,) for v in values], "x double")
    for bound in (10**6, 20):
        got = [r["x"] for r in winsorize(table, ["x"], 0.05, bound).collect()]
        known = np.array(values[:-1])
        capped = np.minimum(known, np.quantile(known, 0.95))
        np.testing.assert_allclose(sorted(v for v in got if v is not None), np.maximum(capped, np.quantile(capped, 0.05)), rtol=1e-12)
        assert got.count(None) == 1


def test_rolling_beta_against_least_squares(spark):
    rng = np.random.default_rng(9)
    months = pd.date_range("2000-01-01", periods=40, freq="MS").date
    market = rng.normal(0, 0.05, 40)
    kept = [k for k in range(40) if k not in (7, 8, 21)]
    stock = {k: 0.7 * market[k] + rng.normal(0, 0.02) for k in kept}
    panel = spark.createDataFrame([(1, months[k], float(stock[k])) for k in kept], "permno int, month date, ret_excess double")
    factors = spark.createDataFrame([(m, float(x)) for m, x in zip(months, market, strict=True)], "month date, mkt_excess double")
    got = {r["month"]: (r["beta_monthly"], r["n_obs"]) for r in betas.beta_monthly(panel, factors, 12, 6).collect()}
    for k in kept:
        window = [j for j in kept if k - 11 <= j <= k]
        if len(window) < 6:
            assert months[k] not in got
            continue
        slope = np.polyfit(market[window], [stock[j] for j in window], 1)[0]
        assert got[months[k]][0] == pytest.approx(slope, rel=1e-9) and got[months[k]][1] == len(window)
    strict = {r["month"] for r in betas.beta_monthly(panel, factors, 12, 6, require_consecutive=True).collect()}
    frames = {k: [j for j in kept if k - 11 <= j <= k] for k in kept}
    assert strict == {months[k] for k, f in frames.items() if len(f) >= 6 and f[-1] - f[0] + 1 == len(f)}


def test_constant_market_has_no_beta(spark):
    months = pd.date_range("2000-01-01", periods=10, freq="MS").date
    panel = spark.createDataFrame([(1, m, 0.01 * k) for k, m in enumerate(months)], "permno int, month date, ret_excess double")
    factors = spark.createDataFrame([(m, 0.1) for m in months], "month date, mkt_excess double")
    assert betas.beta_monthly(panel, factors, 6, 3).count() == 0
