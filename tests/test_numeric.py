"""Numeric cross-checks of the least-squares core and the forecasters."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loglens.operators import hybrid, lsq, ridge, seasonal


def test_gram_solve_equals_lstsq(spark):
    rng = np.random.default_rng(1)
    n = 500
    X = rng.normal(size=(n, 3)) * [1, 10, 100] + [0, 5, 50]
    y = 2 + X @ [0.5, -0.2, 0.03] + rng.normal(scale=0.1, size=n)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(y=y, g=np.arange(n) % 2)
    df = spark.createDataFrame(pdf)
    g = lsq.gram_stats(df, ["g"], ["a", "b", "c"], "y").orderBy("g").toPandas()
    for gi, r in g.iterrows():
        beta, rank = lsq.solve(lsq.unpack(r["all_xtx"], 4), np.asarray(r["all_xty"]), range(4))
        sub = pdf[pdf.g == gi]
        A = np.column_stack([np.ones(len(sub)), sub[["a", "b", "c"]].to_numpy()])
        ref, res, *_ = np.linalg.lstsq(A, sub.y.to_numpy(), rcond=None)
        assert rank == 4
        np.testing.assert_allclose(beta, ref, rtol=1e-8, atol=1e-10)
        assert lsq.sse(beta, lsq.unpack(r["all_xtx"], 4), np.asarray(r["all_xty"]), r["all_yty"]) \
            == pytest.approx(res[0], rel=1e-6)


def test_collinear_columns_get_a_solution():
    X = np.column_stack([np.ones(50), np.arange(50.0), np.arange(50.0) * 2])
    y = 1 + 3 * np.arange(50.0)
    beta, rank = lsq.solve(X.T @ X, X.T @ y, range(3))
    assert rank == 2
    np.testing.assert_allclose(X @ beta, y, atol=1e-6)


def test_linear_model_matches_numpy(spark):
    from loglens.plans import model_queries
    from tests.conftest import SF_MID
    data, model = model_queries.lr_fit(spark, SF_MID)
    tr = data.filter("split = 'train'").toPandas()
    A = np.column_stack([np.ones(len(tr)), tr[["prev_count", "hour_sin", "hour_cos"]].to_numpy(float)])
    ref, *_ = np.linalg.lstsq(A, tr.request_count.to_numpy(float), rcond=None)
    lr = model.stages[-1]
    np.testing.assert_allclose([lr.intercept, *lr.coefficients], ref, rtol=1e-7)


def _ar_series(n, phi, seed=7, m=24, amp=5.0):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    e = rng.normal(size=n)
    for t in range(2, n):
        y[t] = phi[0] * y[t - 1] + phi[1] * y[t - 2] + e[t]
    return y + 100 + amp * np.sin(2 * np.pi * np.arange(n) / m)


def test_seasonal_fit_recovers_ar_coefficients(spark):
    n = 1200
    y = _ar_series(n, (0.6, -0.3), amp=0.0)
    ts = pd.date_range("2024-01-01", periods=n, freq="h")
    pdf = pd.DataFrame({"ts": ts, "y": y, "x": np.sin(np.arange(n) / 7.0)})
    pdf["split"] = np.where(np.arange(n) < int(0.8 * n), "train", "test")
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    grid = {"p": (2,), "d": (0,), "q": (0,), "sp": (0,), "sd": (0,), "sq": (0,)}
    fit = seasonal.fit_seasonal(df, "ts", "y", ["x"], grid=grid)
    best = fit.best.collect()[0]
    # coef = [c, w_l1, w_l2, e lags ..., x]
    ar = best["coef"][1:3]
    assert ar[0] == pytest.approx(0.6, abs=0.08) and ar[1] == pytest.approx(-0.3, abs=0.08)
    fc = seasonal.seasonal_forecast(fit, "y").toPandas()
    assert len(fc) == n - int(0.8 * n) and fc.seasonal_forecast.notna().all()


def test_grid_decoding_matches_python_enumeration(spark):
    keys = spark.createDataFrame([("a",)], "k string")
    g = seasonal.candidate_grid(keys).orderBy("cand_idx").toPandas()
    ref = seasonal.grid_candidates()
    assert len(g) == 144 == len(ref)
    for row, c in zip(g.itertuples(), ref):
        assert (row.p, row.d, row.q, row.sp, row.sd, row.sq) == tuple(c[k] for k in seasonal.GRID_ORDER)
    assert seasonal.default_index() == ref[seasonal.default_index()]["cand_idx"]


def test_recursive_forecast_equals_python_loop(spark):
    coef = [0.1, 0.05, -0.1, 0.2, 0.3, -0.25, 0.4]   # c0, lag6 .. lag1
    window = [0.5, -1.0, 0.2, 1.5, -0.3, 0.9]        # oldest first
    models = spark.createDataFrame([("s", 6, window, coef, 2.0, 3.0)],
                                   "k string, lookback int, window array<double>, coef array<double>, "
                                   "resid_mean double, resid_std double")
    horizon = spark.createDataFrame([("s", 8)], "k string, steps int")
    got = hybrid.recursive_forecast(models, horizon, ["k"]).orderBy("step").toPandas()
    win, out = list(window), []
    for t in range(8):
        p = coef[0] + sum(c * x for c, x in zip(coef[1:], win[-6:]))
        win.append(p)
        out.append((p * 3.0 + 2.0) * math.exp(-0.1 * t))
    np.testing.assert_allclose(got.correction.to_numpy(), out, rtol=1e-12)


def test_recursive_forecast_short_lookback_and_skip(spark):
    coef = [0.0, 0.0, 0.0, 0.0, 0.5, 0.25, 0.125]    # lookback 3 uses the last three
    models = spark.createDataFrame([("a", 3, [9.0, 9.0, 9.0, 1.0, 2.0, 4.0], coef, 0.0, 1.0),
                                    ("b", 6, [1.0] * 6, None, 0.0, 1.0)],
                                   "k string, lookback int, window array<double>, coef array<double>, "
                                   "resid_mean double, resid_std double")
    horizon = spark.createDataFrame([("a", 2), ("b", 3)], "k string, steps int")
    got = {(r.k, r.step): r.correction for r in hybrid.recursive_forecast(models, horizon, ["k"]).collect()}
    p0 = 0.5 * 1 + 0.25 * 2 + 0.125 * 4
    p1 = 0.5 * 2 + 0.25 * 4 + 0.125 * p0
    assert got[("a", 0)] == pytest.approx(p0) and got[("a", 1)] == pytest.approx(p1 * math.exp(-0.1))
    assert [got[("b", i)] for i in range(3)] == [0.0, 0.0, 0.0]


def test_ridge_picks_validation_minimum(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = rng.normal(size=(n, 2))
    y = 1 + x @ [2.0, -1.0] + rng.normal(scale=0.5, size=n)
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(y=y, k="s", v=np.arange(n) >= 320)
    df = spark.createDataFrame(pdf)
    m = ridge.fit_ridge_validated(df, ["k"], ["a", "b"], "y", ~F.col("v"), F.col("v")).collect()[0]
    assert m["n_fit"] == 320 and m["n_val"] == 80
    assert m["coef"][1] == pytest.approx(2.0, abs=0.15) and m["coef"][2] == pytest.approx(-1.0, abs=0.15)


def test_seasonal_fit_recovers_arma_coefficients(spark):
    rng = np.random.default_rng(11)
    n = 3000
    e = rng.normal(size=n)
    y = np.zeros(n)
    for t in range(1, n):
        y[t] = 0.5 * y[t - 1] + e[t] + 0.4 * e[t - 1]
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=n, freq="h"), "y": y + 50,
                        "x": rng.normal(size=n)})
    pdf["split"] = np.where(np.arange(n) < int(0.8 * n), "train", "test")
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    grid = {"p": (0, 1), "d": (0,), "q": (0, 1), "sp": (0,), "sd": (0,), "sq": (0,)}
    fit = seasonal.fit_seasonal(df, "ts", "y", ["x"], grid=grid)
    best = fit.best.collect()[0]
    assert (best["p"], best["q"]) == (1, 1)
    ar_set, ma_set = fit.ar_set, fit.ma_set
    phi = best["coef"][1 + ar_set.index(1)]
    theta = best["coef"][1 + len(ar_set) + ma_set.index(1)]
    assert phi == pytest.approx(0.5, abs=0.1) and theta == pytest.approx(0.4, abs=0.1)


def test_short_series_keep_default_order_with_null_aic(spark):
    n = 40
    pdf = pd.DataFrame({"k": ["short"] * n, "ts": pd.date_range("2024-01-01", periods=n, freq="h"),
                        "y": np.arange(n, dtype=float) % 7, "x": np.ones(n)})
    pdf["split"] = np.where(np.arange(n) < 32, "train", "test")
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    fit = seasonal.fit_seasonal(df, "ts", "y", ["x"], keys=["k"])
    best = fit.best.collect()[0]
    assert best["aic"] is None and best["cand_idx"] == seasonal.default_index()
    fc = seasonal.seasonal_forecast(fit, "y").collect()
    assert len(fc) == 8 and all(r.seasonal_forecast is None for r in fc)


def test_equal_fits_resolve_to_grid_order(spark):
    """An exogenous copy of lag 1 makes p=0 and p=1 the same fit; the earlier candidate wins."""
    rng = np.random.default_rng(5)
    n = 600
    y = 20 + rng.poisson(5, size=n).astype(float)
    prev = np.r_[np.nan, y[:-1]]
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=n, freq="h"), "y": y, "prev": prev}).iloc[1:]
    pdf["split"] = np.where(np.arange(len(pdf)) < int(0.8 * len(pdf)), "train", "test")
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    grid = {"p": (0, 1), "d": (0,), "q": (0,), "sp": (0,), "sd": (0,), "sq": (0,)}
    fit = seasonal.fit_seasonal(df, "ts", "y", ["prev"], grid=grid)
    aics = {r.p: r.aic for r in fit.candidates.collect()}
    assert aics[0] == pytest.approx(aics[1], abs=1e-6)
    assert fit.best.collect()[0]["p"] == 0


def test_sequence_regressor_gbt_candidate(spark):
    from loglens.operators import sequence
    from loglens.plans import common
    from tests.conftest import SF_SMALL
    f = common.features(spark, SF_SMALL)
    models, pred = sequence.fit_sequence_regressor(f, with_gbt=True)
    m = models.collect()[0]
    assert m["model"] in ("linear", "gbt") and m["val_mse"] >= 0
    rows = pred.collect()
    assert len(rows) > 0 and all(r.prediction is not None for r in rows)


def test_recursive_exog_mode_uses_no_test_inputs(spark):
    rng = np.random.default_rng(9)
    n = 400
    y = 30 + 5 * np.sin(2 * np.pi * np.arange(n) / 24) + rng.normal(size=n)
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=n, freq="h"), "y": y})
    pdf["prev_z"] = (np.r_[np.nan, y[:-1]] - 30) / 5
    pdf["other"] = rng.normal(size=n)
    pdf["y_mean"], pdf["y_std"] = 30.0, 5.0
    pdf = pdf.iloc[1:].reset_index(drop=True)
    pdf["split"] = np.where(np.arange(len(pdf)) < int(0.8 * len(pdf)), "train", "test")
    grid = {"p": (1,), "d": (0,), "q": (0,), "sp": (1,), "sd": (0,), "sq": (0,)}
    lag_inputs = {"prev_z": (1, "y_mean", "y_std")}

    def run(frame, mode):
        df = spark.createDataFrame(frame).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        fit = seasonal.fit_seasonal(df, "ts", "y", ["prev_z", "other"], grid=grid, carry=["y_mean", "y_std"])
        fc = seasonal.seasonal_forecast(fit, "y", exog_mode=mode, lag_inputs=lag_inputs)
        return fc.orderBy("step").toPandas().seasonal_forecast.to_numpy()

    changed = pdf.copy()
    test = changed.split == "test"
    changed.loc[test, "other"] = 100.0
    changed.loc[test, "prev_z"] = -100.0
    np.testing.assert_allclose(run(pdf, "recursive"), run(changed, "recursive"))
    assert not np.allclose(run(pdf, "observed"), run(changed, "observed"))


@pytest.mark.parametrize("mode", ["observed", "recursive"])
def test_spark_fold_equals_python_recursion(spark, mode):
    from loglens.plans import forecast_queries as FQ
    from tests.conftest import SF_MID
    from tests.fold_check import forecast_pdf
    _, fit = FQ.seasonal_fit(spark, SF_MID)
    got = seasonal.seasonal_forecast(fit, "request_count", exog_mode=mode, lag_inputs=FQ.LAG_INPUTS)
    got = got.orderBy("step").toPandas().seasonal_forecast.to_numpy()
    rows = seasonal._best_design(fit).toPandas()
    ref = forecast_pdf(rows, "hour_timestamp", "request_count", fit.x2, fit.ar_set, fit.ma_set, fit.exog, fit.m,
                       mode, FQ.LAG_INPUTS)
    assert len(got) == len(ref) > 0
    np.testing.assert_allclose(got, ref, rtol=1e-9, atol=1e-9)


def test_spark_fold_with_seasonal_terms(spark):
    """A candidate with AR, MA and seasonal differencing terms, against the python loop."""
    from tests.fold_check import forecast_pdf
    rng = np.random.default_rng(21)
    n = 500
    y = 50 + 8 * np.sin(2 * np.pi * np.arange(n) / 24) + rng.normal(size=n).cumsum() * 0.3
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=n, freq="h"), "y": y, "x": rng.normal(size=n)})
    pdf["split"] = np.where(np.arange(n) < 400, "train", "test")
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    grid = {"p": (2,), "d": (1,), "q": (1,), "sp": (1,), "sd": (1,), "sq": (1,)}
    fit = seasonal.fit_seasonal(df, "ts", "y", ["x"], grid=grid)
    got = seasonal.seasonal_forecast(fit, "y").orderBy("step").toPandas().seasonal_forecast.to_numpy()
    ref = forecast_pdf(seasonal._best_design(fit).toPandas(), "ts", "y", fit.x2, fit.ar_set, fit.ma_set,
                       fit.exog, fit.m)
    np.testing.assert_allclose(got, ref, rtol=1e-9, atol=1e-9)


def test_enet_from_gram_matches_ridge_and_shrinks(spark):
    rng = np.random.default_rng(4)
    n = 300
    X = rng.normal(size=(n, 4))
    y = 2 + X @ [1.5, 0.0, -0.7, 0.0] + rng.normal(scale=0.3, size=n)
    A = np.column_stack([np.ones(n), X])
    xtx, xty = A.T @ A, A.T @ y
    ridge, _ = lsq.solve(xtx, xty, range(5), ridge=0.1 * n)
    enet0 = lsq.solve_enet(xtx, xty, range(5), 0.1, 0.0)
    np.testing.assert_allclose(enet0, ridge, rtol=1e-7, atol=1e-9)
    lasso = lsq.solve_enet(xtx, xty, range(5), 0.1, 1.0)
    assert lasso[2] == 0.0 and lasso[4] == 0.0 and abs(lasso[1]) > 1.0
    # lasso KKT: |c_j - S_j b| <= lam on zero coefficients
    xbar = xtx[0, 1:] / n
    S = xtx[1:, 1:] / n - np.outer(xbar, xbar)
    c = xty[1:] / n - xbar * (xty[0] / n)
    g = c - S @ lasso[1:]
    assert np.all(np.abs(g[[1, 3]]) <= 0.1 + 1e-9)


def test_enet_is_solved_or_null_whatever_else_is_in_the_stack():
    rng = np.random.default_rng(6)
    n, lam = 400, 1e-6
    grams = []
    for closeness in (1.0, 1e-3):           # the second one's columns are nearly equal
        base = rng.normal(size=(n, 1))
        X = base + closeness * rng.normal(size=(n, 4))
        y = X @ [3.0, -2.0, 1.0, 0.5] + rng.normal(scale=0.01, size=n)
        A = np.column_stack([np.ones(n), X])
        grams.append((A.T @ A, A.T @ y))
    easy, hard = grams
    both = lsq.solve_enet_batch(np.stack([easy[0], hard[0]]), np.stack([easy[1], hard[1]]), range(5), lam, 1.0)
    for (xtx, xty), beta in zip(grams, both):
        np.testing.assert_array_equal(lsq.solve_enet_batch(xtx[None], xty[None], range(5), lam, 1.0)[0], beta)
        xbar = xtx[0, 1:] / n
        S, c = xtx[1:, 1:] / n - np.outer(xbar, xbar), xty[1:] / n - xbar * (xty[0] / n)
        slope = c - S @ beta[1:]
        on = beta[1:] != 0
        assert np.all(np.abs(slope) <= lam * (1 + 1e-3)) and np.allclose(slope[on], lam * np.sign(beta[1:][on]), rtol=1e-3)
    few = lsq.solve_enet_batch(np.stack([easy[0], hard[0]]), np.stack([easy[1], hard[1]]), range(5), lam, 1.0, max_iter=50)
    assert np.all(np.isfinite(few[0])) and np.all(np.isnan(few[1]))
    assert lsq.solve_enet(*hard, range(5), lam, 1.0, max_iter=50) is None


def test_residual_corrector_learns_ar1(spark):
    rng = np.random.default_rng(8)
    n = 800
    r = np.zeros(n)
    for t in range(1, n):
        r[t] = 0.7 * r[t - 1] + rng.normal()
    pdf = pd.DataFrame({"k": "s", "ts": pd.date_range("2024-01-01", periods=n, freq="h"), "residual": r})
    resid = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    n_train = spark.createDataFrame([("s", 1000)], "k string, n_train long")     # lookback 6
    models = hybrid.fit_residual_corrector(resid, n_train, "ts", ["k"])
    m = models.collect()[0]
    assert m["lookback"] == 6 and m["coef"] is not None
    assert m["coef"][-1] == pytest.approx(0.7, abs=0.1)          # lag-1 weight
    assert max(abs(c) for c in m["coef"][1:-1]) < 0.15            # older lags near 0
    corr = hybrid.recursive_forecast(models, spark.createDataFrame([("s", 3)], "k string, steps int"), ["k"])
    first = corr.filter("step = 0").first()["correction"]
    assert first == pytest.approx(0.7 * r[-1], abs=0.35)


def test_batched_solver_equals_single(spark):
    rng = np.random.default_rng(12)
    m, k = 7, 5
    xtx, xty = [], []
    for i in range(m):
        A = np.column_stack([np.ones(40), rng.normal(size=(40, k - 1))])
        if i == 3:
            A[:, 2] = A[:, 1] * 2.0                       # collinear: min-norm solution
        y = rng.normal(size=40)
        xtx.append(A.T @ A)
        xty.append(A.T @ y)
    xtx, xty = np.stack(xtx), np.stack(xty)
    xtx[5, :, 4] = xtx[5, 4, :] = 0.0                     # an all-zero column fails
    for cols in (range(k), [0, 1, 3]):
        beta, rank = lsq.solve_batch(xtx, xty, cols)
        for i in range(m):
            ref, r = lsq.solve(xtx[i], xty[i], cols)
            if ref is None:
                assert np.isnan(beta[i]).all() and rank[i] == 0
            else:
                np.testing.assert_allclose(beta[i], ref, rtol=1e-7, atol=1e-9)
                assert rank[i] == r


def test_batched_validated_solver_equals_per_row(spark):
    from loglens.operators.ridge import L1_RATIOS, RIDGE_GRID, _fit
    rng = np.random.default_rng(13)
    m, k = 6, 4
    fx, fy, vx, vy, vyy, fn, vn = [], [], [], [], [], [], []
    for _ in range(m):
        A = np.column_stack([np.ones(60), rng.normal(size=(60, k - 1))])
        y = A @ rng.normal(size=k) + rng.normal(scale=0.5, size=60)
        fa, fb, va, vb = A[:45], y[:45], A[45:], y[45:]
        fx.append(fa.T @ fa); fy.append(fa.T @ fb); vx.append(va.T @ va); vy.append(va.T @ vb)
        vyy.append(vb @ vb); fn.append(45.0); vn.append(15.0)
    fx, fy, vx, vy = map(np.stack, (fx, fy, vx, vy))
    for lam in RIDGE_GRID:
        for l1 in L1_RATIOS:
            batch = ridge._fit_batch(fx, fy, np.array(fn), range(k), lam, l1)
            for i in range(m):
                ref = _fit(fx[i], fy[i], fn[i], range(k), lam, l1)
                np.testing.assert_allclose(batch[i], ref, rtol=1e-6, atol=1e-8)


def test_winner_does_not_depend_on_the_unit(spark):
    """All candidates of a series are fitted on the same rows; the count times 10,000 gives the same winner."""
    from loglens.plans import common
    from loglens.plans import forecast_queries as FQ
    from tests.conftest import SF_MID
    data = FQ.forecast_inputs(spark, SF_MID)
    found = []
    for scale in (1, 10_000):
        own = data.withColumn("request_count", F.col("request_count") * scale)
        fit = seasonal.fit_seasonal(own, "hour_timestamp", "request_count", ["total_bytes_z", "prev_count_z"], stage=common.staged)
        assert fit.candidates.filter("n_obs is not null").select("n_obs").distinct().count() == 1
        found.append(fit.best.select("cand_idx").first()[0])
    assert found[0] == found[1]


def test_residuals_keep_every_row_of_the_winner(spark):
    """A winner without lags loses no train row but the burn-in."""
    from loglens.plans import baseline_queries as BQ
    from tests.conftest import SF_MID
    data, fit = BQ.exogenous_fit(spark, SF_MID)
    assert seasonal.seasonal_residuals(fit).count() == data.filter("split = 'train'").count() - 24


def test_recursion_is_linear_in_the_horizon(spark):
    import time
    schema = "k string, lookback int, window array<double>, coef array<double>, resid_mean double, resid_std double"
    models = spark.createDataFrame([("a", 3, [0.0, 0.0, 0.0, 0.1, 0.2, 0.3], [0.01, 0.0, 0.0, 0.0, 0.1, 0.2, 0.3], 0.0, 1.0)], schema)
    took = {}
    for steps in (40_000, 40_000, 80_000):
        t0 = time.perf_counter()
        horizon = spark.createDataFrame([("a", steps)], "k string, steps int")
        assert hybrid.recursive_forecast(models, horizon, ["k"]).count() == steps
        took[steps] = time.perf_counter() - t0
    assert took[80_000] < 3 * took[40_000] + 1


def test_missing_history_forecasts_null(spark):
    """A used lag that falls on a NULL gives NULL, not an invented level."""
    import datetime
    rows = [(datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i), float((i * 7) % 13) if i != 79 else None, float(i % 5), "train" if i < 80 else "test") for i in range(90)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, y double, x double, split string")
    grid = {"p": (1,), "d": (0,), "q": (0,), "sp": (0,), "sd": (0,), "sq": (0,)}
    fit = seasonal.fit_seasonal(df, "ts", "y", ["x"], grid=grid)
    got = [r.seasonal_forecast for r in seasonal.seasonal_forecast(fit, "y").orderBy("step").collect()]
    assert len(got) == 10 and got[0] is None
