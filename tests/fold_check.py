"""Plain pandas/numpy version of the seasonal forecast recursion, used only as a
brute-force check of the Spark fold on small inputs."""

import numpy as np
import pandas as pd


def forecast_pdf(pdf: pd.DataFrame, order, y, x2, ar_set, ma_set, exog, m, mode="observed", lag_inputs=None):
    lag_inputs = lag_inputs or {}
    n_exog = len(exog)
    pdf = pdf.sort_values(order).reset_index(drop=True)
    test_idx = np.flatnonzero(pdf["split"].to_numpy() == "test")
    coef = pdf["coef"].iloc[0]
    d, D = int(pdf["d"].iloc[0]), int(pdf["sd"].iloc[0])
    yy = pdf[y].astype(float).to_numpy().copy()
    ww = pdf["w"].astype(float).to_numpy().copy()
    ee = pdf["e"].astype(float).fillna(0.0).to_numpy().copy()
    dx = pdf[x2[len(ar_set) + len(ma_set):]].astype(float).to_numpy()
    xx = pdf[exog].astype(float).to_numpy().copy()
    is_test = pdf["split"].to_numpy() == "test"

    def at(a, j):
        return a[j] if j >= 0 and np.isfinite(a[j]) else 0.0

    preds = []
    for t in test_idx:
        c = np.asarray(coef, float)
        if mode == "recursive":
            for j, name in enumerate(exog):
                if name in lag_inputs:
                    lag, mu_col, sd_col = lag_inputs[name]
                    mu, sd = float(pdf[mu_col].iloc[0]), float(pdf[sd_col].iloc[0]) or 1.0
                    xx[t, j] = (at(yy, t - lag) - mu) / sd
                else:
                    xx[t, j] = 0.0
            cur = [at(xx[:, j], t) - d * at(xx[:, j], t - 1) - D * at(xx[:, j], t - m)
                   + d * D * at(xx[:, j], t - m - 1) for j in range(n_exog)]
        else:
            cur = [dx[t, j] if np.isfinite(dx[t, j]) else 0.0 for j in range(n_exog)]
        v = c[0]
        for i, s in enumerate(ar_set):
            v += c[1 + i] * at(ww, t - s)
        for i, s in enumerate(ma_set):
            v += c[1 + len(ar_set) + i] * (ee[t - s] if t - s >= 0 and not is_test[t - s] else 0.0)
        for j in range(n_exog):
            v += c[1 + len(ar_set) + len(ma_set) + j] * cur[j]
        level = v + d * at(yy, t - 1) + D * at(yy, t - m) - d * D * at(yy, t - m - 1)
        ww[t], ee[t], yy[t] = v, 0.0, level
        preds.append(level)
    return np.asarray(preds)
