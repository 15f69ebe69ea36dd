"""Penalised regression per series with a validation tail, from one Gram aggregation.

Fit and validation statistics are two masked sums in the same pass. Candidates are
(strength, L1 ratio) pairs: ridge (L1 ratio 0, closed form) and elastic net / lasso
(coordinate descent on the Gram). Each fit-part solve is scored on the validation
Gram; the winner (lowest validation MSE, ties to the earlier candidate) is refitted
on fit + validation statistics. No row is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from . import lsq

# Candidate penalty strengths (per-row scale) and L1 ratios (0 = ridge, 1 = lasso).
RIDGE_GRID = (0.0, 1e-4, 1e-3, 1e-2, 1e-1, 1.0)
L1_RATIOS = (0.0, 0.5, 1.0)


def _fit(xtx, xty, n, cols, lam, l1):
    """One system (kept as the reference for the batched path)."""
    if l1 == 0.0 or lam == 0.0:
        return lsq.solve(xtx, xty, cols, ridge=lam * max(n, 1))[0]
    return lsq.solve_enet(xtx, xty, cols, lam, l1)


def _fit_batch(xtx, xty, n, cols, lam, l1):
    """A stack of systems; NaN rows where a fit fails."""
    if l1 == 0.0 or lam == 0.0:
        a = xtx.copy()
        if lam:
            pen = [c for c in cols if c != 0]
            a[:, pen, pen] += (lam * np.maximum(n, 1))[:, None]
        return lsq.solve_batch(a, xty, cols)[0]
    return lsq.solve_enet_batch(xtx, xty, cols, lam, l1)


def _solver(keys: list[str], k: int, ridges: Sequence[float], lookback_col: str | None, n_lags: int,
            l1_ratios: Sequence[float] = (0.0,)):
    """Per partition: all series with the same regressor set are solved as one stack
    for every candidate; the validation winner is refitted on fit + validation."""
    cands = [(lam, l1) for l1 in l1_ratios for lam in ridges if not (lam == 0.0 and l1 != l1_ratios[0])]
    out_cols = [*keys, "ridge", "l1_ratio", "val_mse", "n_fit", "n_val", "coef"]

    def fn(it):
        for pdf in it:
            if pdf.empty:
                continue
            FX = lsq.unpack_batch(np.stack(pdf["fit_xtx"].to_numpy()), k)
            FY = np.stack(pdf["fit_xty"].to_numpy())
            FN = pdf["fit_n"].to_numpy(dtype=float)
            VX = lsq.unpack_batch(np.stack(pdf["val_xtx"].to_numpy()), k)
            VY = np.stack(pdf["val_xty"].to_numpy())
            VYY = pdf["val_yty"].to_numpy(dtype=float)
            VN = pdf["val_n"].to_numpy(dtype=float)
            looks = pdf[lookback_col].to_numpy(dtype=int) if lookback_col else np.full(len(pdf), -1)
            res = pdf[list(keys)].copy().reset_index(drop=True)
            res["ridge"], res["l1_ratio"], res["val_mse"] = np.nan, np.nan, np.nan
            coefs = [None] * len(pdf)
            for L in np.unique(looks):
                g = np.flatnonzero(looks == L)
                # regressors are [1, lag n_lags .. lag 1]: keep the last L lags
                cols = list(range(k)) if L < 0 else [0] + list(range(1 + n_lags - L, 1 + n_lags))
                best = np.full(len(g), np.inf)
                pick = np.full(len(g), -1)
                for ci, (lam, l1) in enumerate(cands):
                    beta = _fit_batch(FX[g], FY[g], FN[g], cols, lam, l1)
                    valid = ~np.isnan(beta).any(axis=1) & (VN[g] > 0)
                    mse = np.where(valid, lsq.sse_batch(np.nan_to_num(beta), VX[g], VY[g], VYY[g])
                                   / np.where(VN[g] > 0, VN[g], 1.0), np.inf)
                    better = mse < best
                    best[better], pick[better] = mse[better], ci
                for ci in np.unique(pick[pick >= 0]):
                    rows = g[pick == ci]
                    lam, l1 = cands[ci]
                    beta = _fit_batch(FX[rows] + VX[rows], FY[rows] + VY[rows], FN[rows] + VN[rows], cols, lam, l1)
                    for r, bvec in zip(rows, beta):
                        coefs[r] = None if np.isnan(bvec).any() else bvec.tolist()
                    res.loc[rows, "ridge"], res.loc[rows, "l1_ratio"] = lam, l1
                    res.loc[rows, "val_mse"] = best[pick == ci]
            res["n_fit"] = pdf["fit_n"].to_numpy(dtype="int64")
            res["n_val"] = pdf["val_n"].to_numpy(dtype="int64")
            res["coef"] = coefs
            yield res[out_cols]
    return fn


def fit_ridge_validated(df: DataFrame, keys: Sequence[str], x_cols: Sequence[str], y_col: str,
                        fit_mask: Column, val_mask: Column, ridges: Sequence[float] = RIDGE_GRID,
                        lookback_col: str | None = None, l1_ratios: Sequence[float] = (0.0,)) -> DataFrame:
    """Per series: chosen strength ``ridge`` and ``l1_ratio``, validation MSE, row counts
    and coefficients ``[intercept, *x_cols]`` (zeros for lags beyond ``lookback_col``)."""
    keys = list(keys)
    group = keys + ([lookback_col] if lookback_col else [])
    g = lsq.gram_stats(df, group, x_cols, y_col, masks={"fit": fit_mask, "val": val_mask})
    k = 1 + len(x_cols)
    schema = T.StructType([g.schema[c] for c in group] + [
        T.StructField("ridge", T.DoubleType()), T.StructField("l1_ratio", T.DoubleType()),
        T.StructField("val_mse", T.DoubleType()),
        T.StructField("n_fit", T.LongType()), T.StructField("n_val", T.LongType()),
        T.StructField("coef", T.ArrayType(T.DoubleType()))])
    return g.mapInPandas(_solver(group, k, list(ridges), lookback_col, len(x_cols), list(l1_ratios)), schema)
