"""Seasonal ARIMA-type forecaster with exogenous inputs, fitted for all grid candidates
of all series at once (J2, M8-M10).

Not maximum likelihood: each candidate is fitted by two-stage (Hannan-Rissanen)
least squares, which needs only lags, joins and aggregations:

1. One window per series produces all lags of the raw columns; then every row is copied
   once per differencing pair (d, sd) of the grid (four copies), where the differenced
   target ``w = (1-B)^d (1-B^m)^D y``, its lags and the differenced exogenous inputs are
   sums of those lags.
2. Stage 1, a long autoregression of ``w`` on its first K lags and the inputs, gives
   innovations ``e`` (one Gram aggregation + one solve per (series, d, D), joined back).
3. Stage 2 regresses ``w`` on the seasonal AR lags ``i + m*j``, the MA lags of ``e``
   and the inputs. One Gram matrix over the largest lag sets serves every
   candidate with the same (d, D): a candidate is a sub-matrix solve.
   AIC = n ln(RSS/n) + 2(k+1), k the numerical rank of the regressors, on the
   common sample of that (d, sd).
4. The lowest AIC wins per series (ties: grid order; if every fit fails the default
   order is kept with NULL AIC, as the reference does).

Forecasting is a recursion over the test horizon of each series: a JVM-side fold
(``aggregate``) over one row per series holding its horizon plus the few train rows
the lags reach. In-sample
one-step residuals are a Catalyst expression over the staged design table.

AIC values and forecasts approximate, but do not equal, exact state-space maximum
likelihood.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import lsq
from .series import ar_lags, drop_burn_in

# The reference's seasonal grid (outer to inner loop order), period and
# fallback order.
GRID_ORDER = ("p", "d", "q", "sp", "sd", "sq")
SEASONAL_GRID = {"p": (0, 1, 2), "d": (0, 1), "q": (0, 1, 2), "sp": (0, 1), "sd": (0, 1), "sq": (0, 1)}
SEASONAL_PERIOD = 24
DEFAULT_ORDER = {"p": 1, "d": 1, "q": 1, "sp": 1, "sd": 1, "sq": 1}

SERIES = "_series"


def grid_candidates(grid=SEASONAL_GRID) -> list[dict]:
    """Candidates in the reference's enumeration order, with their index."""
    out = []
    for i, vals in enumerate(itertools.product(*[grid[n] for n in GRID_ORDER])):
        out.append(dict(zip(GRID_ORDER, vals), cand_idx=i))
    return out


def default_index(grid=SEASONAL_GRID) -> int:
    for c in grid_candidates(grid):
        if all(c[n] == DEFAULT_ORDER[n] for n in GRID_ORDER):
            return c["cand_idx"]
    return 0


def candidate_grid(series_keys: DataFrame, grid=SEASONAL_GRID, m: int = SEASONAL_PERIOD) -> DataFrame:
    """Every series (row of ``series_keys``) x every grid candidate.

    Built with ``explode(sequence(0, N-1))`` and mixed-radix decoding of the index,
    so the fan-out is a generator on each series row, not a join.
    """
    n = math.prod(len(grid[k]) for k in GRID_ORDER)
    base = series_keys.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("cand_idx"))
    cols, stride = {}, 1
    for name in reversed(GRID_ORDER):
        vals = grid[name]
        digit = (F.floor(F.col("cand_idx") / F.lit(stride)) % F.lit(len(vals))).cast("int")
        cols[name] = F.element_at(F.array(*[F.lit(v) for v in vals]), digit + 1)
        stride *= len(vals)
    return base.select(*series_keys.columns, "cand_idx", *[cols[k].alias(k) for k in GRID_ORDER],
                       F.lit(m).alias("m"))


@dataclass
class SeasonalFit:
    keys: list[str]
    order: str
    design: DataFrame      # per (series, d, D) rows with lags, innovations, split
    candidates: DataFrame  # per (series, candidate): n_obs, aic, coef
    best: DataFrame        # per series: the chosen candidate
    x2: list[str]          # stage-2 regressor columns (coef[1:] order)
    exog: list[str]
    m: int
    ar_set: list[int]
    ma_set: list[int]


def _term(c: str, e: str) -> str:
    """SQL for ``c * e``, 0 where ``c`` is 0 whatever ``e`` is."""
    return f"case when {c} <> 0 then {e} * cast({c} as double) else 0.0D end"


def _stage_solve_schema(df: DataFrame, keys: Sequence[str], extra: str) -> T.StructType:
    fields = [df.schema[k] for k in keys]
    return T.StructType(fields + T._parse_datatype_string(extra).fields)


def _solve_ols_rows(keys, k):
    def fn(it):
        for pdf in it:
            if pdf.empty:
                continue
            xtx = lsq.unpack_batch(np.stack(pdf["train_xtx"].to_numpy()), k)
            xty = np.stack(pdf["train_xty"].to_numpy())
            beta, _ = lsq.solve_batch(xtx, xty, range(k))
            out = pdf[list(keys)].copy()
            out["coef1"] = [None if np.isnan(b).any() else b.tolist() for b in beta]
            yield out
    return fn


def _solve_candidates(keys, grid, ar_set, ma_set, n_exog, m):
    """All candidates of all (series, d, sd) rows in a partition: one stacked solve per
    candidate shape instead of one solve per series."""
    k = 1 + len(ar_set) + len(ma_set) + n_exog
    cands = grid_candidates(grid)
    out_cols = [*keys, "cand_idx", *GRID_ORDER, "n_obs", "aic", "coef"]

    def fn(it):
        for pdf in it:
            if pdf.empty:
                continue
            xtx = lsq.unpack_batch(np.stack(pdf["train_xtx"].to_numpy()), k)
            xty = np.stack(pdf["train_xty"].to_numpy())
            yty = pdf["train_yty"].to_numpy(dtype=float)
            n = pdf["train_n"].to_numpy(dtype=float)
            d_col, sd_col = pdf["d"].to_numpy(), pdf["sd"].to_numpy()
            parts = []
            for c in cands:
                rows = np.flatnonzero((d_col == c["d"]) & (sd_col == c["sd"]))
                if rows.size == 0:
                    continue
                cols = [0] + [1 + ar_set.index(s) for s in ar_lags(c["p"], c["sp"], m)]
                cols += [1 + len(ar_set) + ma_set.index(s) for s in ar_lags(c["q"], c["sq"], m)]
                cols += [1 + len(ar_set) + len(ma_set) + j for j in range(n_exog)]
                beta, rank = lsq.solve_batch(xtx[rows], xty[rows], cols)
                rss = lsq.sse_batch(np.nan_to_num(beta), xtx[rows], xty[rows], yty[rows])
                nn = n[rows]
                good = (~np.isnan(beta).any(axis=1)) & (nn > len(cols) + 1) & (rss > 0)
                aic = np.where(good, nn * np.log(np.where(good, rss, 1.0) / np.where(good, nn, 1.0))
                               + 2 * (rank + 1), np.nan)
                part = pdf.iloc[rows][list(keys)].copy()
                part["cand_idx"] = c["cand_idx"]
                for name in GRID_ORDER:
                    part[name] = c[name]
                part["n_obs"] = nn.astype("int64")
                part["aic"] = np.where(good, aic, np.nan)
                part["coef"] = [b.tolist() if g else None for b, g in zip(beta, good)]
                parts.append(part)
            if parts:
                res = pd.concat(parts, ignore_index=True)
                res["aic"] = res["aic"].astype("float64")
                yield res[out_cols]
    return fn


def _solve_used(keys, k):
    """Least squares on the regressors that are not all zero, rows with the same ones at once."""
    def fn(it):
        for pdf in it:
            if pdf.empty:
                continue
            xtx = lsq.unpack_batch(np.stack(pdf["train_xtx"].to_numpy()), k)
            xty = np.stack(pdf["train_xty"].to_numpy())
            used = np.einsum("rii->ri", xtx) > 0
            out = pdf[list(keys)].copy()
            out["n_fit"] = pdf["train_n"].to_numpy()
            coef = [None] * len(pdf)
            for pattern in np.unique(used, axis=0):
                rows = np.flatnonzero((used == pattern).all(axis=1))
                beta, _ = lsq.solve_batch(xtx[rows], xty[rows], np.flatnonzero(pattern).tolist())
                for r, b in zip(rows, beta):
                    coef[r] = None if np.isnan(b).any() else b.tolist()
            out["_coef"] = coef
            yield out
    return fn


def fit_seasonal(df: DataFrame, order: str, y: str, exog: Sequence[str], keys: Sequence[str] = (),
                 split_col: str = "split", m: int = SEASONAL_PERIOD, grid=SEASONAL_GRID,
                 long_ar: int | None = None, stage=None, carry: Sequence[str] = ()) -> SeasonalFit:
    """Grid search over ``grid`` for every series of ``df`` (M8).

    ``df`` holds one row per series bucket with ``split`` = 'train'/'test'; only train
    rows enter the fits. ``stage`` (optional) materialises the design table;
    ``carry`` names extra columns to keep on it (e.g. scaler statistics).
    """
    keys = list(keys)
    if not keys:
        df = df.withColumn(SERIES, F.lit(0))
        keys = [SERIES]
    exog = list(exog)
    if any(v not in (0, 1) for v in grid["d"]) or any(v not in (0, 1) for v in grid["sd"]):
        raise ValueError("d and sd must be 0 or 1")
    ar_set = ar_lags(max(grid["p"]), max(grid["sp"]), m)
    ma_set = ar_lags(max(grid["q"]), max(grid["sq"]), m)
    K = long_ar or (max(ar_set, default=0) + 2)
    pairs = sorted({(c["d"], c["sd"]) for c in grid_candidates(grid)})
    gkeys = keys + ["d", "sd"]
    max_shift = K + m + 1
    # dozens of lags and their sums: SQL text costs the driver one call a column
    over = f"over (partition by {', '.join(f'`{k}`' for k in keys)} order by `{order}`)"
    x = df.selectExpr("*", *[f"cast(lag(`{y}`, {j}) {over} as double) as _y{j}" for j in range(1, max_shift + 1)],
                      *[f"cast(lag(`{e}`, {j}) {over} as double) as `_{e}{j}`" for e in exog for j in (1, m, m + 1)])
    x = x.selectExpr("*", "inline(array(" + ", ".join(f"named_struct('d', {a}, 'sd', {b})" for a, b in pairs) + "))")

    def ycol(j):
        return f"cast(`{y}` as double)" if j == 0 else f"_y{j}"

    def wlag(s):
        return f"{ycol(s)} - {_term('d', ycol(s + 1))} - {_term('sd', ycol(s + m))} + {_term('(d * sd)', ycol(s + m + 1))}"

    sel = [f"{wlag(0)} as w"] + [f"{wlag(s)} as w_l{s}" for s in range(1, K + 1)]
    for e in exog:
        sel.append(f"cast(`{e}` as double) - {_term('d', f'`_{e}1`')} - {_term('sd', f'`_{e}{m}`')} + {_term('(d * sd)', f'`_{e}{m + 1}`')} as `{e}_dx`")
    base_cols = ([*keys, order, y, split_col, "d", "sd"] + [c for c in ("row_idx", "n_train") if c in df.columns]
                 + exog + [c for c in carry if c in df.columns])
    x = x.selectExpr(*[f"`{c}`" for c in base_cols], *sel)
    if stage is not None:
        x = stage(x)      # read by the stage-1 Gram and by the innovation join
    dx = [f"{e}_dx" for e in exog]
    train = F.col(split_col) == "train"

    # Stage 1: long autoregression -> innovations e.
    x1 = [f"w_l{s}" for s in range(1, K + 1)] + dx
    g1 = lsq.gram_stats(x, gkeys, x1, "w", masks={"train": train})
    k1 = 1 + len(x1)
    c1 = g1.mapInPandas(_solve_ols_rows(gkeys, k1),
                        _stage_solve_schema(g1, gkeys, "coef1 array<double>"))
    x = x.join(c1, on=gkeys, how="left")
    x = x.withColumn("e", F.when(train, F.col("w") - lsq.dot([f"`{c}`" for c in x1], "coef1")))
    over = f"over (partition by {', '.join(f'`{k}`' for k in gkeys)} order by `{order}`)"
    x = x.selectExpr(*[f"`{c}`" for c in base_cols], "w", *[f"w_l{s}" for s in ar_set], *[f"`{c}`" for c in dx], "e",
                     *[f"lag(e, {s}) {over} as e_l{s}" for s in ma_set])
    x2 = [f"w_l{s}" for s in ar_set] + [f"e_l{s}" for s in ma_set] + dx
    complete = F.expr(" and ".join(f"`{c}` is not null" for c in ["w", *x2]))
    same_hour = Window.partitionBy(*keys, order)
    x = x.withColumn("_common", F.sum(complete.cast("int")).over(same_hour) == F.lit(len(pairs)))
    if stage is not None:
        x = stage(x)

    # Stage 2: one Gram per (series, d, D), every candidate a sub-matrix solve.
    g2 = lsq.gram_stats(x, gkeys, x2, "w", masks={"train": train & F.col("_common")})
    cand_schema = _stage_solve_schema(
        g2, keys, "cand_idx int, p int, d int, q int, sp int, sd int, sq int, n_obs bigint, aic double, "
                  "coef array<double>")
    cands = g2.mapInPandas(_solve_candidates(keys, grid, ar_set, ma_set, len(dx), m), cand_schema)

    # Series with no train rows at all still get the default order (NULL AIC).
    series_keys = df.select(*keys).distinct()
    full = (candidate_grid(series_keys, grid, m).drop("m")
            .join(cands.drop(*GRID_ORDER), on=[*keys, "cand_idx"], how="left"))
    if stage is not None:
        full = stage(full)      # read for the winner, by its refit and by the caller
    # AIC rounded for ranking: fits that are equal up to float noise (e.g. a lag that
    # duplicates an exogenous input) fall back to grid order, like a strict "<" scan
    rank = Window.partitionBy(*keys).orderBy(F.round("aic", 6).asc_nulls_last(),
                                             (F.col("cand_idx") == default_index(grid)).desc(),
                                             F.col("cand_idx").asc())
    best = full.withColumn("_rk", F.row_number().over(rank)).filter(F.col("_rk") == 1).drop("_rk")
    fit = SeasonalFit(keys, order, x, full, best, x2, exog, m, ar_set, ma_set)

    # Final fit of the winner on every train row that has its own regressors.
    own = [f"{e} as `{c}`" for c, e in zip(x2, _own_regressors(fit))]
    g3 = lsq.gram_stats(_best_design(fit).selectExpr(*[f"`{c}`" for c in (*keys, split_col)], "w", *own), keys, x2, "w",
                        masks={"train": train})
    refit = g3.mapInPandas(_solve_used(keys, 1 + len(x2)), _stage_solve_schema(g3, keys, "n_fit bigint, _coef array<double>"))
    best = best.join(refit, on=keys, how="left").withColumn(
        "coef", F.when(F.col("coef").isNotNull(), F.coalesce("_coef", "coef"))).drop("_coef")
    fit.best = stage(best) if stage is not None else best
    return fit


def order_strings(df: DataFrame) -> DataFrame:
    """Add the reference's tuple text: ``(p, d, q)`` and ``(P, D, Q, m)``."""
    return (df.withColumn("order", F.format_string("(%d, %d, %d)", "p", "d", "q"))
              .withColumn("seasonal_order", F.format_string("(%d, %d, %d, %d)", "sp", "sd", "sq",
                                                            F.lit(SEASONAL_PERIOD))))


def _best_design(fit: SeasonalFit) -> DataFrame:
    b = fit.best.select(*fit.keys, "d", "sd", "p", "q", "sp", "sq", "coef")
    return fit.design.join(b, on=[*fit.keys, "d", "sd"], how="inner")


def _own_regressors(fit: SeasonalFit) -> list[str]:
    """SQL of the stage-2 regressors of the winner in a row of ``_best_design``: 0 for lags it does not use."""
    def lag(c, s, low, high):
        return f"case when {low} >= {s % fit.m} and {high} >= {s // fit.m} then `{c}` else 0.0D end"

    n = len(fit.ar_set)
    return ([lag(c, s, "p", "sp") for c, s in zip(fit.x2, fit.ar_set)]
            + [lag(c, s, "q", "sq") for c, s in zip(fit.x2[n:], fit.ma_set)]
            + [f"`{c}`" for c in fit.x2[n + len(fit.ma_set):]])


def _recursion(keys, A, M, n_exog, m, lags):
    """One row a series -> its forecasts. ``lags``: per exogenous input None (observed), 0 (held
    at its mean) or the target lag that it is; a step costs the same at any horizon."""
    def one(r) -> list | None:
        if r["coef"] is None:
            return [None] * len(r["t_test"])
        coef, d, D = np.asarray(r["coef"], float).tolist(), int(r["d"]), int(r["sd"])
        h, n = len(r["y_hist"]), len(r["t_test"])
        Y, W, E = ([float("nan") if v is None else float(v) for v in r[c]] + [0.0] * n for c in ("y_hist", "w_hist", "e_hist"))
        X = [[float("nan") if v is None else float(v) for v in r[f"x{j}_hist"]] + [0.0] * n for j in range(n_exog)]
        ar = [(s, c) for s, c in zip(A, coef[1:]) if c]
        ma = [(s, c) for s, c in zip(M, coef[1 + len(A):]) if c]
        inputs = [(j, c) for j, c in enumerate(coef[1 + len(A) + len(M):]) if c]
        back = lambda a, i: a[i] if i >= 0 else float("nan")
        shifts = [(-1.0, 1)] * d + [(-1.0, m)] * D + [(1.0, m + 1)] * (d * D)
        for t in range(h, h + n):
            v = coef[0]
            for s_, c in ar:
                v += c * back(W, t - s_)
            for s_, c in ma:
                v += c * back(E, t - s_)
            for j, c in inputs:
                if lags[j] is None:
                    dx = r[f"dx{j}_test"][t - h]
                    dx = float("nan") if dx is None else dx
                else:
                    if lags[j]:
                        X[j][t] = (back(Y, t - lags[j]) - r[f"_mu{j}"]) / (r[f"_sd{j}"] or 1.0)
                    dx = X[j][t] + sum(k * back(X[j], t - q) for k, q in shifts)
                v += c * dx
            W[t] = v
            Y[t] = v - sum(k * back(Y, t - q) for k, q in shifts)
        return [None if v != v else v for v in Y[h:]]

    def fn(it):
        for pdf in it:
            if len(pdf):
                out = pdf[list(keys)].copy()
                out["t"] = pdf["t_test"]
                out["f"] = [one(r) for r in pdf.to_dict("records")]
                yield out
    return fn


def seasonal_forecast(fit: SeasonalFit, y: str, split_col: str = "split", exog_mode: str = "observed",
                      lag_inputs: dict | None = None) -> DataFrame:
    """Multi-step forecast over every series' test rows with the winning candidate (M9).

    ``exog_mode='observed'`` feeds the observed exogenous inputs over the horizon (the
    reference's behaviour, which leaks test-time information). ``'recursive'`` uses no
    test-time input: an input listed in ``lag_inputs`` as ``name -> (lag, mean_col,
    std_col)`` is a scaled lag of the target and is filled from the forecast itself;
    any other input is unknown and held at its fitted mean (0 on the z scale).
    Future innovations are 0. Output: keys, order, step (0-based), seasonal_forecast.

    Each series contributes one row holding its test horizon and as many of its last
    train rows as the lags reach; a series without them, or with a NULL where a used
    lag falls, forecasts NULL.
    """
    if exog_mode not in ("observed", "recursive"):
        raise ValueError("exog_mode must be 'observed' or 'recursive'")
    lag_inputs = dict(lag_inputs or {})
    keys, order, m = fit.keys, fit.order, fit.m
    A, M, exog = fit.ar_set, fit.ma_set, fit.exog
    dxc = fit.x2[len(A) + len(M):]
    history = max([*A, *M, m + 1]) + 1
    last = Window.partitionBy(*keys, split_col).orderBy(F.col(order).desc())
    rows = _best_design(fit).withColumn("_back", F.row_number().over(last))
    rows = rows.filter((F.col(split_col) == "test") | (F.col("_back") <= history))
    lags = [None if exog_mode == "observed" else lag_inputs.get(e, (0,))[0] for e in exog]
    stats = [F.first(lag_inputs[e][i]).cast("double").alias(f"{n}{j}") for j, e in enumerate(exog) if lags[j]
             for i, n in ((1, "_mu"), (2, "_sd"))]
    rec = F.struct(F.col(order).alias("t"), (F.col(split_col) == "test").alias("is_test"),
                   F.col(y).cast("double").alias("y"), F.col("w").alias("w"), F.col("e").alias("e"),
                   *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(exog)],
                   *[F.col(c).alias(f"dx{j}") for j, c in enumerate(dxc)])
    g = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(rec)).alias("r"), F.first("coef").alias("coef"),
                                F.first("d").alias("d"), F.first("sd").alias("sd"), *stats)
    hist, test = F.filter("r", lambda x: ~x["is_test"]), F.filter("r", lambda x: x["is_test"])
    part = lambda a, name: F.transform(a, lambda x: x[name])
    g = g.select(*keys, "coef", "d", "sd", *[c for c in g.columns if c.startswith(("_mu", "_sd"))],
                 part(test, "t").alias("t_test"), *[part(hist, c).alias(f"{c}_hist") for c in ("y", "w", "e")],
                 *[part(hist, f"x{j}").alias(f"x{j}_hist") for j in range(len(exog))],
                 *[part(test, f"dx{j}").alias(f"dx{j}_test") for j in range(len(exog))])
    schema = T.StructType([g.schema[k] for k in keys] + [T.StructField("t", g.schema["t_test"].dataType),
                                                         T.StructField("f", T.ArrayType(T.DoubleType()))])
    out = g.mapInPandas(_recursion(keys, A, M, len(exog), m, lags), schema)
    out = out.select(*keys, F.posexplode(F.arrays_zip("t", "f")).alias("step", "z"))
    return out.select(*keys, F.col("z.t").alias(order), F.col("step").cast("bigint").alias("step"),
                      F.col("z.f").alias("seasonal_forecast"))


def seasonal_residuals(fit: SeasonalFit, burn_in: int = SEASONAL_PERIOD, split_col: str = "split") -> DataFrame:
    """One-step in-sample residuals of the winning candidate on every train row that has the
    winner's own regressors, first ``burn_in`` dropped per series (M10 + W11)."""
    rows = _best_design(fit).filter((F.col(split_col) == "train") & F.col("coef").isNotNull())
    r = rows.select(*fit.keys, fit.order, (F.col("w") - lsq.dot(_own_regressors(fit), "coef")).alias("residual"))
    return drop_burn_in(r, fit.order, burn_in, fit.keys).filter(F.col("residual").isNotNull())


def strip_series(df: DataFrame) -> DataFrame:
    return df.drop(SERIES) if SERIES in df.columns else df
