"""Seasonal forecast + residual correction.

The reference trains an LSTM on the seasonal model's in-sample residuals. Here the
correction is a penalised (ridge / elastic net / lasso) autoregression on the
scaled, clipped residuals (the same inputs and the same lookback rule); the multi-step
correction is a recursion over the horizon of each series, one row a series.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import decay
from .ridge import L1_RATIOS, RIDGE_GRID, fit_ridge_validated
from .sequence import validation_size
from .series import adaptive_lookback, inverse_standard, lag_columns, series_window, standard_scale_clip

# Residual lookback bounds, minimum sequences, clip bound, decay rate.
MAX_LOOKBACK = 6
MIN_LOOKBACK = 3
MIN_SEQUENCES = 20
CLIP_BOUND = 3.0
DECAY_RATE = 0.1


def fit_residual_corrector(resid: DataFrame, n_train: DataFrame, order: str, keys: Sequence[str],
                           value: str = "residual", ridges: Sequence[float] = RIDGE_GRID,
                           l1_ratios: Sequence[float] = L1_RATIOS) -> DataFrame:
    """Per series: lookback L, scaler mean/std, coefficients and the last L scaled residuals.

    ``n_train`` gives each series' number of training hours (for the lookback rule).
    Series with fewer than 20 residual sequences get NULL coefficients (correction 0).
    """
    keys = list(keys)
    sc = standard_scale_clip(resid, value, CLIP_BOUND, keys)
    s = f"{value}_sc"
    lookback = n_train.select(*keys, adaptive_lookback(F.col("n_train"), MAX_LOOKBACK, MIN_LOOKBACK)
                              .alias("lookback"))
    lagged, xcols = lag_columns(sc, order, [s], MAX_LOOKBACK, keys)   # [s_l6 .. s_l1]
    lagged = lagged.join(lookback, on=keys, how="inner")
    seqs = lagged.filter(" and ".join(f"`{c}` is not null" for c in xcols))
    w = series_window(order, keys)
    wall = Window.partitionBy(*keys)
    seqs = (seqs.withColumn("seq_idx", (F.row_number().over(w) - 1).cast("bigint"))
                .withColumn("n_seq", F.count(F.lit(1)).over(wall)))
    is_val = F.col("seq_idx") >= F.col("n_seq") - validation_size(F.col("n_seq"))
    models = fit_ridge_validated(seqs.filter(F.col("n_seq") >= MIN_SEQUENCES), keys, xcols, s,
                                 fit_mask=~is_val, val_mask=is_val, ridges=ridges, lookback_col="lookback",
                                 l1_ratios=l1_ratios)
    # last MAX_LOOKBACK scaled residuals per series, oldest first (bounded collect)
    back = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    tail = (sc.withColumn("_rb", F.row_number().over(back)).filter(F.col("_rb") <= MAX_LOOKBACK)
              .groupBy(*keys).agg(F.first(f"{value}__mean").alias("resid_mean"),
                                  F.first(f"{value}__std").alias("resid_std"),
                                  F.sort_array(F.collect_list(F.struct(F.col(order), F.col(s)))).alias("_tail")))
    tail = tail.select(*keys, "resid_mean", "resid_std", F.transform("_tail", lambda x: x[s]).alias("window"))
    return tail.join(models.drop("lookback"), on=keys, how="left").join(lookback, on=keys, how="inner")


def _recursion(keys):
    """One row a series -> its scaled predictions; a step costs the same at any horizon."""
    def one(r) -> list:
        if r["coef"] is None:
            return [0.0] * max(0, int(r["steps"]))
        c0, used = float(r["coef"][0]), [float(c) for c in r["used"]]
        win = deque((float("nan") if x is None else float(x) for x in r["win"]), maxlen=len(used) or 1)
        out = []
        for _ in range(int(r["steps"])):
            p = c0 + sum(c * x for c, x in zip(used, win))
            win.append(p)
            out.append(p)
        return [None if p != p else p for p in out]

    def fn(it):
        for pdf in it:
            if len(pdf):
                pdf["preds"] = [one(r) for r in pdf.to_dict("records")]
                yield pdf[[*keys, "resid_mean", "resid_std", "coef", "preds"]]
    return fn


def recursive_forecast(models: DataFrame, horizon: DataFrame, keys: Sequence[str],
                       rate: float = DECAY_RATE) -> DataFrame:
    """Feed each prediction back into the window for ``steps`` steps, invert the scaling
    and damp by ``exp(-rate * t)`` (M12, P11). Output: keys, step, correction.

    ``models``: keys, lookback, window (last MAX_LOOKBACK scaled values), coef
    ``[c0, c_l6 .. c_l1]``, resid_mean, resid_std; ``horizon``: keys, steps.
    A NULL ``coef`` gives a correction of 0 (model skipped).
    """
    keys = list(keys)
    m = models.join(horizon, on=keys, how="inner")
    L = F.col("lookback")
    coef = F.col("coef")
    # coefficients of the used lags, oldest first: positions 2+MAX-L .. MAX+1
    used = F.slice(coef, F.lit(2 + MAX_LOOKBACK) - L, L)
    win0 = F.slice(F.col("window"), F.lit(MAX_LOOKBACK + 1) - L, L)

    fields = [m.schema[k] for k in keys] + [T.StructField("resid_mean", T.DoubleType()), T.StructField("resid_std", T.DoubleType()),
                                            T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("preds", T.ArrayType(T.DoubleType()))]
    m = m.select(*keys, "resid_mean", "resid_std", "coef", "steps", used.alias("used"), win0.alias("win")).mapInPandas(
        _recursion(keys), T.StructType(fields))
    out = m.select(*keys, "resid_std", "resid_mean", coef.isNull().alias("_skip"), F.posexplode("preds").alias("step", "p"))
    level = inverse_standard(F.col("p"), F.col("resid_mean"), F.col("resid_std"))
    corr = F.when(F.col("_skip"), F.lit(0.0)).otherwise(level * decay(F.col("step"), rate))
    return out.select(*keys, F.col("step").cast("bigint").alias("step"), corr.alias("correction"))


def hybrid_forecast(seasonal: DataFrame, correction: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Seasonal forecast + correction per step (M13); a missing correction counts as 0."""
    keys = list(keys)
    j = seasonal.join(correction, on=[*keys, "step"], how="left")
    return j.withColumn("correction", F.coalesce(F.col("correction"), F.lit(0.0))).withColumn(
        "hybrid_forecast", F.col("seasonal_forecast") + F.col("correction"))
