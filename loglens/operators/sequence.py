"""Next-hour regressor over a lookback window of scaled features (M7).

Stands in for the reference's LSTM: the same inputs (the last L hours of
request_count, total_bytes, prev_count, hour_sin, hour_cos, each min-max scaled),
the same target (next hour's scaled count), the same 80/20 split over sequences,
inverse scaling before metrics. The model is a penalised linear regression over the
L x F flattened window (ridge, elastic net or lasso), its penalty chosen on the tail of
the training sequences (not
on the test set, unlike the reference). Optionally, for the single global series, a
gradient-boosted tree model (Spark ML) competes on the same validation tail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import with_cyclical_hour
from . import lsq
from .ridge import L1_RATIOS, RIDGE_GRID, fit_ridge_validated
from .series import inverse_minmax, lag_columns, minmax_scale, series_window

# Input features, target, lookback and split ratio of the sequence model.
SEQ_FEATURES = ("request_count", "total_bytes", "prev_count", "hour_sin", "hour_cos")
SEQ_TARGET = "request_count"
SEQ_LENGTH = 6
SPLIT_RATIO = 0.8


def validation_size(n: F.Column) -> F.Column:
    """``max(int(n * r), 10)`` with r = 0.1 when n > 1000 else 0.2."""
    r = F.when(n > 1000, F.lit(0.1)).otherwise(F.lit(0.2))
    return F.greatest(F.floor(n * r), F.lit(10)).cast("bigint")


def sequence_frame(df: DataFrame, order: str = "hour_timestamp", keys: Sequence[str] = (),
                   features: Sequence[str] = SEQ_FEATURES, target: str = SEQ_TARGET, L: int = SEQ_LENGTH,
                   fit_on: str = "all", ratio: float = SPLIT_RATIO) -> tuple[DataFrame, list[str]]:
    """Scaled lookback rows with ``seq_idx``, ``n_seq``, ``split`` and a validation flag."""
    keys = list(keys)
    if "hour_sin" in features and "hour_sin" not in df.columns:
        df = df.transform(with_cyclical_hour)
    sc = minmax_scale(df, list(features), fit_on=fit_on, keys=keys)
    scaled = [f"{f}_mm" for f in features]
    lagged, xcols = lag_columns(sc, order, scaled, L, keys)
    seqs = lagged.filter(" and ".join(f"`{c}` is not null" for c in xcols))
    w = series_window(order, keys)
    wall = Window.partitionBy(*keys) if keys else Window.partitionBy()
    seqs = (seqs.withColumn("seq_idx", (F.row_number().over(w) - 1).cast("bigint"))
                .withColumn("n_seq", F.count(F.lit(1)).over(wall)))
    n_tr = F.floor(F.lit(ratio) * F.col("n_seq")).cast("bigint")
    seqs = (seqs.withColumn("n_train_seq", n_tr)
                .withColumn("split", F.when(F.col("seq_idx") < F.col("n_train_seq"), "train").otherwise("test"))
                .withColumn("is_val", F.col("seq_idx") >= F.col("n_train_seq") - validation_size(F.col("n_train_seq"))))
    return seqs, xcols


def _gbt_candidate(seqs: DataFrame, xcols: list[str], y: str, seed: int = 42):
    """Spark ML gradient-boosted trees on the flattened window: validation MSE of a
    fit on the fit rows, and the fit on all train rows, for when the candidate wins."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    def pipe():
        return Pipeline(stages=[VectorAssembler(inputCols=xcols, outputCol="_x"),
                                GBTRegressor(featuresCol="_x", labelCol=y, predictionCol="_p", seed=seed)])
    train = seqs.filter(F.col("split") == "train")
    fit_rows, val_rows = train.filter(~F.col("is_val")), train.filter(F.col("is_val"))
    val = pipe().fit(fit_rows).transform(val_rows)
    mse = val.agg(F.avg((F.col(y) - F.col("_p")) ** 2)).first()[0]
    return mse, lambda: pipe().fit(train)


def fit_sequence_regressor(df: DataFrame, order: str = "hour_timestamp", keys: Sequence[str] = (),
                           features: Sequence[str] = SEQ_FEATURES, target: str = SEQ_TARGET,
                           L: int = SEQ_LENGTH, ridges: Sequence[float] = RIDGE_GRID,
                           l1_ratios: Sequence[float] = L1_RATIOS, fit_on: str = "all", with_gbt: bool = False,
                           stage=None) -> tuple[DataFrame, DataFrame]:
    """Fit per series; returns ``(models, test_predictions)``.

    Candidates: ridge / elastic-net / lasso regressions over a strength grid (all series
    at once, from Gram statistics) and, with
    ``with_gbt`` for the single global series, a gradient-boosted tree model (about
    10 s more per fit on local[8]); the lowest validation MSE on the train tail wins. ``models`` has ``model`` ('linear'/'gbt'), ``ridge``, ``l1_ratio``,
    ``val_mse``. ``test_predictions``: keys, order, actual target, ``prediction``
    (inverse-scaled).
    """
    keys = list(keys)
    seqs, xcols = sequence_frame(df, order, keys, features, target, L, fit_on)
    if stage is not None:
        seqs = stage(seqs)
    y = f"{target}_mm"
    train = F.col("split") == "train"
    models = fit_ridge_validated(seqs, keys, xcols, y, fit_mask=train & ~F.col("is_val"),
                                 val_mask=train & F.col("is_val"), ridges=ridges, l1_ratios=l1_ratios)
    models = models.withColumn("model", F.lit("linear"))
    if stage is not None:
        models = stage(models)      # read for the choice, the scores and by the caller
    test = seqs.filter(~train)
    lo, hi = F.col(f"{target}__min"), F.col(f"{target}__max")
    if keys:
        test = test.join(models.select(*keys, "coef"), on=keys, how="left")
        pred = inverse_minmax(lsq.dot([f"`{c}`" for c in xcols], "coef"), lo, hi)
        return models, test.select(*keys, order, F.col(target).cast("double").alias("actual"),
                                   pred.alias("prediction"))
    ridge_row = models.first() if with_gbt else None
    ridge_mse = ridge_row["val_mse"] if ridge_row is not None else None
    gbt_mse, gbt_fit = _gbt_candidate(seqs, xcols, y) if with_gbt else (None, None)
    if gbt_mse is not None and (ridge_mse is None or gbt_mse < ridge_mse):
        models = models.select(F.lit("gbt").alias("model"), F.lit(None).cast("double").alias("ridge"),
                               F.lit(None).cast("double").alias("l1_ratio"), F.lit(gbt_mse).alias("val_mse"),
                               "n_fit", "n_val",
                               F.lit(None).cast("array<double>").alias("coef"))
        scored = gbt_fit().transform(test)
        pred = inverse_minmax(F.col("_p"), lo, hi)
        return models, scored.select(order, F.col(target).cast("double").alias("actual"), pred.alias("prediction"))
    test = test.select("*", models.select(F.col("coef")).scalar().alias("coef"))
    pred = inverse_minmax(lsq.dot([f"`{c}`" for c in xcols], "coef"), lo, hi)
    return models, test.select(order, F.col(target).cast("double").alias("actual"), pred.alias("prediction"))
