"""Registered queries for series features, the seasonal, sequence and hybrid
forecasters, and the leaderboard (W4-W11, J1-J3, M7-M13, P8-P11, C1-C3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import improvement_pct, quality_grade
from ..operators import evaluate, hybrid, leaderboard, seasonal, sequence, series
from ..sources import files
from . import common
from . import oracle_sql as O
from .model_queries import LR_CTES, lr_predictions
from .registry import register

ORDER = "hour_timestamp"
Y = "request_count"
EXOG = ["total_bytes", "prev_count"]


def forecast_inputs(spark, sf, keys=()):
    """Hourly features, 80/20 split, exogenous inputs z-scored over all rows. Derived
    cheaply from the materialised feature stage; the seasonal design built on it is
    the table that gets staged."""
    # keyed series have empty hours; filled, their seasonal lags are hours and not rows
    s = series.chrono_split(common.features_stage(spark, sf, keys, fill_gaps=bool(keys)), ORDER, keys=keys)
    return series.zscore_scale(s, EXOG, keys=keys)


def seasonal_fit(spark, sf, keys=()):
    """One search per application, input and keys: the grid search, its forecasts and residuals, the hybrid and the
    metric table all read the same fit."""
    data = forecast_inputs(spark, sf, keys)
    fit = seasonal.fit_seasonal(data, ORDER, Y, [f"{e}_z" for e in EXOG], keys=keys, stage=common.stage_chain(spark, "seasonal", sf, keys),
                                carry=["prev_count__mean", "prev_count__std"])
    return data, fit


# prev_count is the previous row's count: in recursive mode it is filled from the forecast
LAG_INPUTS = {"prev_count_z": (1, "prev_count__mean", "prev_count__std")}


def _actual(data: DataFrame, fit) -> DataFrame:
    a = data.filter(F.col("split") == "test")
    if seasonal.SERIES in fit.keys:
        a = a.withColumn(seasonal.SERIES, F.lit(0))
    return a.select(*fit.keys, ORDER, Y)


def hybrid_run(spark, sf, keys=()):
    """Seasonal fit -> forecast -> residuals -> corrector -> recursive correction -> hybrid."""
    data, fit = seasonal_fit(spark, sf, keys)
    stage = common.stage_chain(spark, "hybrid", sf, keys)
    fc = stage(seasonal.seasonal_forecast(fit, Y))
    resid = seasonal.seasonal_residuals(fit)
    n_train = data.groupBy(*keys).agg(F.max("n_train").alias("n_train"))
    if seasonal.SERIES in fit.keys:
        n_train = n_train.withColumn(seasonal.SERIES, F.lit(0))
    models = stage(hybrid.fit_residual_corrector(resid, n_train, ORDER, fit.keys))
    horizon = fc.groupBy(*fit.keys).agg(F.count(F.lit(1)).cast("int").alias("steps"))
    corr = stage(hybrid.recursive_forecast(models, horizon, fit.keys))
    hyb = hybrid.hybrid_forecast(fc, corr, fit.keys)
    joined = evaluate.align_forecast(_actual(data, fit), hyb, [*fit.keys, ORDER])
    return data, fit, fc, models, corr, joined


def sequence_fit(spark, sf):
    """Models and test predictions of the sequence regressor with its tree candidate, fitted once per application and input."""
    made: list[tuple[DataFrame, DataFrame]] = []

    def part(i):
        if not made:
            made.append(sequence.fit_sequence_regressor(common.features_stage(spark, sf), ORDER, stage=common.stage_chain(spark, "sequence", sf), with_gbt=True))
        return made[0][i]
    return tuple(files.materialize(spark, lambda i=i: part(i), common.stage_path(spark, name, sf))
                 for i, name in enumerate(("sequence-models", "sequence-predictions")))


# ---- series features with SQL oracles -------------------------------------------------

@register("seasonal_difference", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, request_count, CAST(request_count - lag(request_count, 1) OVER w "
    "- lag(request_count, 24) OVER w + lag(request_count, 25) OVER w AS DOUBLE) AS request_count_diff "
    "FROM features WINDOW w AS (ORDER BY hour_timestamp)")))
def q_seasonal_difference(spark, sf):
    """(1 - B)(1 - B^24) applied to the hourly count."""
    f = common.features(spark, sf)
    return series.seasonal_difference(f, ORDER, Y, 1, 1, 24).select(ORDER, Y, "request_count_diff")


@register("lag_matrix", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, request_count, " + ", ".join(
        f"lag(request_count, {k}) OVER w AS request_count_lag{k}" for k in (1, 2, 24, 25, 26))
    + " FROM features WINDOW w AS (ORDER BY hour_timestamp)")))
def q_lag_matrix(spark, sf):
    """All seasonal AR lags i + 24 j (i <= 2, j <= 1) as columns, one window."""
    return series.lag_matrix(common.features(spark, sf), ORDER, Y, 2, 1, 24).select(
        ORDER, Y, *[f"request_count_lag{k}" for k in series.ar_lags(2, 1, 24)])


@register("lookback_sequences", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT t.hour_timestamp, CAST(s.rn - t.rn + 6 AS INTEGER) AS pos, s.request_count, s.total_bytes, "
    "s.prev_count, t.request_count AS target FROM "
    "(SELECT *, row_number() OVER (ORDER BY hour_timestamp) AS rn FROM features) t JOIN "
    "(SELECT *, row_number() OVER (ORDER BY hour_timestamp) AS rn FROM features) s "
    "ON s.rn BETWEEN t.rn - 6 AND t.rn - 1 WHERE t.rn > 6")))
def q_lookback_sequences(spark, sf):
    """Six preceding hours per row as an array of structs, shown exploded."""
    seqs = series.lookback_sequences(common.features(spark, sf), ORDER, [Y, "total_bytes", "prev_count"], Y, 6)
    e = seqs.select(ORDER, "target", F.posexplode("seq").alias("pos", "s"))
    return e.select(ORDER, "pos", "s.request_count", "s.total_bytes", "s.prev_count", "target")


@register("adaptive_lookback", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, O.FEATURES_KEYED, body=(
    "SELECT event_type, n_train, CAST(greatest(least(6, n_train // 10), 3) AS INTEGER) AS lookback FROM ("
    "SELECT event_type, CAST(floor(0.8 * count(*)) AS BIGINT) AS n_train FROM features_k GROUP BY event_type)")))
def q_adaptive_lookback(spark, sf):
    """Residual lookback max(min(6, n_train div 10), 3) per event-type series."""
    s = series.chrono_split(common.features(spark, sf, ["event_type"]), ORDER, keys=["event_type"])
    n = s.groupBy("event_type").agg(F.max("n_train").alias("n_train"))
    return n.select("event_type", "n_train", series.adaptive_lookback(F.col("n_train")).alias("lookback"))


@register("minmax_scale", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, " + ", ".join(
        f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 ELSE ({c} - min({c}) OVER ()) "
        f"/ (max({c}) OVER () - min({c}) OVER ()) END, 6) AS {c}_mm" for c in (Y, *EXOG)) + " FROM features")))
def q_minmax_scale(spark, sf):
    """Independent 0-1 scaling fitted on all rows."""
    f = series.minmax_scale(common.features(spark, sf), [Y, *EXOG])
    return common.rounded(f.select(ORDER, *[f"{c}_mm" for c in (Y, *EXOG)]))


@register("zscore_scale", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_samp({c}) OVER () = 0 THEN 1 "
        f"ELSE stddev_samp({c}) OVER () END, 6) AS {c}_z" for c in EXOG) + " FROM features")))
def q_zscore_scale(spark, sf):
    """Exogenous inputs standardised with the sample std, zero std -> 1."""
    f = series.zscore_scale(common.features(spark, sf), EXOG)
    return common.rounded(f.select(ORDER, *[f"{c}_z" for c in EXOG]))


@register("standard_scale_clip", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, round(greatest(-3.0, least(3.0, (r - avg(r) OVER ()) / CASE WHEN stddev_pop(r) OVER () = 0 "
    "THEN 1 ELSE stddev_pop(r) OVER () END)), 6) + 0.0 AS change_sc FROM "
    "(SELECT hour_timestamp, CAST(request_count - prev_count AS DOUBLE) AS r FROM features)")))
def q_standard_scale_clip(spark, sf):
    """Hour-over-hour change scaled with the population std and clipped to +-3."""
    f = common.features(spark, sf).select(ORDER, (F.col(Y) - F.col("prev_count")).cast("double").alias("change"))
    return common.rounded(series.standard_scale_clip(f, "change", 3.0).select(ORDER, "change_sc"))


@register("drop_burn_in", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY hour_timestamp) AS rn FROM features) t "
    "WHERE rn > 24")))
def q_drop_burn_in(spark, sf):
    """The hourly series without its first 24 rows."""
    f = series.drop_burn_in(common.features(spark, sf), ORDER, 24)
    w = series.series_window(ORDER)
    return f.withColumn("rn", (F.row_number().over(w) + F.lit(24)).cast("bigint"))


@register("candidate_grid", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, body=(
    "SELECT event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY p, d, q, sp, sd, sq) - 1 "
    "AS INTEGER) AS cand_idx, p, d, q, sp, sd, sq, 24 AS m FROM (SELECT DISTINCT event_type FROM hourly_k) s, "
    "(SELECT CAST(p AS INTEGER) p, CAST(d AS INTEGER) d, CAST(q AS INTEGER) q, CAST(sp AS INTEGER) sp, "
    "CAST(sd AS INTEGER) sd, CAST(sq AS INTEGER) sq FROM range(3) a(p), range(2) b(d), range(3) c(q), "
    "range(2) e(sp), range(2) f(sd), range(2) g(sq)) g")))
def q_candidate_grid(spark, sf):
    """144 seasonal candidates for every event-type series."""
    keys = common.hourly(spark, sf, ["event_type"]).select("event_type").distinct()
    return seasonal.candidate_grid(keys)


@register("align_forecast", O.with_ctes(*LR_CTES, body=(
    "SELECT f.hour_timestamp, f.request_count, f.total_bytes, round(p.prediction, 6) AS prediction "
    "FROM features f JOIN pred p ON f.hour_timestamp = p.hour_timestamp")))
def q_align_forecast(spark, sf):
    """Attach the linear model's forecasts to the observed hours by timestamp."""
    pred, _ = lr_predictions(spark, sf)
    actual = common.features(spark, sf).select(ORDER, Y, "total_bytes")
    return common.rounded(evaluate.align_forecast(actual, pred.select(ORDER, "prediction"), [ORDER]))


# ---- forecasters: no SQL oracle (numeric fits), own tests ------------------------------

@register("seasonal_grid_search")
def q_seasonal_grid_search(spark, sf):
    """AIC of all 144 candidates on the hourly series, best flagged (M8)."""
    _, fit = seasonal_fit(spark, sf)
    best = fit.best.select("cand_idx", F.lit(True).alias("is_best"))
    out = fit.candidates.join(best, on="cand_idx", how="left").select(
        "cand_idx", *seasonal.GRID_ORDER, "n_obs", F.round("aic", 4).alias("aic"),
        F.coalesce("is_best", F.lit(False)).alias("is_best"))
    return out


@register("seasonal_forecast")
def q_seasonal_forecast(spark, sf):
    """Multi-step forecast of the test hours with the winning candidate (M9)."""
    data, fit = seasonal_fit(spark, sf)
    fc = seasonal.seasonal_forecast(fit, Y)
    j = evaluate.align_forecast(_actual(data, fit), fc, [*fit.keys, ORDER])
    return common.rounded(seasonal.strip_series(j))


@register("seasonal_forecast_recursive")
def q_seasonal_forecast_recursive(spark, sf):
    """Multi-step forecast without test-time inputs: prev_count from the forecast, total_bytes at
    its mean (M9, exog_mode='recursive')."""
    data, fit = seasonal_fit(spark, sf)
    fc = seasonal.seasonal_forecast(fit, Y, exog_mode="recursive", lag_inputs=LAG_INPUTS)
    j = evaluate.align_forecast(_actual(data, fit), fc, [*fit.keys, ORDER])
    return common.rounded(seasonal.strip_series(j))


@register("seasonal_residuals")
def q_seasonal_residuals(spark, sf):
    """One-step in-sample residuals after a 24-hour burn-in."""
    _, fit = seasonal_fit(spark, sf)
    return common.rounded(seasonal.strip_series(seasonal.seasonal_residuals(fit)))


@register("sequence_regressor")
def q_sequence_regressor(spark, sf):
    """Six-hour, five-feature lookback regressor, linear and tree candidates: test metrics and what was chosen (M7)."""
    models, pred = sequence_fit(spark, sf)
    m = evaluate.regression_metrics(pred, "actual", "prediction")
    chosen = models.select(F.struct("model", "ridge", "l1_ratio").alias("c")).scalar()
    return common.rounded(m.select("*", *[chosen.getField(c).alias(c) for c in ("model", "ridge", "l1_ratio")]))


@register("residual_corrector")
def q_residual_corrector(spark, sf):
    """Ridge autoregression on scaled seasonal residuals: lookback, ridge, coefficients."""
    _, fit, _, models, _, _ = hybrid_run(spark, sf)
    return seasonal.strip_series(models.select(*fit.keys, "lookback", "ridge", "l1_ratio", "n_fit", "n_val",
                                               F.transform("coef", lambda c: F.round(c, 6)).alias("coef")))


@register("recursive_forecast")
def q_recursive_forecast(spark, sf):
    """Residual correction per test step: recursive, inverse-scaled, decayed."""
    *_, corr, _ = hybrid_run(spark, sf)
    return common.rounded(seasonal.strip_series(corr))


@register("hybrid_forecast")
def q_hybrid_forecast(spark, sf):
    """Seasonal forecast + residual correction against the observed test hours."""
    *_, joined = hybrid_run(spark, sf)
    return common.rounded(seasonal.strip_series(joined))


@register("hybrid_forecast_sample")
def q_hybrid_forecast_sample(spark, sf):
    """First ten test hours: actual, seasonal and correction components, hybrid, difference."""
    *_, joined = hybrid_run(spark, sf)
    return common.rounded(evaluate.forecast_sample(joined, ORDER, Y, ["seasonal_forecast", "correction"],
                                                   "hybrid_forecast", 10))


# ---- metrics of all four models and the leaderboard -----------------------------------

def _lr_record(spark: SparkSession, sf: str) -> DataFrame:
    pred, _ = lr_predictions(spark, sf)
    # record shapes as written by each model: the linear model's has no mse
    return common.staged(evaluate.regression_metrics(pred, Y, "prediction").select(
        F.lit("Linear Regression").alias("model"), "rmse", "mae", "r2", "mape"))


def _sequence_record(spark: SparkSession, sf: str) -> DataFrame:
    _, spred = sequence_fit(spark, sf)
    return common.staged(evaluate.regression_metrics(spred, "actual", "prediction").select(
        F.lit("Sequence Regressor").alias("model"), "mse", "rmse", "mae", "r2", "mape"))


def _seasonal_records(spark: SparkSession, sf: str) -> DataFrame:
    _, fit, fc, _, _, joined = hybrid_run(spark, sf)
    best = seasonal.order_strings(fit.best).select("order", "seasonal_order", "aic")
    # both forecasts scored in one pass: long form (model, actual, forecast) grouped by model
    long = joined.select(Y, F.explode(F.array(
        F.struct(F.lit("Seasonal").alias("model"), F.col("seasonal_forecast").alias("yhat")),
        F.struct(F.lit("Hybrid").alias("model"), F.col("hybrid_forecast").alias("yhat")))).alias("f"))
    both = common.staged(evaluate.regression_metrics(long.select(Y, "f.model", "f.yhat"), Y, "yhat",
                                                     keys=["model"]))
    sa = both.filter(F.col("model") == "Seasonal").select("*", best.select(F.struct("*")).scalar().alias("b"))
    sarima = sa.select("model", "mse", "rmse", "mae", "r2", "mape",
                       F.col("b.order").alias("order"), F.col("b.seasonal_order").alias("seasonal_order"),
                       F.col("b.aic").alias("aic"))
    hy = both.filter(F.col("model") == "Hybrid").select("model", "mse", "rmse", "mae", "r2", "mape")
    hy = hy.select("*", sarima.select(F.struct("*")).scalar().alias("s"))
    hy = hy.select("model", "mse", "rmse", "mae", "r2", "mape",
                   F.col("s.order").alias("sarima_order"), F.col("s.seasonal_order").alias("sarima_seasonal_order"),
                   F.col("s.aic").alias("sarima_aic"),
                   improvement_pct(F.col("s.rmse"), F.col("rmse")).alias("improvement_over_sarima_pct"))
    return common.staged(leaderboard.union_metrics([sarima, hy]))


def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metric records of the four forecasters on one hourly series, one row per model.

    The three model branches are independent chains of small jobs; they are submitted
    from three driver threads so the scheduler interleaves their tasks instead of
    leaving cores idle between jobs. The shared feature stage is materialised first.
    """
    from concurrent.futures import ThreadPoolExecutor

    common.features_stage(spark, sf)
    with ThreadPoolExecutor(max_workers=3) as pool:
        futures = [pool.submit(fn, spark, sf) for fn in (_lr_record, _sequence_record, _seasonal_records)]
        parts = [f.result() for f in futures]
    return leaderboard.union_metrics(parts)


def metrics_table(spark: SparkSession, sf: str, force: bool = False) -> DataFrame:
    """``model_metrics`` materialised once per input folder and application (S10): the
    leaderboard queries of one session reuse it; a new session recomputes."""
    app = spark.sparkContext.applicationId
    return files.materialize(spark, lambda: model_metrics(spark, sf), common.stage_path(spark, "metrics", sf),
                             force=force)


@register("union_metrics")
def q_union_metrics(spark, sf):
    """The four metric records in one long table, tagged by model (J3, S3 read shape)."""
    return common.rounded(metrics_table(spark, sf))


@register("leaderboard")
def q_leaderboard(spark, sf):
    """Metric rows x model columns."""
    return common.rounded(leaderboard.leaderboard(metrics_table(spark, sf)))


@register("metric_winners")
def q_metric_winners(spark, sf):
    """Best model per metric: lowest rmse, mae, mape; highest r2; ties by model order."""
    return common.rounded(leaderboard.metric_winners(metrics_table(spark, sf)))


@register("overall_winner")
def q_overall_winner(spark, sf):
    """Model with most metric wins, ties by model order."""
    return leaderboard.overall_winner(leaderboard.metric_winners(metrics_table(spark, sf)))


@register("model_grades")
def q_model_grades(spark, sf):
    """R2 grade of each of the four models (P8 over all models)."""
    m = metrics_table(spark, sf)
    return common.rounded(m.select("model", "r2", quality_grade(F.col("r2")).alias("grade")))


@register("improvement_pct")
def q_improvement_pct(spark, sf):
    """Hybrid RMSE improvement over the seasonal model, in percent."""
    m = metrics_table(spark, sf)
    return common.rounded(m.filter(F.col("model") == "Hybrid").select(
        "model", "improvement_over_sarima_pct"))


@register("quality_grade", O.with_ctes(*LR_CTES, body=(
    "SELECT 'Linear Regression' AS model, round(r2, 6) AS r2, CASE WHEN r2 > 0.80 THEN 'EXCELLENT' "
    "WHEN r2 > 0.50 THEN 'GOOD' ELSE 'NEEDS IMPROVEMENT' END AS grade FROM ("
    "SELECT 1 - sum((request_count - prediction) * (request_count - prediction)) "
    "/ (count(*) * var_pop(request_count)) AS r2 FROM pred)")))
def q_quality_grade(spark, sf):
    """Grade of the linear model's R2 with strict thresholds."""
    pred, _ = lr_predictions(spark, sf)
    m = evaluate.regression_metrics(pred, Y, "prediction")
    return common.rounded(m.select(F.lit("Linear Regression").alias("model"), "r2",
                                   quality_grade(F.col("r2")).alias("grade")))


@register("seasonal_grid_search_by_type")
def q_seasonal_grid_search_by_type(spark, sf):
    """The 144-candidate search for every event-type series at once; winner per series (M8, keyed)."""
    _, fit = seasonal_fit(spark, sf, ["event_type"])
    return seasonal.order_strings(fit.best).select("event_type", "cand_idx", "order", "seasonal_order", "n_obs",
                                                   F.round("aic", 4).alias("aic"))


@register("hybrid_forecast_by_type")
def q_hybrid_forecast_by_type(spark, sf):
    """Seasonal + residual-corrected forecast and its metrics for every event-type series (M8-M13, keyed)."""
    *_, joined = hybrid_run(spark, sf, ["event_type"])
    seas = evaluate.regression_metrics(joined, Y, "seasonal_forecast", keys=["event_type"])
    hyb = evaluate.regression_metrics(joined, Y, "hybrid_forecast", keys=["event_type"])
    out = hyb.alias("h").join(seas.select("event_type", F.col("rmse").alias("seasonal_rmse")), "event_type")
    return common.rounded(out.withColumn("improvement_over_sarima_pct",
                                         improvement_pct(F.col("seasonal_rmse"), F.col("rmse"))))
