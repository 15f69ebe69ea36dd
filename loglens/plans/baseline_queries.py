"""Registered queries of the comparison tables and of small configurations of the forecasters,
each with SQL that states the same result (J3, C1-C3, P8, P9, M8-M10, M12, P11).

The comparison tables use four forecasters that SQL can state exactly: the linear model, the
previous hour, the same hour of the day before (24 rows back) and the train mean of the hour of
day. Constants are written out on the SQL side, so that an error in the library's would show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import improvement_pct, quality_grade
from ..operators import evaluate, hybrid, leaderboard, linear, seasonal, series, traffic
from ..session import scratch_path
from ..sources import files
from . import common
from . import oracle_sql as O
from .forecast_queries import EXOG, ORDER, Y, _actual, forecast_inputs
from .model_queries import LR_CTES, lr_inputs, lr_predictions
from .registry import register

MODELS = {"Linear Regression": "linear_regression", "Previous Hour": "previous_hour", "Day Before": "day_before",
          "Hour Mean": "hour_mean"}


def baseline_forecasts(spark, sf) -> DataFrame:
    """hour_timestamp, request_count, model, prediction on the test hours."""
    data = lr_inputs(spark, sf)
    before = F.lag(Y, 24).over(series.series_window(ORDER))
    hour = Window.partitionBy(F.hour(ORDER))
    mean = F.avg(F.when(F.col("split") == "train", F.col(Y))).over(hour)
    own = data.select(ORDER, Y, "split", F.col("prev_count").cast("double").alias("p1"), before.cast("double").alias("p2"), mean.alias("p3")).filter("split = 'test'")
    long = own.select(ORDER, Y, F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("prediction")) for m, c in zip(list(MODELS)[1:], ("p1", "p2", "p3"))])).alias("x"))
    linear, _ = lr_predictions(spark, sf)
    return long.select(ORDER, Y, "x.*").unionByName(linear.select(ORDER, Y, F.lit("Linear Regression").alias("model"), "prediction"))


def baseline_records(spark, sf) -> DataFrame:
    """One metric record a model, each written as JSON and read back typed (S3), then in one table."""
    metrics = common.staged(evaluate.regression_metrics(baseline_forecasts(spark, sf), Y, "prediction", keys=["model"]))
    parts = []
    for model, name in MODELS.items():
        own = metrics.filter(F.col("model") == model)
        own = own.select("rmse", "mae", "r2", "mape") if model == "Linear Regression" else own.select("mse", "rmse", "mae", "r2", "mape")
        path = files.write_metrics(own, scratch_path(spark, f"record-{name}"))
        parts.append(files.read_metrics(spark, path).select(F.lit(model).alias("model"), "mse", "rmse", "mae", "r2", "mape"))
    return leaderboard.union_metrics(parts)


_RECORDS = """long AS (
  SELECT hour_timestamp, request_count, 'Linear Regression' AS model, prediction FROM pred
  UNION ALL SELECT hour_timestamp, request_count, 'Previous Hour', CAST(prev_count AS DOUBLE) FROM split WHERE split = 'test'
  UNION ALL SELECT hour_timestamp, request_count, 'Day Before', d FROM (
    SELECT *, CAST(lag(request_count, 24) OVER (ORDER BY hour_timestamp) AS DOUBLE) AS d FROM split) WHERE split = 'test'
  UNION ALL SELECT s.hour_timestamp, s.request_count, 'Hour Mean', m.p FROM split s LEFT JOIN (
    SELECT hour(hour_timestamp) AS h, avg(request_count) AS p FROM split WHERE split = 'train' GROUP BY 1) m
    ON hour(s.hour_timestamp) = m.h WHERE s.split = 'test'),
records AS (
  SELECT model, avg((request_count - prediction) ** 2) AS mse, sqrt(avg((request_count - prediction) ** 2)) AS rmse,
    avg(abs(request_count - prediction)) AS mae,
    1 - sum((request_count - prediction) ** 2) / (count(*) * var_pop(request_count)) AS r2,
    coalesce(avg(CASE WHEN request_count <> 0 THEN abs(request_count - prediction) / request_count END) * 100, 'NaN'::DOUBLE) AS mape
  FROM long GROUP BY model),
cells AS (
  SELECT model, metric, value, CASE model WHEN 'Linear Regression' THEN 1 WHEN 'Previous Hour' THEN 2 WHEN 'Day Before' THEN 3 ELSE 4 END AS place FROM (
    SELECT model, 'rmse' AS metric, rmse AS value FROM records UNION ALL SELECT model, 'mae', mae FROM records
    UNION ALL SELECT model, 'r2', r2 FROM records UNION ALL SELECT model, 'mape', mape FROM records)),
winners AS (
  SELECT metric, model AS winner, value, place FROM (
    SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value IS NULL OR isnan(value), CASE metric WHEN 'r2' THEN -value ELSE value END, place) AS n FROM cells) WHERE n = 1)"""
_CTES = (*LR_CTES, _RECORDS)


@register("baseline_records", O.with_ctes(*_CTES, body=(
    "SELECT model, CASE WHEN model <> 'Linear Regression' THEN round(mse, 6) END AS mse, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2, round(mape, 6) AS mape FROM records")))
def q_baseline_records(spark, sf):
    """Metric records of four forecasters, through JSON, in one long table."""
    return common.rounded(baseline_records(spark, sf).select("model", "mse", "rmse", "mae", "r2", "mape"))


@register("baseline_leaderboard", O.with_ctes(*_CTES, body=(
    "SELECT metric, " + ", ".join(f"round(max(value) FILTER (model = '{m}'), 6) AS {c}" for m, c in
                                  (("Linear Regression", "linear_regression"), ("Previous Hour", "previous_hour"), ("Day Before", "day_before"), ("Hour Mean", "hour_mean")))
    + " FROM cells GROUP BY metric")))
def q_baseline_leaderboard(spark, sf):
    """Metric rows x model columns of the four forecasters."""
    return common.rounded(leaderboard.leaderboard(baseline_records(spark, sf), MODELS))


@register("baseline_metric_winners", O.with_ctes(*_CTES, body="SELECT metric, winner, round(value, 6) AS value FROM winners"))
def q_baseline_metric_winners(spark, sf):
    """Best of the four forecasters per metric."""
    return common.rounded(leaderboard.metric_winners(baseline_records(spark, sf), MODELS))


@register("baseline_overall_winner", O.with_ctes(*_CTES, body=(
    "SELECT winner AS model, count(*) AS wins, 4 AS n_metrics FROM winners GROUP BY winner, place ORDER BY count(*) DESC, place LIMIT 1")))
def q_baseline_overall_winner(spark, sf):
    """The forecaster with most metric wins."""
    return leaderboard.overall_winner(leaderboard.metric_winners(baseline_records(spark, sf), MODELS), MODELS)


@register("baseline_grades", O.with_ctes(*_CTES, body=(
    "SELECT model, round(r2, 6) AS r2, CASE WHEN r2 > 0.80 THEN 'EXCELLENT' WHEN r2 > 0.50 THEN 'GOOD' ELSE 'NEEDS IMPROVEMENT' END AS grade FROM records")))
def q_baseline_grades(spark, sf):
    """R2 grade of each of the four forecasters."""
    return common.rounded(baseline_records(spark, sf).select("model", "r2", quality_grade(F.col("r2")).alias("grade")))


@register("baseline_improvement", O.with_ctes(*_CTES, body=(
    "SELECT r.model, round((b.rmse - r.rmse) / b.rmse * 100, 6) AS improvement_pct FROM records r, records b "
    "WHERE b.model = 'Day Before' AND r.model <> 'Day Before'")))
def q_baseline_improvement(spark, sf):
    """RMSE improvement of each forecaster over the day before, in percent."""
    records = common.staged(baseline_records(spark, sf))
    base = records.filter("model = 'Day Before'").select("rmse").scalar()
    return common.rounded(records.filter("model <> 'Day Before'").select("model", improvement_pct(base, F.col("rmse")).alias("improvement_pct")))


# ---- the seasonal model with one candidate: regression on the exogenous inputs alone ---

ONE = {k: (0,) for k in seasonal.GRID_ORDER}


def exogenous_fit(spark, sf):
    data = forecast_inputs(spark, sf)
    return data, seasonal.fit_seasonal(data, ORDER, Y, [f"{e}_z" for e in EXOG], stage=common.staged, grid=ONE, long_ar=1)


_EXOG = """z AS (
  SELECT *, (total_bytes - avg(total_bytes) OVER ()) / CASE WHEN stddev_samp(total_bytes) OVER () = 0 THEN 1 ELSE stddev_samp(total_bytes) OVER () END AS z1,
            (prev_count - avg(prev_count) OVER ()) / CASE WHEN stddev_samp(prev_count) OVER () = 0 THEN 1 ELSE stddev_samp(prev_count) OVER () END AS z2 FROM split),
c AS (
  SELECT count(*) AS n, avg(z1) AS m1, avg(z2) AS m2, avg(request_count) AS my, covar_pop(z1, z1) AS s11, covar_pop(z1, z2) AS s12, covar_pop(z2, z2) AS s22,
         covar_pop(z1, request_count) AS t1, covar_pop(z2, request_count) AS t2 FROM z WHERE split = 'train'),
b AS (SELECT *, (t1 * s22 - t2 * s12) / (s11 * s22 - s12 * s12) AS b1, (t2 * s11 - t1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c),
f AS (SELECT z.*, my + b1 * (z1 - m1) + b2 * (z2 - m2) AS yhat FROM z, b)"""


@register("exogenous_fit", O.with_ctes(*O.FEATURE_CTES, O.SPLIT, _EXOG, body=(
    "SELECT 0 AS cand_idx, count(*) AS n_obs, round(count(*) * ln(sum((request_count - yhat) ** 2) / count(*)) + 2 * (3 + 1), 4) AS aic FROM f WHERE split = 'train'")))
def q_exogenous_fit(spark, sf):
    """AIC of the candidate without lags (M8)."""
    _, fit = exogenous_fit(spark, sf)
    return fit.best.select("cand_idx", "n_obs", F.round("aic", 4).alias("aic"))


@register("exogenous_forecast", O.with_ctes(*O.FEATURE_CTES, O.SPLIT, _EXOG, body=(
    "SELECT hour_timestamp, request_count, row_number() OVER (ORDER BY hour_timestamp) - 1 AS step, round(yhat, 6) AS seasonal_forecast FROM f WHERE split = 'test'")))
def q_exogenous_forecast(spark, sf):
    """Its forecast of the test hours (M9)."""
    data, fit = exogenous_fit(spark, sf)
    fc = seasonal.seasonal_forecast(fit, Y)
    return common.rounded(seasonal.strip_series(evaluate.align_forecast(_actual(data, fit), fc, [*fit.keys, ORDER])))


@register("exogenous_residuals", O.with_ctes(*O.FEATURE_CTES, O.SPLIT, _EXOG, body=(
    "SELECT hour_timestamp, round(request_count - yhat, 6) AS residual FROM f WHERE split = 'train' AND row_idx >= 24")))
def q_exogenous_residuals(spark, sf):
    """Its residuals on all train hours after the first 24."""
    _, fit = exogenous_fit(spark, sf)
    return common.rounded(seasonal.strip_series(seasonal.seasonal_residuals(fit)).select(ORDER, "residual"))


# ---- the recursion of the residual corrector with weights that SQL can state -----------

@register("lag_weight_recursion", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, O.FEATURES_KEYED, """g AS (
  SELECT event_type, hour_timestamp, CAST(request_count - prev_count AS DOUBLE) AS x FROM features_k),
s AS (
  SELECT *, avg(x) OVER w AS mu, CASE WHEN stddev_pop(x) OVER w = 0 THEN 1 ELSE stddev_pop(x) OVER w END AS sd FROM g WINDOW w AS (PARTITION BY event_type)),
v AS (
  SELECT *, greatest(-3.0, least(3.0, (x - mu) / sd)) AS a, row_number() OVER (PARTITION BY event_type ORDER BY hour_timestamp DESC) AS back FROM s),
l AS (
  SELECT *, lag(a, 1) OVER w AS a1, lag(a, 2) OVER w AS a2, lag(a, 3) OVER w AS a3 FROM v WINDOW w AS (PARTITION BY event_type ORDER BY hour_timestamp)),
k AS (
  SELECT event_type, any_value(mu) AS mu, any_value(sd) AS sd, corr(a, a1) AS k1, corr(a, a2) / 2 AS k2, corr(a, a3) / 3 AS k3,
         max(a) FILTER (back = 1) AS w1, max(a) FILTER (back = 2) AS w2, max(a) FILTER (back = 3) AS w3 FROM l GROUP BY event_type)""",
                                                body="SELECT * FROM (" + """
  WITH RECURSIVE r AS (
    SELECT event_type, 0 AS step, mu, sd, k1, k2, k3, w1, w2, k1 * w1 + k2 * w2 + k3 * w3 AS p FROM k
    UNION ALL SELECT event_type, step + 1, mu, sd, k1, k2, k3, p, w1, k1 * p + k2 * w1 + k3 * w2 FROM r WHERE step < 23)
  SELECT event_type, CAST(step AS BIGINT) AS step, round((p * sd + mu) * exp(-0.1 * step), 6) + 0.0 AS correction FROM r)"""))
def q_lag_weight_recursion(spark, sf):
    """24 damped steps of the correction per event type, weights from lag correlations."""
    keys = ["event_type"]
    x = common.features(spark, sf, keys).select(*keys, ORDER, (F.col(Y) - F.col("prev_count")).cast("double").alias("x"))
    sc = series.standard_scale_clip(x, "x", 3.0, keys)
    w = Window.partitionBy(*keys).orderBy(ORDER)
    lagged = sc.select("*", *[F.lag("x_sc", i).over(w).alias(f"l{i}") for i in (1, 2, 3)],
                       F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(ORDER))).alias("back"))
    zero = F.lit(0.0)
    models = lagged.groupBy(*keys).agg(
        F.first("x__mean").alias("resid_mean"), F.first("x__std").alias("resid_std"), F.lit(3).alias("lookback"),
        F.array(zero, zero, zero, zero, *[F.corr("x_sc", f"l{i}") / i for i in (3, 2, 1)]).alias("coef"),
        F.array(zero, zero, zero, *[F.max(F.when(F.col("back") == i, F.col("x_sc"))) for i in (3, 2, 1)]).alias("window"))
    horizon = models.select(*keys, F.lit(24).alias("steps"))
    return common.rounded(hybrid.recursive_forecast(models, horizon, keys))


# ---- operators that had no query of their own -------------------------------------------

@register("row_count", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, body="SELECT event_type, count(*) AS n_rows FROM hourly_k GROUP BY event_type"))
def q_row_count(spark, sf):
    """Hours per event type (A4)."""
    return traffic.row_count(common.hourly(spark, sf, ["event_type"]), ["event_type"])


@register("assemble", O.with_ctes(*O.FEATURE_CTES, O.SPLIT, """cyc2 AS (
  SELECT *, sin(2 * pi() * hour(hour_timestamp) / 24.0) AS hour_sin, cos(2 * pi() * hour(hour_timestamp) / 24.0) AS hour_cos FROM split)""", body=(
    "SELECT hour_timestamp, CAST(prev_count AS DOUBLE) AS x1, round(hour_sin, 6) + 0.0 AS x2, round(hour_cos, 6) + 0.0 AS x3 FROM cyc2")))
def q_assemble(spark, sf):
    """The linear model's feature vector, taken apart again (M1)."""
    from pyspark.ml.functions import vector_to_array

    x = linear.assemble(lr_inputs(spark, sf)).select(ORDER, vector_to_array("features").alias("x"))
    return common.rounded(x.select(ORDER, *[F.col("x")[i].alias(f"x{i + 1}") for i in range(3)]))


@register("standard_scale_inverse", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, round(CASE WHEN stddev_pop(r) OVER () = 0 THEN r ELSE avg(r) OVER () + stddev_pop(r) OVER () "
    "* greatest(-3.0, least(3.0, (r - avg(r) OVER ()) / stddev_pop(r) OVER ())) END, 6) + 0.0 AS change FROM "
    "(SELECT hour_timestamp, CAST(request_count - prev_count AS DOUBLE) AS r FROM features)")))
def q_standard_scale_inverse(spark, sf):
    """The hour-over-hour change scaled, clipped at three deviations and scaled back (W10 inverse)."""
    f = common.features(spark, sf).select(ORDER, (F.col(Y) - F.col("prev_count")).cast("double").alias("change"))
    sc = series.standard_scale_clip(f, "change", 3.0)
    back = series.inverse_standard(F.col("change_sc"), F.col("change__mean"), F.col("change__std"))
    return common.rounded(sc.select(ORDER, back.alias("change")))


@register("filled_hours_by_type", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, body=(
    "SELECT g.event_type, g.hour_timestamp, coalesce(h.request_count, 0) AS request_count, coalesce(h.total_bytes, 0) AS total_bytes FROM ("
    "SELECT event_type, unnest(generate_series(min(hour_timestamp), max(hour_timestamp), INTERVAL 1 HOUR)) AS hour_timestamp FROM hourly_k GROUP BY event_type) g "
    "LEFT JOIN hourly_k h ON g.event_type = h.event_type AND g.hour_timestamp = h.hour_timestamp")))
def q_filled_hours_by_type(spark, sf):
    """Hourly series per event type with empty hours as zeros, so that lag 24 is 24 hours."""
    return common.hourly(spark, sf, ["event_type"], fill_gaps=True)
