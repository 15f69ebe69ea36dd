"""Registered queries for the linear model, metrics and model/metric persistence
(M1-M6, M14, S3, S5, S6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import with_cyclical_hour
from ..operators import evaluate, linear, series
from ..session import scratch_path
from ..sources import files
from . import common
from . import oracle_sql as O
from .registry import register

CYC = """cyc AS (
  SELECT *, sin(2 * pi() * hour(hour_timestamp) / 24.0) AS hour_sin,
            cos(2 * pi() * hour(hour_timestamp) / 24.0) AS hour_cos FROM split)"""

# OLS on (prev_count, hour_sin, hour_cos) over the train rows: centred sums and
# Cramer's rule on the 3x3 normal equations.
COEF = """mu AS (
  SELECT avg(prev_count) AS m1, avg(hour_sin) AS m2, avg(hour_cos) AS m3, avg(request_count) AS my
  FROM cyc WHERE split = 'train'),
cs AS (
  SELECT m1, m2, m3, my,
    sum((prev_count - m1) * (prev_count - m1)) AS s11, sum((prev_count - m1) * (hour_sin - m2)) AS s12,
    sum((prev_count - m1) * (hour_cos - m3)) AS s13, sum((hour_sin - m2) * (hour_sin - m2)) AS s22,
    sum((hour_sin - m2) * (hour_cos - m3)) AS s23, sum((hour_cos - m3) * (hour_cos - m3)) AS s33,
    sum((prev_count - m1) * (request_count - my)) AS t1, sum((hour_sin - m2) * (request_count - my)) AS t2,
    sum((hour_cos - m3) * (request_count - my)) AS t3
  FROM cyc, mu WHERE split = 'train' GROUP BY m1, m2, m3, my),
det AS (
  SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13) AS dd
  FROM cs),
coef0 AS (
  SELECT m1, m2, m3, my,
    (t1 * (s22 * s33 - s23 * s23) - s12 * (t2 * s33 - s23 * t3) + s13 * (t2 * s23 - s22 * t3)) / dd AS b1,
    (s11 * (t2 * s33 - s23 * t3) - t1 * (s12 * s33 - s23 * s13) + s13 * (s12 * t3 - t2 * s13)) / dd AS b2,
    (s11 * (s22 * t3 - t2 * s23) - s12 * (s12 * t3 - t2 * s13) + t1 * (s12 * s23 - s22 * s13)) / dd AS b3
  FROM det),
coef AS (SELECT b1, b2, b3, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0 FROM coef0),
pred AS (
  SELECT hour_timestamp, prev_count, request_count,
         b0 + b1 * prev_count + b2 * hour_sin + b3 * hour_cos AS prediction
  FROM cyc, coef WHERE split = 'test')"""

LR_CTES = (*O.FEATURE_CTES, O.SPLIT, CYC, COEF)

METRICS_SQL = """SELECT count(*) AS n,
  round(avg((request_count - prediction) * (request_count - prediction)), 6) AS mse,
  round(sqrt(avg((request_count - prediction) * (request_count - prediction))), 6) AS rmse,
  round(avg(abs(request_count - prediction)), 6) AS mae,
  round(1 - sum((request_count - prediction) * (request_count - prediction))
        / (count(*) * var_pop(request_count)), 6) AS r2,
  round(coalesce(avg(CASE WHEN request_count <> 0 THEN abs(request_count - prediction) / request_count END) * 100,
        'NaN'::DOUBLE), 6) AS mape
FROM pred"""


def lr_inputs(spark, sf, keys=()):
    """Hourly features split 80/20 with cyclical hour columns. Read from the materialised
    feature stage; the split is one window over that small table, so it is not staged again."""
    s = series.chrono_split(common.features_stage(spark, sf, keys), "hour_timestamp", keys=keys)
    return s.transform(with_cyclical_hour)


def lr_fit(spark, sf):
    data = lr_inputs(spark, sf)
    model = linear.fit_linreg(data.filter(F.col("split") == "train"))
    return data, model


def lr_predictions(spark, sf):
    data, model = lr_fit(spark, sf)
    return linear.score(model, data.filter(F.col("split") == "test")), model


@register("linreg_fit", O.with_ctes(*LR_CTES, body=(
    "SELECT term, round(coefficient, 6) AS coefficient FROM (SELECT 'intercept' AS term, b0 AS coefficient "
    "FROM coef UNION ALL SELECT 'prev_count', b1 FROM coef UNION ALL SELECT 'hour_sin', b2 FROM coef "
    "UNION ALL SELECT 'hour_cos', b3 FROM coef)")))
def q_linreg_fit(spark, sf):
    """Assemble (prev_count, hour_sin, hour_cos) and fit OLS on the train hours (M1, M2)."""
    _, model = lr_fit(spark, sf)
    return common.rounded(linear.coefficients(spark, model))


@register("linreg_predict", O.with_ctes(*LR_CTES, body=(
    "SELECT hour_timestamp, prev_count, request_count, round(prediction, 6) AS prediction FROM pred")))
def q_linreg_predict(spark, sf):
    """Score the test hours with the fitted pipeline (M3)."""
    pred, _ = lr_predictions(spark, sf)
    return common.rounded(pred)


@register("regression_metrics", O.with_ctes(*LR_CTES, body=METRICS_SQL))
def q_regression_metrics(spark, sf):
    """mse, rmse, mae, r2 and mape of the linear model on the test hours, one pass (M5)."""
    pred, _ = lr_predictions(spark, sf)
    return common.rounded(evaluate.regression_metrics(pred, "request_count", "prediction"))


@register("mape_nonzero", O.with_ctes(*LR_CTES, body=(
    "SELECT round(coalesce(avg(CASE WHEN request_count <> 0 THEN abs(request_count - prediction) "
    "/ request_count END) * 100, 'NaN'::DOUBLE), 6) AS mape FROM pred")))
def q_mape_nonzero(spark, sf):
    """MAPE over test hours with a non-zero actual."""
    pred, _ = lr_predictions(spark, sf)
    return common.rounded(evaluate.mape_nonzero(pred, "request_count", "prediction"))


_LIVE = "live AS (SELECT * FROM (VALUES (2000, 10), (5000, 14), (100, 3), (8000, 18)) v(prev_count, h))"


@register("predict_live", O.with_ctes(*LR_CTES, _LIVE, body=(
    "SELECT CAST(prev_count AS INTEGER) AS prev_count, round(sin(2 * pi() * h / 24), 6) + 0.0 AS hour_sin, "
    "round(cos(2 * pi() * h / 24), 6) + 0.0 AS hour_cos, "
    "round(b0 + b1 * prev_count + b2 * sin(2 * pi() * h / 24) + b3 * cos(2 * pi() * h / 24), 6) AS prediction "
    "FROM live, coef")))
def q_predict_live(spark, sf):
    """Score four hypothetical hours with the model fitted on the data."""
    _, model = lr_fit(spark, sf)
    return common.rounded(linear.predict_live(spark, model))


@register("model_roundtrip", O.with_ctes(*LR_CTES, body=(
    "SELECT hour_timestamp, prev_count, request_count, round(prediction, 6) AS prediction FROM pred")))
def q_model_roundtrip(spark, sf):
    """Save the fitted pipeline, load it back and score the test hours."""
    data, model = lr_fit(spark, sf)
    path = files.save_model(model, scratch_path(spark, "model"))
    loaded = files.load_model(path)
    return common.rounded(linear.score(loaded, data.filter(F.col("split") == "test")))


@register("metrics_json_roundtrip", O.with_ctes(*LR_CTES, body=(
    "SELECT round(sqrt(avg((request_count - prediction) * (request_count - prediction))), 6) AS rmse, "
    "round(avg(abs(request_count - prediction)), 6) AS mae, "
    "round(1 - sum((request_count - prediction) * (request_count - prediction)) "
    "/ (count(*) * var_pop(request_count)), 6) AS r2, "
    "round(coalesce(avg(CASE WHEN request_count <> 0 THEN abs(request_count - prediction) / request_count END) "
    "* 100, 'NaN'::DOUBLE), 6) AS mape FROM pred")))
def q_metrics_json_roundtrip(spark, sf):
    """Write the linear model's metric record as one JSON file and read it back typed (S3)."""
    pred, _ = lr_predictions(spark, sf)
    m = evaluate.regression_metrics(pred, "request_count", "prediction").select("rmse", "mae", "r2", "mape")
    path = files.write_metrics(m, scratch_path(spark, "lr_metrics"))
    return common.rounded(files.read_metrics(spark, path).select("rmse", "mae", "r2", "mape"))


@register("forecast_sample", O.with_ctes(*LR_CTES, body=(
    "SELECT hour_timestamp, request_count, round(prediction, 6) AS prediction, "
    "round(request_count - prediction, 6) AS difference FROM pred ORDER BY hour_timestamp LIMIT 10")))
def q_forecast_sample(spark, sf):
    """First ten test hours: actual, prediction, difference."""
    pred, _ = lr_predictions(spark, sf)
    return common.rounded(evaluate.forecast_sample(pred, "hour_timestamp", "request_count", [], "prediction"))


# Per-series OLS oracle: the same centred sums and Cramer's rule, grouped by event type.
_BY_TYPE = """split_k AS (
  SELECT *, CASE WHEN row_idx < n_train THEN 'train' ELSE 'test' END AS split FROM (
    SELECT *, CAST(floor(0.8 * n_rows) AS BIGINT) AS n_train FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY hour_timestamp) - 1 AS row_idx,
             count(*) OVER (PARTITION BY event_type) AS n_rows
      FROM features_k) a) b),
cyc_k AS (
  SELECT *, sin(2 * pi() * hour(hour_timestamp) / 24.0) AS hour_sin,
            cos(2 * pi() * hour(hour_timestamp) / 24.0) AS hour_cos FROM split_k),
mu_k AS (
  SELECT event_type, avg(prev_count) AS m1, avg(hour_sin) AS m2, avg(hour_cos) AS m3, avg(request_count) AS my
  FROM cyc_k WHERE split = 'train' GROUP BY event_type),
cs_k AS (
  SELECT c.event_type, m1, m2, m3, my,
    sum((prev_count - m1) * (prev_count - m1)) AS s11, sum((prev_count - m1) * (hour_sin - m2)) AS s12,
    sum((prev_count - m1) * (hour_cos - m3)) AS s13, sum((hour_sin - m2) * (hour_sin - m2)) AS s22,
    sum((hour_sin - m2) * (hour_cos - m3)) AS s23, sum((hour_cos - m3) * (hour_cos - m3)) AS s33,
    sum((prev_count - m1) * (request_count - my)) AS t1, sum((hour_sin - m2) * (request_count - my)) AS t2,
    sum((hour_cos - m3) * (request_count - my)) AS t3
  FROM cyc_k c JOIN mu_k u ON c.event_type = u.event_type WHERE split = 'train'
  GROUP BY c.event_type, m1, m2, m3, my),
det_k AS (
  SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13) AS dd
  FROM cs_k),
coef0_k AS (
  SELECT event_type, m1, m2, m3, my,
    (t1 * (s22 * s33 - s23 * s23) - s12 * (t2 * s33 - s23 * t3) + s13 * (t2 * s23 - s22 * t3)) / dd AS b1,
    (s11 * (t2 * s33 - s23 * t3) - t1 * (s12 * s33 - s23 * s13) + s13 * (s12 * t3 - t2 * s13)) / dd AS b2,
    (s11 * (s22 * t3 - t2 * s23) - s12 * (s12 * t3 - t2 * s13) + t1 * (s12 * s23 - s22 * s13)) / dd AS b3
  FROM det_k),
coef_k AS (SELECT event_type, b1, b2, b3, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0 FROM coef0_k),
pred_k AS (
  SELECT c.event_type, hour_timestamp, request_count,
         b0 + b1 * prev_count + b2 * hour_sin + b3 * hour_cos AS prediction
  FROM cyc_k c JOIN coef_k k ON c.event_type = k.event_type WHERE split = 'test')"""


@register("linreg_by_type", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, O.FEATURES_KEYED, _BY_TYPE, body=(
    "SELECT event_type, count(*) AS n, "
    "round(avg((request_count - prediction) * (request_count - prediction)), 6) AS mse, "
    "round(sqrt(avg((request_count - prediction) * (request_count - prediction))), 6) AS rmse, "
    "round(avg(abs(request_count - prediction)), 6) AS mae, "
    "round(1 - sum((request_count - prediction) * (request_count - prediction)) "
    "/ (count(*) * var_pop(request_count)), 6) AS r2, "
    "round(coalesce(avg(CASE WHEN request_count <> 0 THEN abs(request_count - prediction) / request_count END) "
    "* 100, 'NaN'::DOUBLE), 6) AS mape FROM pred_k GROUP BY event_type")))
def q_linreg_by_type(spark, sf):
    """The linear model fitted and scored per event-type series from Gram statistics (M2, M3, M5 keyed)."""
    keys = ["event_type"]
    data = lr_inputs(spark, sf, keys)
    models = linear.fit_linreg_by_key(data.filter(F.col("split") == "train"), keys)
    pred = linear.score_by_key(models, data.filter(F.col("split") == "test"), keys)
    return common.rounded(evaluate.regression_metrics(pred, "request_count", "prediction", keys=keys))
