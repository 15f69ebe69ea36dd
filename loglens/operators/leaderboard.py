"""Model comparison tables.

The models fill the reference's four slots: linear regression, the sequence model
(LSTM slot), the seasonal model (SARIMA slot) and the hybrid. Ties go to the
earlier model in this fixed order, as the reference's dictionary order does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Model slots in tie-break order, compared metrics and their direction.
MODEL_ORDER = ["Linear Regression", "Sequence Regressor", "Seasonal", "Hybrid"]
MODEL_COLUMNS = {"Linear Regression": "linear_regression", "Sequence Regressor": "sequence_regressor",
                 "Seasonal": "seasonal", "Hybrid": "hybrid"}
METRICS = {"rmse": "min", "mae": "min", "r2": "max", "mape": "min"}
METRIC_COLUMNS = ["model", "mse", "rmse", "mae", "r2", "mape", "order", "seasonal_order", "aic",
                  "sarima_order", "sarima_seasonal_order", "sarima_aic", "improvement_over_sarima_pct"]


def union_metrics(dfs: Sequence[DataFrame]) -> DataFrame:
    """One long table from metric records with different columns."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    for c in METRIC_COLUMNS:
        if c not in u.columns:
            u = u.withColumn(c, F.lit(None).cast("string" if "order" in c else "double"))
    return u.select(*METRIC_COLUMNS)


def _model_rank(models):
    order = list(models)
    return F.coalesce(F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model")),
                      F.lit(len(order) + 1))


def _long(metrics: DataFrame) -> DataFrame:
    stack = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in METRICS)
    return metrics.selectExpr("model", f"stack({len(METRICS)}, {stack}) AS (metric, value)")


def leaderboard(metrics: DataFrame, models: dict[str, str] = MODEL_COLUMNS) -> DataFrame:
    """Rows = metrics, columns = models in slot order (C1). ``models``: name -> column, in order."""
    long = _long(metrics)
    p = long.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))
    return p.select("metric", *[F.col(f"`{m}`").alias(c) for m, c in models.items()])


def metric_winners(metrics: DataFrame, models=MODEL_ORDER) -> DataFrame:
    """Winner per metric: lowest rmse/mae/mape, highest r2; NaN never wins; ties by slot."""
    long = _long(metrics).withColumn("model_rank", _model_rank(models))
    sign = F.when(F.col("metric") == "r2", F.lit(-1.0)).otherwise(F.lit(1.0))
    w = Window.partitionBy("metric").orderBy((F.col("value").isNull() | F.isnan("value")).asc(),
                                             (F.col("value") * sign).asc(), F.col("model_rank").asc())
    return (long.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
                .select("metric", F.col("model").alias("winner"), "value"))


def overall_winner(winners: DataFrame, models=MODEL_ORDER) -> DataFrame:
    """The model with most metric wins; ties by slot order."""
    wins = winners.groupBy(F.col("winner").alias("model")).agg(F.count(F.lit(1)).alias("wins"))
    w = Window.orderBy(F.col("wins").desc(), _model_rank(models).asc())
    return (wins.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
                .select("model", "wins", F.lit(len(METRICS)).alias("n_metrics")))
