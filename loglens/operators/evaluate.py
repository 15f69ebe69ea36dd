"""Forecast evaluation and alignment.

Metrics come from one aggregation pass (the reference runs one job per metric).
Every aggregate is distributive (sums, counts, ``var_pop`` with its stable merge),
so per-series metrics run as partial + final aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import abs_pct_error


def align_forecast(actual: DataFrame, forecast: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach forecasts to actuals by series keys and timestamp (J1): inner equi-join.

    Both sides are per-bucket tables; Spark broadcasts the forecast side only when
    its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks
    at runtime), else shuffles both on the keys.
    """
    return actual.join(forecast, on=list(on), how="inner")


def mape_expr(y: str, yhat: str):
    """Mean of |y - yhat| / y over rows with y != 0, x 100; NaN when no such row (M6)."""
    return F.coalesce(F.avg(abs_pct_error(F.col(y).cast("double"), F.col(yhat))) * F.lit(100.0),
                      F.lit(float("nan")))


def mape_nonzero(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*list(keys)).agg(mape_expr(y, yhat).alias("mape"))


def regression_metrics(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = (),
                       with_mape: bool = True) -> DataFrame:
    """n, mse, rmse, mae, r2 (1 - SSE / SST about the evaluated rows' mean), mape (M5, M6).

    Under ANSI mode a division by zero fails the job, so the SST = 0 case is decided
    explicitly (1.0 for a perfect fit, else 0.0).
    """
    yy = F.col(y).cast("double")
    err = yy - F.col(yhat)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
            F.sum(err * err).alias("_sse"), F.var_pop(yy).alias("_var")]
    if with_mape:
        aggs.append(mape_expr(y, yhat).alias("mape"))
    out = df.groupBy(*list(keys)).agg(*aggs)
    # constant actuals (SST = 0): 1.0 for a perfect fit, else 0.0 -- never a division by zero
    sst = F.col("_var") * F.col("n")
    r2 = (F.when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / sst))
    cols = [*keys, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2")]
    if with_mape:
        cols.append("mape")
    return out.select(*cols)


def forecast_sample(df: DataFrame, order: str, actual: str, components: Sequence[str], prediction: str,
                    n: int = 10) -> DataFrame:
    """First ``n`` evaluated rows: actual, components, prediction, difference."""
    return (df.orderBy(F.col(order).asc())
              .limit(n)
              .select(order, actual, *components, prediction,
                      (F.col(actual) - F.col(prediction)).alias("difference")))
