"""Linear traffic model on Spark ML (M1-M4).

``LinearRegression`` with default parameters solves the normal equations from one
distributed aggregation of the feature Gram matrix, so training cost is one pass
over the rows whatever their number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import inline_rows
from . import lsq

FEATURES = ("prev_count", "hour_sin", "hour_cos")
LABEL = "request_count"

# The four hypothetical hours scored by the live-prediction job,
# as (prev_count, hour of day).
LIVE_HOURS = [(2000, 10), (5000, 14), (100, 3), (8000, 18)]


def assembler(cols: Sequence[str] = FEATURES, out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out)


def assemble(df: DataFrame, cols: Sequence[str] = FEATURES, out: str = "features") -> DataFrame:
    """Columns -> one dense vector column (M1)."""
    return assembler(cols, out).transform(df)


def linreg_pipeline(features: Sequence[str] = FEATURES, label: str = LABEL) -> Pipeline:
    lr = LinearRegression(featuresCol="features", labelCol=label)
    return Pipeline(stages=[assembler(features), lr])


def fit_linreg(train: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> PipelineModel:
    """OLS with intercept and default parameters (M2)."""
    return linreg_pipeline(features, label).fit(train)


def coefficients(spark: SparkSession, model: PipelineModel,
                 features: Sequence[str] = FEATURES) -> DataFrame:
    """Fitted terms as rows ``(term, coefficient)``."""
    lr = model.stages[-1]
    rows = [("intercept", float(lr.intercept))] + [(f, float(c)) for f, c in zip(features, lr.coefficients)]
    return spark.createDataFrame(rows, "term string, coefficient double")


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("hour_timestamp", "prev_count",
                                                                       "request_count")) -> DataFrame:
    """Predictions with the kept columns plus ``prediction`` (M3)."""
    return model.transform(df).select(*keep, "prediction")


def live_rows(spark: SparkSession, hours=LIVE_HOURS) -> DataFrame:
    """Scoring rows for hypothetical hours: prev_count INT, hour_sin, hour_cos."""
    rows = [(p, math.sin(2 * math.pi * h / 24), math.cos(2 * math.pi * h / 24)) for p, h in hours]
    return inline_rows(spark, rows, "prev_count int, hour_sin double, hour_cos double")


def predict_live(spark: SparkSession, model: PipelineModel, hours=LIVE_HOURS) -> DataFrame:
    """Score the live rows (M4)."""
    return model.transform(live_rows(spark, hours)).select("prev_count", "hour_sin", "hour_cos", "prediction")


def fit_linreg_by_key(train: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES,
                      label: str = LABEL) -> DataFrame:
    """OLS with intercept for every series at once (the keyed form of M2).

    ``LinearRegression`` fits one model over all rows; per series we solve the same
    normal equations from per-key Gram statistics (one aggregation, partial merge).
    Returns keys, ``n_train``, ``coef`` = [intercept, *features].
    """
    keys = list(keys)
    g = lsq.gram_stats(train, keys, features, label)
    k = 1 + len(features)

    def solve(it):
        for pdf in it:
            if pdf.empty:
                continue
            beta, _ = lsq.solve_batch(lsq.unpack_batch(np.stack(pdf["all_xtx"].to_numpy()), k),
                                      np.stack(pdf["all_xty"].to_numpy()), range(k))
            out = pdf[keys].copy()
            out["n_train"] = pdf["all_n"].astype("int64")
            out["coef"] = [None if np.isnan(b).any() else b.tolist() for b in beta]
            yield out

    schema = T.StructType([g.schema[c] for c in keys] + [T.StructField("n_train", T.LongType()),
                                                         T.StructField("coef", T.ArrayType(T.DoubleType()))])
    return g.mapInPandas(solve, schema)


def score_by_key(models: DataFrame, df: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES,
                 keep: Sequence[str] = ("hour_timestamp", "prev_count", "request_count")) -> DataFrame:
    """Per-series predictions: equi-join on the keys, dot product as a Catalyst expression."""
    keys = list(keys)
    j = df.join(models.select(*keys, "coef"), on=keys, how="inner")
    return j.select(*keys, *keep, lsq.dot([f"`{f}`" for f in features], "coef").alias("prediction"))
