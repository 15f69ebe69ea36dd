"""Scalar column functions and small DataFrame transforms.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quality thresholds and labels of the model report card.
GRADE_EXCELLENT = 0.80
GRADE_GOOD = 0.50
GRADE_LABELS = ("EXCELLENT", "GOOD", "NEEDS IMPROVEMENT")


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column (P5, ``na.drop()``)."""
    return df.na.drop()


def with_cyclical_hour(df: DataFrame, ts: str = "hour_timestamp") -> DataFrame:
    """Add ``hour_of_day``, ``hour_sin``, ``hour_cos`` (P6); use with ``df.transform``."""
    h = F.hour(ts)
    angle = F.lit(2.0 * math.pi) * h / F.lit(24.0)
    return (df.withColumn("hour_of_day", h)
              .withColumn("hour_sin", F.sin(angle))
              .withColumn("hour_cos", F.cos(angle)))


def abs_pct_error(y: Column, yhat: Column) -> Column:
    """``|y - yhat| / y``; NULL where y = 0 so that averages skip those rows."""
    return F.when(y != 0, F.abs(y - yhat) / y)


def quality_grade(r2: Column) -> Column:
    """Strict thresholds: > 0.80 EXCELLENT, > 0.50 GOOD, else NEEDS IMPROVEMENT."""
    return (F.when(r2 > GRADE_EXCELLENT, F.lit(GRADE_LABELS[0]))
            .when(r2 > GRADE_GOOD, F.lit(GRADE_LABELS[1]))
            .otherwise(F.lit(GRADE_LABELS[2])))


def improvement_pct(base: Column, new: Column) -> Column:
    """``(base - new) / base * 100`` (P9); NULL when ``base`` is 0 (no ANSI division error)."""
    return F.when(base != 0, (base - new) / base * F.lit(100.0))


def clip(c: Column, lo: float = -3.0, hi: float = 3.0) -> Column:
    """Bound values to ``[lo, hi]`` (P10)."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def decay(step: Column, rate: float = 0.1) -> Column:
    """``exp(-rate * step)`` with step counted from 0."""
    return F.exp(F.lit(-rate) * step)
