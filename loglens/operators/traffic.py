"""Log-table aggregations: filters, top-k, distributions, tumbling windows, profiles.

All are single ``groupBy``/``agg`` plans, so Spark runs a partial (map-side) hash
aggregate before the shuffle: a key holding a third of all rows becomes one
partial row per input partition before it is exchanged, so hot keys do not skew
the reduce side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_unparsed(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Keep rows whose timestamp parsed."""
    return df.filter(F.col(ts).isNotNull())


def top_k(df: DataFrame, key: str, k: int = 10, count_col: str = "request_count") -> DataFrame:
    """Count per key, highest first, first ``k``; ties broken by key ascending (A1).

    Planned as partial agg -> shuffle -> final agg -> TakeOrderedAndProject (a
    per-partition top-k heap merged on one task), so only k rows per partition move.
    """
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), F.col(key).asc_nulls_last())
            .limit(k))


def distribution(df: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """Count per key, descending; the NULL group is kept (A2)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), F.col(key).asc_nulls_last()))


def windowed_traffic(df: DataFrame, ts: str = "event_time", width: str = "1 hour",
                     keys: Sequence[str] = (), bytes_col: str = "bytes", fill_gaps: bool = False) -> DataFrame:
    """Tumbling, epoch-aligned windows -> ``hour_timestamp, request_count, total_bytes`` (A3).

    Empty windows are absent (reference behaviour), so a later lag means "previous
    non-empty window". ``fill_gaps=True`` adds the empty windows between each
    series' first and last one with zero counts: a ``sequence`` per series (its
    length is the series' time span) joined back on keys and window start.
    Rows with NULL time are dropped first (the reference filters them before grouping).
    """
    keys = list(keys)
    out = (df.filter(F.col(ts).isNotNull())
           .groupBy(*keys, F.window(ts, width).alias("time_window"))
           .agg(F.count(F.lit(1)).alias("request_count"), F.sum(bytes_col).alias("total_bytes"))
           .select(*keys, F.col("time_window.start").alias("hour_timestamp"),
                   "request_count", "total_bytes"))
    if not fill_gaps:
        return out
    span = out.groupBy(*keys).agg(F.min("hour_timestamp").alias("_lo"), F.max("hour_timestamp").alias("_hi"))
    grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {width}"))).alias("hour_timestamp"))
    return (grid.join(out, on=[*keys, "hour_timestamp"], how="left")
                .select(*keys, "hour_timestamp",
                        F.coalesce("request_count", F.lit(0)).cast("bigint").alias("request_count"),
                        F.coalesce("total_bytes", F.lit(0)).cast("bigint").alias("total_bytes")))


def row_count(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total rows, per key when given (A4)."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


DESCRIBE_STATS = ["count", "mean", "stddev", "min", "max"]


def describe_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df.describe`` as numbers, long form ``(column_name, stat, value)`` (A5).

    One aggregation pass computes every statistic of every column; ``stack`` then
    turns the single wide row into long form.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(c).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', '{s}', `{c}__{s}`" for c in cols for s in DESCRIBE_STATS)
    return wide.selectExpr(f"stack({len(cols) * len(DESCRIBE_STATS)}, {pairs}) AS (column_name, stat, value)")


def time_range(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, first and last timestamp."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(ts).alias("n_obs"), F.min(ts).alias("first_ts"),
                                 F.max(ts).alias("last_ts"))


def sorted_sample(df: DataFrame, by: str, n: int = 20) -> DataFrame:
    """First ``n`` rows in ``by`` order (A7); the limit is the feature."""
    return df.orderBy(F.col(by).asc_nulls_last()).limit(n)


def inspect_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types as a table (A8). Reads only the plan's schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")
