"""Time-series feature operators over one or many series.

``keys=[]`` is one global series (the reference's case). With keys every
operator runs under ``Window.partitionBy(keys)``: the series are hash-partitioned
once and each is sorted locally; chained operators with the same keys reuse that
partitioning (no second exchange).

A series here is the *aggregated* table (one row per non-empty time bucket), so
its length is bounded by the time span (8,784 rows per hourly year), not by the
raw data volume; that is what makes a whole series per window partition safe,
including the global one, which Spark places in a single partition.

Fitted statistics (min/max, mean/std) are attached without a cross join: per key
with a ``groupBy`` + equi-join (AQE broadcasts it when the runtime size is under
the broadcast threshold), and for the global series as one scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clip, drop_null_rows


def series_window(order: str, keys: Sequence[str] = ()):
    keys = list(keys)
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(order)


def lag_features(df: DataFrame, order: str = "hour_timestamp", col: str = "request_count",
                 lags: Sequence[int] = (1,), keys: Sequence[str] = (),
                 names: Sequence[str] | None = None, drop_nulls: bool = True) -> DataFrame:
    """Previous-row values (lag 1 -> ``prev_count``), then drop rows with NULLs (W1 + P5).

    Empty hours are absent, so lag 1 is the previous non-empty hour.
    """
    w = series_window(order, keys)
    if names is None:
        names = ["prev_count" if k == 1 and col == "request_count" else f"{col}_lag{k}" for k in lags]
    out = df.select("*", *[F.lag(col, k).over(w).alias(n) for k, n in zip(lags, names)])
    return drop_null_rows(out) if drop_nulls else out


def row_index(df: DataFrame, order: str, keys: Sequence[str] = (), name: str = "row_idx") -> DataFrame:
    """0-based chronological index per series, BIGINT."""
    w = series_window(order, keys)
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))


def chrono_split(df: DataFrame, order: str, ratio: float = 0.8, keys: Sequence[str] = (),
                 index_col: str = "row_idx", split_col: str = "split") -> DataFrame:
    """First ``floor(ratio * n)`` rows of each series are 'train', the rest 'test' (W3).

    One ``split`` column instead of two filtered scans; ``n_rows`` and the index
    come from the same window partition.
    """
    keys = list(keys)
    w = series_window(order, keys)
    wall = Window.partitionBy(*keys) if keys else Window.partitionBy()
    idx = (F.row_number().over(w) - 1).cast("bigint")
    n = F.count(F.lit(1)).over(wall)
    out = df.select("*", idx.alias(index_col), n.alias("n_rows"))
    n_train = F.floor(F.lit(ratio) * F.col("n_rows")).cast("bigint")
    return (out.withColumn("n_train", n_train)
               .withColumn(split_col, F.when(F.col(index_col) < F.col("n_train"), "train")
                           .otherwise("test")))


def lookback_sequences(df: DataFrame, order: str, features: Sequence[str], target: str,
                       L: int = 6, keys: Sequence[str] = (), seq_col: str = "seq") -> DataFrame:
    """Row i gets the L preceding feature rows (oldest first) as ``array<struct>``.

    Rows with fewer than L predecessors are dropped: n - L sequences per series.
    """
    keys = list(keys)
    w = series_window(order, keys).rowsBetween(-L, -1)
    seq = F.collect_list(F.struct(*[F.col(f) for f in features])).over(w)
    return (df.select(*keys, order, seq.alias(seq_col), F.col(target).alias("target"))
              .filter(F.size(seq_col) == L))


def lag_columns(df: DataFrame, order: str, features: Sequence[str], L: int,
                keys: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Flat form of W4: ``{f}_l{k}`` = value of feature f, k rows back (k = 1..L).

    All lags share one window spec, so Spark plans a single sort per series.
    """
    by = f"partition by {', '.join(f'`{k}`' for k in keys)} " if keys else ""
    names = [(f"{f}_l{k}", f, k) for k in range(L, 0, -1) for f in features]
    lags = [f"lag(`{f}`, {k}) over ({by}order by `{order}`) as `{name}`" for name, f, k in names]
    return df.selectExpr("*", *lags), [name for name, _, _ in names]


def adaptive_lookback(n_train: Column, cap: int = 6, floor_: int = 3, div: int = 10) -> Column:
    """``max(min(cap, n_train div 10), floor_)``."""
    return F.greatest(F.least(F.lit(cap), F.floor(n_train / div)), F.lit(floor_)).cast("int")


def difference_terms(d: int, D: int, m: int) -> dict[int, int]:
    """Lag -> coefficient of ``(1 - B)^d (1 - B^m)^D``."""
    terms: dict[int, int] = {}
    for i in range(d + 1):
        for j in range(D + 1):
            k = i + m * j
            terms[k] = terms.get(k, 0) + (-1) ** (i + j) * comb(d, i) * comb(D, j)
    return {k: c for k, c in terms.items() if c != 0}


def differenced(col: str, w, d: int, D: int, m: int, shift: int = 0) -> Column:
    """``(1 - B)^d (1 - B^m)^D`` applied to ``col``, optionally ``shift`` rows back.

    Expanded into plain lags of the raw column (window functions cannot nest).
    """
    expr = None
    for k, c in sorted(difference_terms(d, D, m).items()):
        lag = k + shift
        term = F.col(col) if lag == 0 else F.lag(col, lag).over(w)
        term = term.cast("double") * F.lit(float(c))
        expr = term if expr is None else expr + term
    return expr


def seasonal_difference(df: DataFrame, order: str, col: str, d: int = 1, D: int = 1,
                        m: int = 24, keys: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """d regular and D seasonal differences of ``col`` (W6); NULL where history is short."""
    w = series_window(order, keys)
    return df.withColumn(name or f"{col}_diff", differenced(col, w, d, D, m))


def ar_lags(p: int, P: int, m: int) -> list[int]:
    """Multiplicative AR lags ``i + m*j`` (0 <= i <= p, 0 <= j <= P, not both 0)."""
    return sorted({i + m * j for i in range(p + 1) for j in range(P + 1)} - {0})


def lag_matrix(df: DataFrame, order: str, col: str, p: int, P: int, m: int = 24,
               keys: Sequence[str] = ()) -> DataFrame:
    """All multiplicative AR lags of ``col`` as columns ``{col}_lag{k}`` under one window."""
    w = series_window(order, keys)
    return df.select("*", *[F.lag(col, k).over(w).alias(f"{col}_lag{k}") for k in ar_lags(p, P, m)])


def _attach_stats(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Attach per-series statistics: equi-join per key, scalar subquery when global."""
    keys = list(keys)
    if keys:
        stats = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
        return df.join(stats, on=keys, how="left")
    one = df.agg(F.struct(*[e.alias(n) for n, e in aggs.items()]).alias("s")).scalar()
    return df.select("*", *[one.getField(n).alias(n) for n in aggs])


def _fit_filter(c: str, fit_on: str, split_col: str) -> Column:
    if fit_on == "all":
        return F.col(c)
    if fit_on == "train":
        return F.when(F.col(split_col) == "train", F.col(c))
    raise ValueError("fit_on must be 'all' or 'train'")


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: str = "all", keys: Sequence[str] = (),
                 split_col: str = "split", suffix: str = "_mm") -> DataFrame:
    """Independent 0-1 scaling per column; a constant column maps to 0.

    Keeps ``{c}__min``/``{c}__max`` columns for ``inverse_minmax``.
    """
    aggs = {}
    for c in cols:
        x = _fit_filter(c, fit_on, split_col).cast("double")
        aggs[f"{c}__min"], aggs[f"{c}__max"] = F.min(x), F.max(x)
    out = _attach_stats(df, keys, aggs)
    for c in cols:
        lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
        rng = hi - lo
        out = out.withColumn(c + suffix, F.when(rng == 0, F.lit(0.0))
                             .otherwise((F.col(c).cast("double") - lo) / rng))
    return out


def inverse_minmax(scaled: Column, lo: Column, hi: Column) -> Column:
    return scaled * (hi - lo) + lo


def zscore_scale(df: DataFrame, cols: Sequence[str], fit_on: str = "all", keys: Sequence[str] = (),
                 split_col: str = "split", suffix: str = "_z") -> DataFrame:
    """``(x - mean) / std`` with the sample std; a zero std is replaced by 1."""
    aggs = {}
    for c in cols:
        x = _fit_filter(c, fit_on, split_col).cast("double")
        aggs[f"{c}__mean"], aggs[f"{c}__std"] = F.avg(x), F.stddev_samp(x)
    out = _attach_stats(df, keys, aggs)
    for c in cols:
        sd = F.col(f"{c}__std")
        sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        out = out.withColumn(c + suffix, (F.col(c).cast("double") - F.col(f"{c}__mean")) / sd)
    return out


def standard_scale_clip(df: DataFrame, col: str, bound: float = 3.0, keys: Sequence[str] = (),
                        suffix: str = "_sc") -> DataFrame:
    """``clip((x - mean) / std_pop, -bound, bound)`` (W10); keeps ``{col}__mean``/``__std``.

    A zero std leaves the centred value unscaled (divide by 1).
    """
    aggs = {f"{col}__mean": F.avg(F.col(col).cast("double")),
            f"{col}__std": F.stddev_pop(F.col(col).cast("double"))}
    out = _attach_stats(df, keys, aggs)
    sd = F.col(f"{col}__std")
    sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return out.withColumn(col + suffix, clip((F.col(col) - F.col(f"{col}__mean")) / sd, -bound, bound))


def inverse_standard(scaled: Column, mean: Column, std: Column) -> Column:
    sd = F.when(std == 0, F.lit(1.0)).otherwise(std)
    return scaled * sd + mean


def drop_burn_in(df: DataFrame, order: str, n: int = 24, keys: Sequence[str] = ()) -> DataFrame:
    """Discard the first ``n`` rows of every series."""
    w = series_window(order, keys)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") > n).drop("_rn"))
