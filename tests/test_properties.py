"""Invariants over the fixture tables."""

import pytest
from pyspark.sql import functions as F

from loglens.operators import series, traffic
from loglens.plans import common
from tests.conftest import SF_MID, SF_SMALL


def test_hourly_counts_sum_to_parsed_rows(spark):
    p = common.parsed(spark, SF_MID)
    h = common.hourly(spark, SF_MID)
    assert h.agg(F.sum("request_count")).first()[0] == p.filter("event_time IS NOT NULL").count() == 9411


def test_split_sizes(spark):
    s = series.chrono_split(common.features(spark, SF_MID), "hour_timestamp")
    c = dict(s.groupBy("split").count().collect())
    n = c["train"] + c["test"]
    assert c["train"] == int(0.8 * n)


def test_minmax_inverse_roundtrip(spark):
    f = series.minmax_scale(common.features(spark, SF_SMALL), ["request_count"])
    back = f.select(F.abs(series.inverse_minmax(F.col("request_count_mm"), F.col("request_count__min"),
                                                F.col("request_count__max")) - F.col("request_count")).alias("e"))
    assert back.agg(F.max("e")).first()[0] < 1e-9


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "t int, x double")
    assert [r.x_mm for r in series.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0]


def test_clip_bound(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0] * 50 + [1000])], "t int, r double")
    out = series.standard_scale_clip(df, "r", 3.0)
    assert out.agg(F.max(F.abs("r_sc"))).first()[0] == pytest.approx(3.0)


def test_sequences_n_minus_l_per_series(spark):
    f = common.features(spark, SF_MID, ["event_type"])
    seqs = series.lookback_sequences(f, "hour_timestamp", ["request_count"], "request_count", 6, ["event_type"])
    n = dict(f.groupBy("event_type").count().collect())
    got = dict(seqs.groupBy("event_type").count().collect())
    assert got == {k: v - 6 for k, v in n.items()}


def test_keyed_equals_global_on_one_key(spark):
    """A keyed run restricted to one key equals the global run over that key's rows."""
    p = common.parsed_typed(spark, SF_MID)
    keyed = series.lag_features(traffic.windowed_traffic(traffic.drop_unparsed(p), keys=["event_type"]),
                                keys=["event_type"]).filter("event_type = 'click'").drop("event_type")
    one = series.lag_features(traffic.windowed_traffic(traffic.drop_unparsed(p.filter("event_type = 'click'"))))
    assert keyed.exceptAll(one).count() == 0 and one.exceptAll(keyed).count() == 0


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "ip string")
    assert [r.ip for r in traffic.top_k(df, "ip", 2).collect()] == ["c", "a"]


def test_fill_gaps_adds_zero_hours(spark):
    p = traffic.drop_unparsed(common.parsed_typed(spark, SF_SMALL))
    plain = traffic.windowed_traffic(p, keys=["event_type"])
    filled = traffic.windowed_traffic(p, keys=["event_type"], fill_gaps=True)
    spans = filled.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        (F.expr("timestampdiff(HOUR, min(hour_timestamp), max(hour_timestamp))") + 1).alias("hours"))
    assert spans.filter("n != hours").count() == 0
    assert filled.agg(F.sum("request_count")).first()[0] == plain.agg(F.sum("request_count")).first()[0]
    assert filled.count() > plain.count()


def test_keyed_seasonal_fit_equals_global_on_one_key(spark):
    from loglens.operators import seasonal
    p = common.parsed_typed(spark, SF_MID)
    f = series.lag_features(traffic.windowed_traffic(traffic.drop_unparsed(p), keys=["event_type"]),
                            keys=["event_type"])
    keyed_in = series.zscore_scale(series.chrono_split(f, "hour_timestamp", keys=["event_type"]),
                                   ["total_bytes", "prev_count"], keys=["event_type"])
    one = f.filter("event_type = 'view'").drop("event_type")
    global_in = series.zscore_scale(series.chrono_split(one, "hour_timestamp"), ["total_bytes", "prev_count"])
    grid = {"p": (0, 1), "d": (0, 1), "q": (0, 1), "sp": (0,), "sd": (0, 1), "sq": (0,)}
    ex = ["total_bytes_z", "prev_count_z"]
    k = seasonal.fit_seasonal(keyed_in, "hour_timestamp", "request_count", ex, keys=["event_type"], grid=grid)
    g = seasonal.fit_seasonal(global_in, "hour_timestamp", "request_count", ex, grid=grid)
    ka = {r.cand_idx: r.aic for r in k.candidates.filter("event_type = 'view'").collect()}
    ga = {r.cand_idx: r.aic for r in g.candidates.collect()}
    assert ka.keys() == ga.keys()
    for c in ka:
        assert (ka[c] is None and ga[c] is None) or ka[c] == pytest.approx(ga[c], rel=1e-9)
    kf = seasonal.seasonal_forecast(k, "request_count").filter("event_type = 'view'").orderBy("step").collect()
    gf = seasonal.seasonal_forecast(g, "request_count").orderBy("step").collect()
    assert [round(r.seasonal_forecast, 6) for r in kf] == [round(r.seasonal_forecast, 6) for r in gf]


def test_metrics_on_constant_actuals_do_not_divide_by_zero(spark):
    from loglens.functions.columns import improvement_pct
    from loglens.operators import evaluate
    df = spark.createDataFrame([("a", 5.0, 5.0), ("a", 5.0, 5.0), ("b", 5.0, 4.0), ("b", 5.0, 6.0)],
                               "k string, y double, yhat double")
    m = {r.k: r for r in evaluate.regression_metrics(df, "y", "yhat", keys=["k"]).collect()}
    assert m["a"].r2 == 1.0 and m["b"].r2 == 0.0 and m["b"].rmse == 1.0
    z = spark.createDataFrame([(0.0, 1.0)], "b double, n double").select(improvement_pct(F.col("b"), F.col("n")))
    assert z.first()[0] is None
