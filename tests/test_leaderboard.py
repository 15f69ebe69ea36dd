
from pyspark.sql import functions as F

from loglens.functions.columns import quality_grade
from loglens.operators import leaderboard as L

# Published hourly metric records of the four models (rmse, mae, r2, mape).
RECORDS = [("Linear Regression", 17805.29, 14444.98, 0.9068, 21.67),
           ("Sequence Regressor", 29227.96, 22898.67, 0.7587, 21.64),
           ("Seasonal", 18641.86, 15898.07, 0.8978, 42.27),
           ("Hybrid", 18278.98, 15632.39, 0.9017, 41.12)]


def _metrics(spark):
    return spark.createDataFrame(RECORDS, "model string, rmse double, mae double, r2 double, mape double")


def test_winners_and_overall(spark):
    w = {r.metric: r.winner for r in L.metric_winners(_metrics(spark)).collect()}
    assert w == {"rmse": "Linear Regression", "mae": "Linear Regression", "r2": "Linear Regression",
                 "mape": "Sequence Regressor"}
    o = L.overall_winner(L.metric_winners(_metrics(spark))).collect()[0]
    assert (o.model, o.wins) == ("Linear Regression", 3)


def test_grades(spark):
    g = {r.model: r.g for r in _metrics(spark).select("model", quality_grade(F.col("r2")).alias("g")).collect()}
    assert g == {"Linear Regression": "EXCELLENT", "Sequence Regressor": "GOOD", "Seasonal": "EXCELLENT",
                 "Hybrid": "EXCELLENT"}


def test_ties_go_to_slot_order_and_nan_never_wins(spark):
    df = spark.createDataFrame([("Hybrid", 1.0, 1.0, float("nan"), 5.0),
                                ("Seasonal", 1.0, 2.0, 0.5, float("nan"))],
                               "model string, rmse double, mae double, r2 double, mape double")
    w = {r.metric: r.winner for r in L.metric_winners(df).collect()}
    assert w == {"rmse": "Seasonal", "mae": "Hybrid", "r2": "Seasonal", "mape": "Hybrid"}


def test_leaderboard_shape_and_union(spark):
    u = L.union_metrics([_metrics(spark).filter("model = 'Linear Regression'"),
                         _metrics(spark).filter("model = 'Seasonal'").withColumn("aic", F.lit(780.37))])
    assert u.columns == L.METRIC_COLUMNS and u.count() == 2
    lb = L.leaderboard(_metrics(spark))
    assert lb.columns == ["metric", "linear_regression", "sequence_regressor", "seasonal", "hybrid"]
    assert lb.count() == 4


def test_metric_table_judges_the_registered_sequence_regressor(spark, monkeypatch):
    from loglens.operators import sequence
    from loglens.plans import forecast_queries as Q

    fits, fit = [], sequence.fit_sequence_regressor

    def watched(*args, stage=None, **options):
        fits.append(options)
        return fit(*args, stage=stage, **options)

    own = Q.common.stage_path       # tables of this test alone: its tree candidate is a stand-in, as the fit itself is slow
    monkeypatch.setattr(Q.common, "stage_path", lambda *args: own(*args) + "-leaderboard-test")
    monkeypatch.setattr(sequence, "fit_sequence_regressor", watched)
    monkeypatch.setattr(sequence, "_gbt_candidate", lambda *args: (float("inf"), None))
    record = Q._sequence_record(spark, "/root/testdata/sf0.001").first()
    chosen = Q.q_sequence_regressor(spark, "/root/testdata/sf0.001").first()
    assert fits == [{"with_gbt": True}]         # fitted once, read by both
    assert all(round(record[m], 6) == chosen[m] for m in ("rmse", "mae", "r2"))
