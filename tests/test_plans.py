"""Physical plan shape: pruning, partial aggregation, top-k, window partitioning."""

from loglens.operators import series, traffic
from loglens.plans import QUERIES, common
from tests.conftest import SF_MID


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    p = _plan(common.parsed(spark, SF_MID))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "props" not in p
    # the hourly series reads two columns of the parsed stage
    assert "ReadSchema: struct<bytes:bigint,event_time:timestamp_ntz>" in _plan(common.hourly(spark, SF_MID))


def test_partial_aggregation_before_shuffle(spark):
    p = _plan(traffic.distribution(common.parsed(spark, SF_MID), "status"))
    assert "partial_count" in p and "Exchange hashpartitioning(status" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(traffic.top_k(common.parsed(spark, SF_MID), "ip", 10))


def test_keyed_series_have_no_single_partition(spark):
    f = series.chrono_split(common.features(spark, SF_MID, ["event_type"]), "hour_timestamp", keys=["event_type"])
    p = _plan(f)
    assert "SinglePartition" not in p
    assert "hashpartitioning(event_type" in p


def test_lag_matrix_is_one_window(spark):
    f = series.lag_matrix(common.hourly(spark, SF_MID, ["event_type"]), "hour_timestamp", "request_count", 2, 1,
                          24, keys=["event_type"])
    p = _plan(f)
    assert p.count("Window [") == 1


def test_parse_stays_in_codegen(spark):
    p = _plan(common.parsed(spark, SF_MID))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_partitioned_parsed_table_prunes_days(spark):
    import tempfile

    from pyspark.sql import functions as F

    from loglens.sources import files
    path = tempfile.mkdtemp(prefix="loglens-part-") + "/parsed"
    p = common.parsed(spark, SF_MID).withColumn("event_date", F.to_date("event_time"))
    files.write_table(p, path, partition_by=["event_date"])
    one_day = files.read_table(spark, path).filter(F.col("event_date") == F.lit("2024-01-05").cast("date"))
    plan = _plan(one_day.select("ip", "status"))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-05" in plan
    assert "ReadSchema: struct<ip:string,status:int>" in plan
    assert one_day.count() > 0


def test_unused_fields_are_not_parsed(spark):
    """Top addresses need one field of the parse; both collections read the written parse."""
    plan = QUERIES["top_ips"](spark, SF_MID)._jdf.queryExecution().optimizedPlan().toString()
    assert " AS ip#" in plan and " AS user_agent#" not in plan and " AS url#" not in plan
    status = _plan(traffic.distribution(common.parsed_stage(spark, SF_MID), "status"))
    assert "ReadSchema: struct<status:int>" in status and "regexp" not in status
