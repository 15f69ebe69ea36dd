"""Registered queries for sinks, stage reuse, landing files, archives and streams
(S2, S4, S7-S10, T1, T2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import traffic
from ..session import scratch_path
from ..sources import files, landing, stand_in
from ..streaming import logstream
from . import common
from . import oracle_sql as O
from .registry import register

PARSED_COLS = ["ip", "method", "url", "status", "bytes", "referrer", "user_agent", "event_time"]


@register("parquet_roundtrip", O.with_ctes(*O.BASE, body=(
    "SELECT ip, method, url, status, bytes, referrer, user_agent, event_time, "
    "CAST(event_time AS DATE) AS event_date FROM parsed")))
def q_parquet_roundtrip(spark, sf):
    """Parsed log written as Parquet partitioned by day, read back with its stored schema."""
    p = common.parsed(spark, sf).withColumn("event_date", F.to_date("event_time"))
    path = files.write_table(p, scratch_path(spark, "parsed"), partition_by=["event_date"])
    return files.read_table(spark, path).select(*PARSED_COLS, "event_date")


@register("write_collection", O.with_ctes(*O.BASE, body=(
    "SELECT 'top_ips' AS collection, ip AS key, request_count AS count FROM ("
    "SELECT ip, count(*) AS request_count FROM parsed GROUP BY ip ORDER BY request_count DESC, ip LIMIT 10) "
    "UNION ALL SELECT 'status_codes', CAST(status AS VARCHAR), count(*) FROM parsed GROUP BY status")))
def q_write_collection(spark, sf):
    """Top addresses and status counts overwritten into two store collections, read back."""
    p = common.parsed_stage(spark, sf)
    root = scratch_path(spark, "store")
    top = files.write_collection(traffic.top_k(p, "ip", 10), "logs_db", "top_ips", root=root)
    st = files.write_collection(traffic.distribution(p, "status"), "logs_db", "status_codes", root=root)
    a = files.read_collection(spark, top, schema="ip string, request_count bigint")
    b = files.read_collection(spark, st, schema="status int, count bigint")
    return (a.select(F.lit("top_ips").alias("collection"), F.col("ip").alias("key"), F.col("request_count").alias("count"))
            .unionByName(b.select(F.lit("status_codes").alias("collection"), F.col("status").cast("string").alias("key"),
                                  "count")))


@register("materialize", O.with_ctes(*O.FEATURE_CTES, body="SELECT * FROM features"))
def q_materialize(spark, sf):
    """Feature stage written only when its output is incomplete: a pre-created empty
    folder is not mistaken for a finished stage; a second call reuses the table (S10)."""
    path = scratch_path(spark, "features")
    files.make_dirs(spark, path)                       # folder exists, stage not done
    if files.is_complete(spark, path):
        raise RuntimeError("an empty folder must not count as a finished stage")
    first = files.materialize(spark, lambda: common.features(spark, sf), path)

    def must_not_rerun():
        raise RuntimeError("materialize re-ran a completed stage")

    again = files.materialize(spark, must_not_rerun, path)
    return again.select(*first.columns)


@register("landing_manifest", O.with_ctes(O.LINES, body=(
    "SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(sum(strlen(value) + 1) AS BIGINT) AS size_bytes, "
    "CAST(sum(strlen(value) + 1) AS BIGINT) AS expected_bytes, true AS size_ok FROM lines GROUP BY 1")))
def q_landing_manifest(spark, sf):
    """Files landed per day: size on storage against the bytes that were sent."""
    root = scratch_path(spark, "landing")
    stand_in.write_log_files(spark, sf, root, by_day=True)
    man = landing.landing_manifest(spark, root).withColumn("day", F.regexp_extract("path", r"day=([0-9-]+)", 1))
    landed = man.groupBy("day").agg(F.sum("size_bytes").alias("size_bytes"))
    sent = (stand_in.log_lines(spark, sf, with_ids=True)
            .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
            .agg(F.sum(F.octet_length("value") + 1).cast("bigint").alias("expected_bytes")))
    return (landed.join(sent, on="day", how="full")
            .select("day", "size_bytes", "expected_bytes",
                    F.coalesce(F.col("size_bytes") == F.col("expected_bytes"), F.lit(False)).alias("size_ok")))


@register("archive_ingest", O.with_ctes(O.LINES, body=(
    "SELECT strftime(ts, '%Y-%m-%d') || '-' || lpad(CAST(event_id // 100000 AS VARCHAR), 5, '0') || '.zip' "
    "AS archive, event_type || '.log' AS member, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), "
    "event_id // 100000, event_type ORDER BY event_id) AS line_no, value FROM lines")))
def q_archive_ingest(spark, sf):
    """Zip archives (per day and id block; a folder entry and one member per event type) -> member lines."""
    root = scratch_path(spark, "archives")
    landing.write_day_archives(stand_in.log_lines(spark, sf, with_ids=True), root).write.format("noop").mode("overwrite").save()
    return landing.archive_ingest(spark, f"{root}/*.zip").select("archive", "member", "line_no", "value")


@register("stream_parse_log", O.with_ctes(*O.BASE, body=(
    "SELECT ip, method, url, status, bytes, referrer, user_agent, event_time FROM parsed")))
def q_stream_parse_log(spark, sf):
    """Landed raw files streamed through the batch parser into a Parquet sink."""
    land = stand_in.write_log_files(spark, sf, scratch_path(spark, "landing"))
    stream = landing.landing_stream(spark, land)
    out = logstream.drain(spark, logstream.stream_parse_log(stream), scratch_path(spark, "stream-out"),
                          scratch_path(spark, "stream-ckpt"), "append")
    return out.select(*PARSED_COLS)


@register("stream_hourly_traffic", O.with_ctes(*O.HOURLY_CTES, body="SELECT * FROM hourly"))
def q_stream_hourly_traffic(spark, sf):
    """Hourly windows with a 1-hour watermark, complete mode (equals the batch result)."""
    land = stand_in.write_log_files(spark, sf, scratch_path(spark, "landing"))
    agg = logstream.stream_hourly_traffic(landing.landing_stream(spark, land), "1 hour")
    return logstream.drain(spark, agg, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt"),
                           "complete")


@register("stream_hourly_append", O.with_ctes(*O.HOURLY_CTES, body=(
    "SELECT * FROM hourly WHERE hour_timestamp + INTERVAL 1 HOUR <= "
    "(SELECT max(event_time) FROM parsed) - INTERVAL 1 HOUR")))
def q_stream_hourly_append(spark, sf):
    """Append mode: only windows closed by the watermark (end <= max time - delay)."""
    land = stand_in.write_log_files(spark, sf, scratch_path(spark, "landing"))
    agg = logstream.stream_hourly_traffic(landing.landing_stream(spark, land), "1 hour")
    return logstream.drain(spark, agg, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt"),
                           "append")


@register("stream_hourly_update", O.with_ctes(*O.HOURLY_CTES, body="SELECT * FROM hourly"))
def q_stream_hourly_update(spark, sf):
    """Update mode, a few files per trigger: each batch writes its changed windows, the newest row of
    each window is read (T2). The watermark is as long as the log, so files may land in any order."""
    land = stand_in.write_log_files(spark, sf, scratch_path(spark, "landing"), by_day=True)
    stream = landing.landing_stream(spark, f"{land}/*", max_files_per_trigger=16)
    agg = logstream.stream_hourly_traffic(stream, "3660 days")
    return logstream.drain(spark, agg, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt"),
                           "update")


@register("stream_hourly_by_type", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, body="SELECT * FROM hourly_k"))
def q_stream_hourly_by_type(spark, sf):
    """Keyed streaming state: hourly windows per event type (taken from the url path)."""
    land = stand_in.write_log_files(spark, sf, scratch_path(spark, "landing"))
    agg = logstream.stream_hourly_traffic(landing.landing_stream(spark, land), "1 hour", keys=["event_type"],
                                          enrich=common.with_event_type)
    return logstream.drain(spark, agg, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt"),
                           "complete")
