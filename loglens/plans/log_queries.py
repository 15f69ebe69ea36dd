"""Registered queries for the log layer and hourly features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import with_cyclical_hour
from ..functions.logparse import LOG_PATTERN, parse_log_time
from ..operators import series, traffic
from ..session import scratch_path
from ..sources import files, stand_in
from . import common
from . import oracle_sql as O
from .registry import register

P = O.P


@register("hourly_traffic", O.with_ctes(*O.HOURLY_CTES, body="SELECT * FROM hourly"))
def q_hourly_traffic(spark, sf):
    """Parsed log -> 1-hour tumbling windows (A3)."""
    return common.hourly(spark, sf)


@register("lag_features", O.with_ctes(*O.FEATURE_CTES, body="SELECT * FROM features"))
def q_lag_features(spark, sf):
    """Hourly series -> prev_count lag -> drop NULL rows."""
    return common.features(spark, sf)


@register("read_log_lines", O.with_ctes(O.LINES, body="SELECT value FROM lines"))
def q_read_log_lines(spark, sf):
    """Raw lines landed as text files, read back one row per line."""
    path = stand_in.write_log_files(spark, sf, scratch_path(spark, "raw"))
    return files.read_log_lines(spark, path)


@register("parse_access_log", O.with_ctes(*O.BASE, body=(
    "SELECT ip, method, url, status, bytes, referrer, user_agent, event_time FROM parsed")))
def q_parse_access_log(spark, sf):
    """Raw lines -> typed log table; malformed lines kept with ''/NULL."""
    return common.parsed(spark, sf)


@register("parse_log_time", O.with_ctes(O.LINES, body=(
    f"SELECT regexp_extract(value, '{P}', 2) AS time_raw, "
    f"timezone('UTC', try_strptime(regexp_extract(value, '{P}', 2), '%d/%b/%Y:%H:%M:%S %z')) AS event_time "
    "FROM lines")))
def q_parse_log_time(spark, sf):
    """Bracketed time field -> UTC timestamp, NULL when absent or invalid."""
    raw = common.lines(spark, sf).select(F.regexp_extract("value", LOG_PATTERN, 2).alias("time_raw"))
    return raw.select("time_raw", parse_log_time(F.col("time_raw")).alias("event_time"))


@register("drop_unparsed", O.with_ctes(*O.BASE, body=(
    "SELECT ip, method, url, status, bytes, referrer, user_agent, event_time FROM parsed "
    "WHERE event_time IS NOT NULL")))
def q_drop_unparsed(spark, sf):
    """Parsed log restricted to rows with a timestamp."""
    return traffic.drop_unparsed(common.parsed_stage(spark, sf))


@register("top_ips", O.with_ctes(*O.BASE, body=(
    "SELECT ip, count(*) AS request_count FROM parsed GROUP BY ip "
    "ORDER BY request_count DESC, ip ASC LIMIT 10")))
def q_top_ips(spark, sf):
    """Ten busiest client addresses, ties by address (A1)."""
    return traffic.top_k(common.parsed(spark, sf), "ip", 10)


@register("status_distribution", O.with_ctes(*O.BASE, body=(
    "SELECT status, count(*) AS count FROM parsed GROUP BY status")))
def q_status_distribution(spark, sf):
    """Requests per status code, NULL (malformed) group kept (A2)."""
    return traffic.distribution(common.parsed(spark, sf), "status")


@register("cyclical_hour", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, request_count, total_bytes, prev_count, "
    "CAST(hour(hour_timestamp) AS INTEGER) AS hour_of_day, "
    "round(sin(2 * pi() * hour(hour_timestamp) / 24.0), 6) + 0.0 AS hour_sin, "
    "round(cos(2 * pi() * hour(hour_timestamp) / 24.0), 6) + 0.0 AS hour_cos FROM features")))
def q_cyclical_hour(spark, sf):
    """Hour of day and its sine/cosine encoding."""
    return common.rounded(common.features(spark, sf).transform(with_cyclical_hour))


@register("row_index", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT hour_timestamp, request_count, "
    "CAST(row_number() OVER (ORDER BY hour_timestamp) - 1 AS BIGINT) AS row_idx FROM features")))
def q_row_index(spark, sf):
    """0-based chronological index."""
    return series.row_index(common.features(spark, sf), "hour_timestamp").select(
        "hour_timestamp", "request_count", "row_idx")


@register("chrono_split", O.with_ctes(*O.FEATURE_CTES, O.SPLIT, body=(
    "SELECT split, count(*) AS n_rows, min(hour_timestamp) AS first_ts, max(hour_timestamp) AS last_ts, "
    "CAST(sum(request_count) AS BIGINT) AS requests FROM split GROUP BY split")))
def q_chrono_split(spark, sf):
    """80/20 chronological split, summarised per side."""
    s = series.chrono_split(common.features(spark, sf), "hour_timestamp")
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("hour_timestamp").alias("first_ts"),
                                  F.max("hour_timestamp").alias("last_ts"),
                                  F.sum("request_count").alias("requests"))


_DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, stat, value FROM (SELECT "
    f"CAST(count({c}) AS DOUBLE) AS \"count\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    f"CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\" FROM features) "
    f"UNPIVOT (value FOR stat IN (\"count\", mean, stddev, \"min\", \"max\"))"
    for c in ("request_count", "prev_count", "total_bytes"))


@register("describe_features", O.with_ctes(*O.FEATURE_CTES, body=_DESCRIBE_SQL))
def q_describe_features(spark, sf):
    """count / mean / sample std / min / max of the feature columns, long form (A5)."""
    return common.rounded(traffic.describe_features(common.features(spark, sf),
                                                    ["request_count", "prev_count", "total_bytes"]))


@register("time_range", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT count(hour_timestamp) AS n_obs, min(hour_timestamp) AS first_ts, "
    "max(hour_timestamp) AS last_ts FROM features")))
def q_time_range(spark, sf):
    """Observation count and first/last hour of the series."""
    return traffic.time_range(common.features(spark, sf), "hour_timestamp")


@register("sorted_sample", O.with_ctes(*O.FEATURE_CTES, body=(
    "SELECT * FROM features ORDER BY hour_timestamp LIMIT 20")))
def q_sorted_sample(spark, sf):
    """First 20 feature rows in time order."""
    return traffic.sorted_sample(common.features(spark, sf), "hour_timestamp", 20)


_TYPE_MAP = ("CASE lower(column_type) WHEN 'timestamp' THEN 'timestamp_ntz' WHEN 'varchar' THEN 'string' "
             "WHEN 'integer' THEN 'int' ELSE lower(column_type) END")


@register("inspect_schema", O.with_ctes(*O.FEATURE_CTES, body=(
    f"SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, {_TYPE_MAP} AS data_type "
    "FROM (DESCRIBE SELECT * FROM features)")))
def q_inspect_schema(spark, sf):
    """Names and types of the feature table."""
    return traffic.inspect_schema(spark, common.features(spark, sf))


@register("lag_features_by_type", O.with_ctes(*O.HOURLY_CTES[:2], O.HOURLY_KEYED, O.FEATURES_KEYED,
                                              body="SELECT * FROM features_k"))
def q_lag_features_by_type(spark, sf):
    """Hourly series per event type with their own lag and NULL drop: the keyed path."""
    return common.features(spark, sf, ["event_type"])
