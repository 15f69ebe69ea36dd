"""DuckDB SQL that states, independently of Spark, what each registered query returns.

The views ``events`` etc. are registered by the checker. Building blocks are CTEs
so that every query text is self-contained.
"""

from __future__ import annotations

# Fixed value: the log grammar, stated here on its own so that a change of the parser's shows.
P = r'^(\S+) - - \[([^\]]+)\] "(\S+) ([^"]+) HTTP/[0-9.]+" (\d{3}) (\d+) "([^"]*)" "([^"]*)" "([^"]*)"'

LINES = """lines AS (
  SELECT event_id, ts, event_type,
    CASE WHEN event_id % 17 = 0 THEN 'garbage ' || CAST(event_id AS VARCHAR)
    ELSE '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)
      || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0330] "GET /' || event_type || '/'
      || CAST(event_id AS VARCHAR) || ' HTTP/1.1" '
      || CAST(CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 201 ELSE 200 END AS VARCHAR)
      || ' ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || ' "-" "agent/1.0" "-"'
    END AS value
  FROM events)"""

PARSED = f"""parsed AS (
  SELECT regexp_extract(value, '{P}', 1) AS ip,
         regexp_extract(value, '{P}', 3) AS method,
         regexp_extract(value, '{P}', 4) AS url,
         TRY_CAST(regexp_extract(value, '{P}', 5) AS INTEGER) AS status,
         TRY_CAST(regexp_extract(value, '{P}', 6) AS BIGINT) AS bytes,
         regexp_extract(value, '{P}', 7) AS referrer,
         regexp_extract(value, '{P}', 8) AS user_agent,
         timezone('UTC', try_strptime(regexp_extract(value, '{P}', 2), '%d/%b/%Y:%H:%M:%S %z')) AS event_time,
         event_type AS src_event_type
  FROM lines)"""

HOURLY = """hourly AS (
  SELECT date_trunc('hour', event_time) AS hour_timestamp, count(*) AS request_count,
         CAST(sum(bytes) AS BIGINT) AS total_bytes
  FROM parsed WHERE event_time IS NOT NULL GROUP BY 1)"""

HOURLY_KEYED = """hourly_k AS (
  SELECT regexp_extract(url, '^/([^/]+)/', 1) AS event_type,
         date_trunc('hour', event_time) AS hour_timestamp, count(*) AS request_count,
         CAST(sum(bytes) AS BIGINT) AS total_bytes
  FROM parsed WHERE event_time IS NOT NULL GROUP BY 1, 2)"""

FEATURES = """features AS (
  SELECT * FROM (
    SELECT hour_timestamp, request_count, total_bytes,
           lag(request_count) OVER (ORDER BY hour_timestamp) AS prev_count
    FROM hourly) t
  WHERE prev_count IS NOT NULL AND total_bytes IS NOT NULL)"""

FEATURES_KEYED = """features_k AS (
  SELECT * FROM (
    SELECT event_type, hour_timestamp, request_count, total_bytes,
           lag(request_count) OVER (PARTITION BY event_type ORDER BY hour_timestamp) AS prev_count
    FROM hourly_k) t
  WHERE prev_count IS NOT NULL AND total_bytes IS NOT NULL)"""

SPLIT = """split AS (
  SELECT *, CASE WHEN row_idx < n_train THEN 'train' ELSE 'test' END AS split FROM (
    SELECT *, CAST(floor(0.8 * n_rows) AS BIGINT) AS n_train FROM (
      SELECT *, CAST(row_number() OVER (ORDER BY hour_timestamp) - 1 AS BIGINT) AS row_idx,
             count(*) OVER () AS n_rows
      FROM features) a) b)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


BASE = (LINES, PARSED)
HOURLY_CTES = (LINES, PARSED, HOURLY)
FEATURE_CTES = (LINES, PARSED, HOURLY, FEATURES)
