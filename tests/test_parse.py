"""Golden edge lines for the log grammar (FIXTURES.md part D)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loglens.functions.logparse import LOG_PATTERN, parse_access_log

BASE = '1.2.3.4 - - [22/Jan/2019:03:56:16 +0330] "GET /i/1.jpg HTTP/1.1" 200 19939 "https://e/" "Mozilla/5.0" "-"'
T0 = dt.datetime(2019, 1, 22, 0, 26, 16)

# (case, line, matched, event_time, bytes as BIGINT, extra checks)
CASES = [
    ("sample", BASE, True, T0, 19939, {}),
    ("dash bytes", BASE.replace(" 19939 ", " - "), False, None, None, {}),
    ("no ninth field", BASE.rsplit(' "-"', 1)[0], False, None, None, {}),
    ("real user", BASE.replace("- -", "- bob"), False, None, None, {}),
    ("url with spaces", BASE.replace("/i/1.jpg", "/a b  c"), True, T0, 19939, {"url": "/a b  c"}),
    ("trailing text", BASE + ' tail "x"', True, T0, 19939, {}),
    ("empty line", "", False, None, None, {}),
    ("large byte count", BASE.replace(" 19939 ", " 99999999999 "), True, T0, 99999999999, {}),
    ("bad month", BASE.replace("Jan", "Foo"), True, None, 19939, {}),
    ("negative offset", BASE.replace("+0330", "-0500"), True, dt.datetime(2019, 1, 22, 8, 56, 16), 19939, {}),
    ("dollar and backslash", BASE.replace("/i/1.jpg", "/$1\\\\x\\$2"), True, T0, 19939, {"url": "/$1\\\\x\\$2"}),
    ("empty referrer", BASE.replace('"https://e/"', '""'), True, T0, 19939, {"referrer": ""}),
    ("delimiter inside a field", BASE.replace("/i/1.jpg", "/a\u0001b"), True, T0, 19939, {"url": "/a\u0001b"}),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(c[0], c[1]) for c in CASES]
    df = spark.createDataFrame(rows, "case string, value string")
    return {r["case"]: r for r in parse_access_log(df).collect()}


@pytest.mark.parametrize("case,line,matched,ts,nbytes,extra", CASES, ids=[c[0] for c in CASES])
def test_golden(parsed, case, line, matched, ts, nbytes, extra):
    r = parsed[case]
    assert (r["ip"] != "") == matched
    if not matched:
        assert r["method"] == r["url"] == r["referrer"] == r["user_agent"] == ""
        assert r["status"] is None
    assert r["event_time"] == ts
    assert r["bytes"] == nbytes
    for k, v in extra.items():
        assert r[k] == v


def test_int_bytes_overflow_is_null(spark):
    df = spark.createDataFrame([(BASE.replace(" 19939 ", " 99999999999 "),)], "value string")
    r = parse_access_log(df, bytes_type="int").collect()[0]
    assert r["bytes"] is None and r["status"] == 200


def test_single_pass_equals_eight_extracts(spark):
    """The rewrite+split form gives the same fields as one regexp_extract per group."""
    from loglens.sources.stand_in import log_lines
    from tests.conftest import SF_SMALL
    lines = log_lines(spark, SF_SMALL)
    fast = parse_access_log(lines)
    names = ["ip", "time_raw", "method", "url", "status", "bytes", "referrer", "user_agent"]
    slow = lines.select(*[F.regexp_extract("value", LOG_PATTERN, i + 1).alias(n) for i, n in enumerate(names)])
    slow = slow.select("ip", "method", "url", F.col("status").try_cast("int").alias("status"),
                       F.col("bytes").try_cast("bigint").alias("bytes"), "referrer", "user_agent",
                       F.try_to_timestamp("time_raw", F.lit("dd/MMM/yyyy:HH:mm:ss Z")).cast("timestamp_ntz")
                       .alias("event_time"))
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
