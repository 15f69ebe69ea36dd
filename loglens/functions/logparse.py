"""Access-log grammar and tolerant scalar conversions.

The grammar is start-anchored, not end-anchored: anything after the ninth quoted
field is ignored. Lines that do not match are kept with '' strings and NULL
numbers/time, as ``regexp_extract`` + cast would give.

One regular-expression pass per line: ``regexp_replace`` rewrites a matching line
(pattern extended to the end of the line) into its eight fields joined by a control
character and ``split`` cuts them apart; a non-matching line comes back unchanged.
For a line without that control character, exactly eight parts means it matched.
Lines that contain the character take the exact slow path (``rlike`` + one
``regexp_extract`` per field), inside the same CASE so other lines never run it.

The regex work sits in its own projection (referenced by all eight fields, so the
optimizer does not inline it eight times); fields that nobody reads are pruned. A filter
on a parsed field in the same plan would be pushed below both projections and drag a
second copy of the regex into the scan: batch jobs filter the written parsed table, and
``filtered=True`` (streams, ``on_malformed='drop'``) takes the fields out of an
``inline`` generator, which stops the push-down at the price of the pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The log grammar and time format of the reference parser.
LOG_PATTERN = r'^(\S+) - - \[([^\]]+)\] "(\S+) ([^"]+) HTTP/[0-9.]+" (\d{3}) (\d+) "([^"]*)" "([^"]*)" "([^"]*)"'
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
FIELDS = ["ip", "time_raw", "method", "url", "status", "bytes", "referrer", "user_agent"]

_SEP = "\u0001"
_FULL_LINE = "(?s)" + LOG_PATTERN + ".*$"
_TEMPLATE = _SEP.join(f"${i}" for i in range(1, 9))


def to_int(c: Column, kind: str = "int") -> Column:
    """String -> number, NULL when not a number or out of range."""
    return c.try_cast(kind)


def parse_log_time(c: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss Z`` -> timestamp (offset applied), NULL on failure.

    Returned as TIMESTAMP_NTZ holding UTC wall-clock time (session zone is UTC).
    """
    return F.try_to_timestamp(c, F.lit(LOG_TIME_FORMAT)).cast("timestamp_ntz")


def _split_fields(value: Column) -> list[Column]:
    """Projection 1: the delimiter test and the one-pass rewrite."""
    return [(F.instr(value, _SEP) > 0).alias("_has_sep"),
            F.split(F.regexp_replace(value, _FULL_LINE, _TEMPLATE), _SEP, -1).alias("_parts")]


def _fields(value: Column) -> list[Column]:
    """Projection 2: the eight raw string fields, '' when the line is malformed."""
    fast = ~F.col("_has_sep") & (F.size("_parts") == 8)
    slow = F.col("_has_sep") & value.rlike(LOG_PATTERN)
    return [F.when(fast, F.col("_parts").getItem(i))
             .when(slow, F.regexp_extract(value, LOG_PATTERN, i + 1))
             .otherwise(F.lit("")).alias(name) for i, name in enumerate(FIELDS)]


def log_fields(lines: DataFrame, value_col: str = "value", filtered: bool = False) -> DataFrame:
    """Raw lines -> other columns + the eight raw string fields."""
    other = [c for c in lines.columns if c != value_col]
    v = F.col(value_col)
    a = lines.select(*other, v, *_split_fields(v))
    return a.select(*other, F.inline(F.array(F.struct(*_fields(v))))) if filtered else a.select(*other, *_fields(v))


def parse_access_log(lines: DataFrame, value_col: str = "value", on_malformed: str = "keep",
                     bytes_type: str = "bigint", filtered: bool = False) -> DataFrame:
    """Raw lines -> ``ip, method, url, status, bytes, referrer, user_agent, event_time``.

    ``on_malformed='keep'`` (reference behaviour) keeps unmatched lines with ''/NULL;
    ``'drop'`` removes them. ``bytes`` is BIGINT (the reference's INT turns counts
    above 2^31-1 into NULL; pass ``bytes_type='int'`` for that). ``filtered`` says that the
    caller filters on parsed fields in the same plan (see the module text).
    """
    other = [c for c in lines.columns if c != value_col]
    raw = log_fields(lines, value_col, filtered or on_malformed == "drop")
    if on_malformed == "drop":
        raw = raw.filter(F.col("ip") != "")
    elif on_malformed != "keep":
        raise ValueError("on_malformed must be 'keep' or 'drop'")
    return raw.select(
        *other, "ip", "method", "url",
        to_int(F.col("status"), "int").alias("status"),
        to_int(F.col("bytes"), bytes_type).alias("bytes"),
        "referrer", "user_agent",
        parse_log_time(F.col("time_raw")).alias("event_time"))
