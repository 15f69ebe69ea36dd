"""Stand-in inputs built from the driver's ``events`` table.

The reference consumes an nginx access log that is not shipped. These helpers
only render ``events`` rows in the shape the jobs expect (a ``value`` text
column, or files of such lines); they do none of the jobs' work. The mapping is
a fixed rule of the test setup:

  ip        10.0.<user_id div 256>.<user_id mod 256>
  method    GET
  url       /<event_type>/<event_id>
  status    error -> 500, signup -> 201, otherwise 200
  bytes     round(value * 100)
  time      ts as dd/MMM/yyyy:HH:mm:ss with offset +0330
  tail      "-" "agent/1.0" "-"
  every event_id divisible by 17 becomes the malformed line 'garbage <event_id>'
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test setup (FIXTURES.md part C).
TIME_OFFSET = "+0330"
AGENT = "agent/1.0"
MALFORMED_EVERY = 17


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _ip(user_id: Column) -> Column:
    return F.concat(F.lit("10.0."), F.floor(user_id / 256).cast("string"), F.lit("."),
                    F.pmod(user_id, F.lit(256)).cast("string"))


def _status(event_type: Column) -> Column:
    return (F.when(event_type == "error", 500).when(event_type == "signup", 201).otherwise(200))


def log_line(events: DataFrame) -> Column:
    """Raw access-log text for one ``events`` row."""
    good = F.concat(
        _ip(F.col("user_id")), F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(f" {TIME_OFFSET}] \"GET /"),
        F.col("event_type"), F.lit("/"), F.col("event_id").cast("string"), F.lit(" HTTP/1.1\" "),
        _status(F.col("event_type")).cast("string"), F.lit(" "),
        F.round(F.col("value") * 100).cast("bigint").cast("string"),
        F.lit(f" \"-\" \"{AGENT}\" \"-\""))
    bad = F.concat(F.lit("garbage "), F.col("event_id").cast("string"))
    return F.when(F.col("event_id") % MALFORMED_EVERY == 0, bad).otherwise(good)


def log_lines(spark: SparkSession, sf_dir: str, with_ids: bool = False) -> DataFrame:
    """``DataFrame[value]`` of raw lines (plus ``event_id``/``ts`` when asked)."""
    ev = read_events(spark, sf_dir)
    cols = [log_line(ev).alias("value")]
    if with_ids:
        cols = [F.col("event_id"), F.col("ts"), F.col("event_type")] + cols
    return ev.select(*cols)


def write_log_files(spark: SparkSession, sf_dir: str, path: str, by_day: bool = False) -> str:
    """Land the raw lines as text files under ``path``; optionally one folder per day."""
    lines = log_lines(spark, sf_dir, with_ids=True)
    if by_day:
        (lines.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
         .write.mode("overwrite").partitionBy("day").text(path))
    else:
        lines.select("value").write.mode("overwrite").text(path)
    return path
