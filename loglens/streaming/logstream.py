"""Structured Streaming over the landing folder.

The parse and the window aggregation are the same functions as in batch; only
source and sink differ. State is Spark's built-in windowed aggregate with a
watermark, so late rows beyond the delay are dropped and old windows are evicted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.logparse import parse_access_log
from ..operators.traffic import drop_unparsed
from ..sources import files


def stream_parse_log(stream: DataFrame, filtered: bool = False) -> DataFrame:
    """Stateless: raw line stream -> typed log rows, malformed lines kept."""
    return parse_access_log(stream, filtered=filtered)


def stream_hourly_traffic(stream: DataFrame, delay: str = "1 hour", width: str = "1 hour",
                          keys: Sequence[str] = (),
                          enrich: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Tumbling windows over a parsed stream with a watermark of ``delay``.

    ``enrich`` (optional) adds key columns to the parsed rows. ``withWatermark`` needs
    a TIMESTAMP (not TIMESTAMP_NTZ) column; the session zone is UTC so the cast keeps
    the instant. ``hour_timestamp`` is emitted back as NTZ.
    """
    parsed = drop_unparsed(stream_parse_log(stream, filtered=True))
    if enrich is not None:
        parsed = enrich(parsed)
    parsed = parsed.withColumn("event_ts", F.col("event_time").cast("timestamp"))
    agg = (parsed.withWatermark("event_ts", delay)
           .groupBy(*list(keys), F.window("event_ts", width).alias("time_window"))
           .agg(F.count(F.lit(1)).alias("request_count"), F.sum("bytes").alias("total_bytes")))
    return agg.select(*list(keys), F.col("time_window.start").cast("timestamp_ntz").alias("hour_timestamp"),
                      "request_count", "total_bytes")


BATCH = "batch_id"


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 available_now: bool = True) -> StreamingQuery:
    """Start a stream into a Parquet table at ``path``; ``read_table`` reads it.

    ``append`` uses the exactly-once file sink. ``update`` and ``complete`` write every
    micro-batch into a folder of its own, named by the batch id: earlier batches are
    never touched, and a batch that is repeated after a failure overwrites only itself.
    A ``complete`` batch is the whole result, so only it and the one before it are kept
    (a reader of the old one can finish).
    ``available_now`` processes what has landed and stops.
    """
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    if mode == "append":
        return w.format("parquet").option("path", path).start()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if mode == "complete":
            for old in _finished(batch.sparkSession, path):
                if old < batch_id - 1:
                    files.delete(batch.sparkSession, f"{path}/{BATCH}={old}")

    return w.foreachBatch(write).start()


def _finished(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches whose write has ended."""
    names = files.list_names(spark, path)
    ids = [int(n.split("=", 1)[1]) for n in names if n.startswith(f"{BATCH}=")]
    return sorted(i for i in ids if files.is_complete(spark, f"{path}/{BATCH}={i}"))


def read_table(spark: SparkSession, path: str, mode: str, schema: T.StructType,
               keys: Sequence[str] = ("hour_timestamp",)) -> DataFrame:
    """The current state of a table written by ``run_to_table`` in ``mode``.

    ``complete``: the newest finished batch. ``update``: for each value of ``keys`` its
    row in the newest batch that has one (keys may be null). Without a batch: no rows.
    """
    if mode == "append":
        return spark.read.schema(schema).parquet(path)
    batches = _finished(spark, path)
    if not batches:
        return spark.createDataFrame([], schema)
    if mode == "complete":
        return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batches[-1]}")
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
            .option("basePath", path).parquet(*[f"{path}/{BATCH}={i}" for i in batches]))
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*schema.names), BATCH).alias("row"))
    return last.select("row.*")


def drain(spark: SparkSession, df: DataFrame, path: str, checkpoint: str, mode: str = "append",
          keys: Sequence[str] = ("hour_timestamp",)) -> DataFrame:
    """Run ``df`` with an available-now trigger to completion and read the sink table."""
    q = run_to_table(df, path, checkpoint, mode)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_table(spark, path, mode, df.schema, keys)
