"""Shared stages of the registered queries: events -> raw lines -> parsed log -> hourly series."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.logparse import parse_access_log
from ..operators.series import lag_features
from ..operators.traffic import drop_unparsed, windowed_traffic
from ..session import ensure_utc
from ..sources import stand_in

ROUND = 6


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return stand_in.log_lines(spark, sf_dir)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(lines(spark, sf_dir))


def parsed_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed log written once per application and input (S10): consumers read its columns pruned."""
    from ..sources.files import materialize
    return materialize(spark, lambda: parsed(spark, sf_dir), stage_path(spark, "parsed", sf_dir))


def with_event_type(df: DataFrame) -> DataFrame:
    """The event type is the first url path segment of the stand-in log (``/<type>/<id>``)."""
    return df.withColumn("event_type", F.regexp_extract("url", r"^/([^/]+)/", 1))


def parsed_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed log plus the event type (for keyed series)."""
    return with_event_type(parsed_stage(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str, keys: Sequence[str] = (), fill_gaps: bool = False) -> DataFrame:
    src = parsed_typed(spark, sf_dir) if keys else parsed_stage(spark, sf_dir)
    return windowed_traffic(drop_unparsed(src), keys=keys, fill_gaps=fill_gaps)


def features(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """The hourly feature table: hour_timestamp, request_count, total_bytes, prev_count."""
    return lag_features(hourly(spark, sf_dir, keys), keys=keys)


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every DOUBLE column (for value comparison against the SQL oracle); ``+ 0.0``
    turns a rounded -0.0 into 0.0."""
    cols = [(F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if f.dataType.simpleString() in ("double", "float")
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def staged(df: DataFrame) -> DataFrame:
    """Materialise a small intermediate table reused by several jobs and cut its lineage.

    Written as Parquet into a fresh folder under the shared checkpoint folder (never
    executor-local) and read back: one job, and a lost executor later re-reads the
    table instead of recomputing from the raw scan. (``Dataset.checkpoint`` would run
    the lineage twice: once for its count, once for the checkpoint write.)
    """
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, "stage")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_path(spark: SparkSession, name: str, sf_dir: str, keys: Sequence[str] = ()) -> str:
    """Shared-folder path of a stage output for this application and this state of the input:
    rewritten input files (other names, lengths or times) get a new stage."""
    import hashlib
    from ..session import checkpoint_root
    from ..sources.files import file_states
    app = spark.sparkContext.applicationId
    state = file_states(spark, f"{sf_dir}/events.parquet")
    tag = hashlib.sha1(f"{app}:{sf_dir}:{','.join(keys)}:{state}".encode()).hexdigest()[:12]
    return f"{checkpoint_root(spark)}/loglens/stages/{name}-{tag}"


def stage_chain(spark: SparkSession, name: str, sf_dir: str, keys: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """A stage function for a chain of fits: its tables, counted from 0, are written once per application
    and input (S10). A query that fits the same model on the same series reads them instead of fitting again."""
    from ..sources.files import materialize
    number = count()
    return lambda df: materialize(spark, lambda: df, stage_path(spark, f"{name}-{next(number)}", sf_dir, list(keys)))


def features_stage(spark: SparkSession, sf_dir: str, keys: Sequence[str] = (), fill_gaps: bool = False) -> DataFrame:
    """The hourly feature table written once per application and input (S10), then
    read by every model query: the raw log is
    parsed and aggregated once, the models read a table of one row per hour and key.
    With ``fill_gaps`` empty hours are rows of zeros, so that a lag of 24 rows is one of 24 hours."""
    from ..sources.files import materialize
    keys = list(keys)
    name = "features-filled" if fill_gaps else "features"
    return materialize(spark, lambda: lag_features(hourly(spark, sf_dir, keys, fill_gaps), keys=keys), stage_path(spark, name, sf_dir, keys))
