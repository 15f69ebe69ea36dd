"""Batch sources and sinks.

Paths may be any Hadoop-compatible URI (hdfs://, s3a://, file:); existence checks
use the Hadoop FileSystem of the session, never the driver's local disk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Metric record columns of the four forecasters.
METRIC_COLUMNS = ["mse", "rmse", "mae", "r2", "mape", "order", "seasonal_order", "aic",
                  "sarima_order", "sarima_seasonal_order", "sarima_aic", "improvement_over_sarima_pct"]
_STRING_METRICS = {"order", "seasonal_order", "sarima_order", "sarima_seasonal_order"}
METRICS_SCHEMA = T.StructType([
    T.StructField(c, T.StringType() if c in _STRING_METRICS else T.DoubleType()) for c in METRIC_COLUMNS])


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) -> one row per line, column ``value`` (S1). Splittable, so large
    uncompressed logs are read by many tasks (``spark.sql.files.maxPartitionBytes``)."""
    return spark.read.text(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with the schema stored in the files."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Iterable[str] = ()) -> str:
    """Parquet write, overwrite by default; optional partition columns for pruning.

    With partition columns the rows are first clustered by them, large values split and
    small ones merged by size, so that a value gets few files and no task a whole hot value."""
    cols = list(partition_by)
    w = (df.hint("rebalance", *cols) if cols else df).write.mode(mode)
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return path


def write_metrics(df: DataFrame, path: str) -> str:
    """JSON, overwritten (S3). Metric records are one row per model (and series); small
    partitions are merged by size, so a few records make one file and many series several."""
    df.hint("rebalance").write.mode("overwrite").json(path)
    return path


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Read metric JSON with an explicit schema so that NaN stays DOUBLE (S3).

    Columns a record does not have come back NULL, so records of different models
    read into one shape.
    """
    return spark.read.schema(METRICS_SCHEMA).option("allowNonNumericNumbers", "true").json(path)


def write_collection(df: DataFrame, database: str, collection: str, fmt: str = "json",
                     mode: str = "overwrite", root: str | None = None, options: dict | None = None) -> str:
    """Overwrite one named collection of a document store.

    ``fmt`` is any DataFrameWriter format. With a store connector on the classpath
    (e.g. ``fmt='mongodb'``) database and collection go in as options; for a file
    format they name the folder ``root/database/collection``.
    """
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    if root is None:
        w.option("database", database).option("collection", collection).save()
        return f"{database}.{collection}"
    path = f"{root}/{database}/{collection}"
    w.save(path)
    return path


def read_collection(spark: SparkSession, location: str, fmt: str = "json",
                    schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(location)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Literal rows (S5): scoring inputs and metric records."""
    return spark.createDataFrame(rows, schema)


def save_model(model, path: str) -> str:
    """Persist a fitted pipeline, overwriting."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Reload a persisted pipeline."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_fs(spark, path)
    fs.mkdirs(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly in ``path``; none if it does not exist."""
    fs, p = _hadoop_fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_fs(spark, path)
    fs.delete(p, True)


def qualify(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that the session's Hadoop configuration gives it."""
    fs, p = _hadoop_fs(spark, path)
    return fs.makeQualified(p).toString()


def file_states(spark: SparkSession, path: str) -> str:
    """Name, length and modification time of the file at ``path`` or of the files in that folder."""
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return ""
    return ";".join(sorted(f"{f.getPath().getName()},{f.getLen()},{f.getModificationTime()}" for f in fs.listStatus(p)))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A stage output is complete when its ``_SUCCESS`` marker exists."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def materialize(spark: SparkSession, df_fn: Callable[[], DataFrame], path: str,
                force: bool = False, partition_by: Iterable[str] = ()) -> DataFrame:
    """Run a stage only when its output is missing or incomplete; ``force`` re-runs.

    Completeness is the ``_SUCCESS`` marker, not the folder: a pre-created empty
    folder does not count as done. The result is read back from the written
    table, which also cuts the lineage for the stages after it.
    """
    if force or not is_complete(spark, path):
        write_table(df_fn(), path, "overwrite", partition_by)
    return read_table(spark, path)
