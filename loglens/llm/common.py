"""Shared pieces of the corpus operators: table access, written stages, fresh column names."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: A word of the operators' contracts, and the white space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
#: Every byte of a text: A-Z in lower case, other ASCII signs than letters and digits as a space, the rest as it is.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def letter_words(text: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text whose A-Z are lower-cased."""
    return text.translate(_LETTERS).split()


def as_bytes(texts: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column, null as none."""
    return [t or b"" for t in texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()]


def small_batches(spark: SparkSession) -> None:
    """Send fewer whole texts at a time to Python workers than Spark's 10,000 rows, unless the session says otherwise."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, by a path that only Spark has to understand."""
    ship_package(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-computation.
    The folder goes when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keyed(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a 64-bit key of each row's values, and the key's name. Equal rows share their key."""
    name = fresh(df, "row_key")
    values = [F.col(f"`{c}`").cast("string") if "map<" in kind else F.col(f"`{c}`") for c, kind in df.dtypes]
    return df.withColumn(name, F.xxhash64(*values)), name


def numbered(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``df`` with the number, from 1, of each row among those of its key, and that column's name."""
    name = fresh(df, "row_number")
    return df.withColumn(name, F.row_number().over(W.partitionBy(key).orderBy(key))), name


def whole_text(col: str | Column) -> Column:
    """The text, null as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null ids stay null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def prefix_sums(df: DataFrame, group: list[str], bucket: str, order: list, value: str | Column | list, out: str | list[str]) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group; lists of both give several sums at once.

    Rows of a group are ordered by ``bucket``, then by ``order``. Only the rows of one bucket are
    ever sorted in one task; buckets are joined by their sums, so a group may hold any share of all
    rows. ``group`` and ``bucket`` must not be null; the sums are longs."""
    values, outs = (x if isinstance(x, list) else [x] for x in (value, out))
    values = [F.col(v) if isinstance(v, str) else v for v in values]
    keys, before = [*group, bucket], [fresh(df, f"before{i}") for i in range(len(values))]
    sums = df.groupBy(*keys).agg(*[F.sum(v).alias(b) for v, b in zip(values, before)])
    above = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*keys, *[F.coalesce(F.sum(b).over(above), F.lit(0)).alias(b) for b in before])
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    both = df.join(sums, keys)
    totals = [(F.col(b) + F.coalesce(F.sum(v).over(inside), F.lit(0))).cast("long").alias(o) for v, b, o in zip(values, before, outs)]
    return both.select(*[c for c in both.columns if c not in before], *totals)
