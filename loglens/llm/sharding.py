"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix (operator 5).

How many rows each input partition sends to each shard is drawn first: for one partition after the
other from the multivariate hypergeometric law of the places that are left, so the matrix has the
law it would have under a uniform permutation of all rows, its rows sum to the partitions and its
columns to the shards. Each partition is then permuted on its own and cut by its row of the
matrix, the rows are exchanged, and each shard is permuted again. Law: ``rows``; shard sizes differ
by one at most, whatever the keys or texts are, and equal texts need not share a shard.

The driver holds the matrix only: partitions times shards whole numbers. Shards are permuted in
buckets of random keys, so that no task holds a shard.

Defined results: a null text has no bytes; repeated rows are rows like others; an empty table has
no rows; a column named like an output is replaced, all others stay.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, prefix_sums, staged, table, whole_text

SHARDS = 16
ROWS = 1024                 # of a bucket of a shard, on average
_NUMPY = 10 ** 9            # numpy's law takes populations below this


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` places drawn without replacement are among ``good``."""
    if not good or not bad or n in (0, good + bad):
        return good * n // max(1, good + bad)
    if good + bad < _NUMPY:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    left = rng.random()
    up = down = math.exp(choose(good, mode) + choose(bad, n - mode) - choose(good + bad, n))
    left -= up
    above, below = mode, mode
    while left > 0 and (above < high or below > low):       # outwards from the mode, by ratios of neighbours
        if above < high:
            up *= (good - above) * (n - above) / ((above + 1) * (bad - n + above + 1))
            above += 1
            left -= up
            if left <= 0:
                return above
        if below > low:
            down *= below * (bad - n + below) / ((good - below + 1) * (n - below + 1))
            below -= 1
            left -= down
            if left <= 0:
                return below
    return mode


def matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard."""
    rng, n = np.random.default_rng(seed), sum(counts)
    places = [n // shards + (s < n % shards) for s in range(shards)]
    out = []
    for count in counts:
        row, rest, left = [], sum(places), count
        for place in places:
            drawn = hypergeometric(rng, place, rest - place, left)
            row.append(drawn)
            rest -= place
            left -= drawn
        places = [p - r for p, r in zip(places, row)]
        out.append(row)
    return out


def shuffle(df: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard) to every row."""
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    row, part, ends, bucket, key = (fresh(df, x) for x in ("row", "part", "ends", "bucket", "key"))
    rows = staged(df.withColumn(row, F.monotonically_increasing_id()).withColumn(part, F.spark_partition_id()), "rows")
    counts = rows.groupBy(part).agg(F.count("*").alias("n")).orderBy(part).collect()       # a number for each partition
    drawn = matrix([r["n"] for r in counts], shards, seed)
    cuts = spark.createDataFrame([(r[part], np.cumsum(d).tolist()) for r, d in zip(counts, drawn)], f"`{part}` int, `{ends}` array<long>")
    local = F.row_number().over(W.partitionBy(part).orderBy(F.xxhash64(row, F.lit(2 * seed + 1)), row))
    sent = rows.join(cuts, part).withColumn(key, local)
    sent = sent.withColumn("shard", F.expr(f"cast(size(filter(`{ends}`, x -> x < `{key}`)) as int)")).drop(ends, part)
    n_buckets = max(1, -(-sum(r["n"] for r in counts) // (shards * ROWS)))
    again = sent.withColumn(key, F.xxhash64(row, F.lit(2 * seed + 2))).withColumn(bucket, F.expr(f"(shiftrightunsigned(`{key}`, 32) * {n_buckets}) div {1 << 32}"))
    order = [F.col(key).bitwiseAND(F.lit((1 << 32) - 1)), F.col(key), F.col(row)]
    return prefix_sums(again, ["shard"], bucket, order, F.lit(1), "slot").drop(row, key, bucket)


def write(shuffled: DataFrame, path: str) -> str:
    """Parquet below ``path``, a folder for each shard, rows in the order of their slots."""
    shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = whole_text("text")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
