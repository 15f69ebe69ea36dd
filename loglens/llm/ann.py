"""Approximate nearest neighbours with a permutation index (operator 8).

A vector is represented by its ``NEAREST`` nearest pivots in order. Every vector is posted, with
the pivot's place in its order, in the inverted file of each of those pivots. A query walks the
files of its own pivots; a vector's footrule distance (places of shared pivots apart; a pivot that
one side lacks counts as last) falls by 2 * (NEAREST - larger place) for each pivot they share,
so it is summed from the files alone. The nearest ``SHARE`` of each block by footrule distance
(``LEAST`` at least, ties all in) is reranked by the exact cosine in double precision.

Vectors and queries are dealt into blocks; each pair of blocks is one task's work, and only its
best rows go on. Pivots are a bounded sample (``PIVOTS``, by hash of the id); every vector is
indexed. Recall against brute force is measured in the tests (0.9 is the least allowed).

Defined results: a null id, or a vector that is null, empty, zero or has null or non-finite
components, takes no part; nor has one whose length is not the most common one (ties: the
longer); a repeated id counts as one row with its best score, and is never its own neighbour.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged, table

PIVOTS, NEAREST = 512, 64
SHARE, LEAST = 0.1, 512
VECTORS, QUERIES = 8192, 2048           # of a block
_FOUND = "query_id long, vec_id long, score double"


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def orders(units: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """Each vector's ``k`` nearest pivots, nearest first."""
    near = units @ pivots.T
    part = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < len(pivots) else np.tile(np.arange(len(pivots)), (len(units), 1))
    own = np.take_along_axis(near, part, 1)
    return np.take_along_axis(part, np.lexsort((part, -own), axis=1), 1)


class Files:
    """Inverted files: for each pivot the vectors that have it, and the gain of its place there."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        n, self.k = order.shape
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        self.start = np.searchsorted(flat[by], np.arange(n_pivots + 1))
        self.vector, self.place = by // self.k, by % self.k
        self.n = n

    def closeness(self, order: np.ndarray) -> np.ndarray:
        """k (k + 1) less the footrule distance, of every vector to one query."""
        spans = [slice(self.start[p], self.start[p + 1]) for p in order]
        found = np.concatenate([self.vector[s] for s in spans])
        gain = np.concatenate([2 * (self.k - np.maximum(self.place[s], at)) for at, s in enumerate(spans)])
        return np.bincount(found, weights=gain, minlength=self.n)


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, top: int) -> list[tuple[int, int, float]]:
    """(query, vector, cosine) of the ``top`` best found in the block for each query."""
    units, out = _unit(vectors), []
    k = min(NEAREST, len(pivots))
    files = Files(orders(units, pivots, k), len(pivots))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    m = min(len(ids), max(LEAST, math.ceil(SHARE * len(ids))))
    for q_id, q, order in zip(query_ids, queries, orders(_unit(queries), pivots, k)):
        close = files.closeness(order)
        near = np.flatnonzero(close >= np.partition(close, len(ids) - m)[len(ids) - m])
        near = near[ids[near] != q_id]
        cosine = (vectors[near] * q).sum(axis=1) / (norms[near] * np.sqrt((q * q).sum()))
        seen: set[int] = set()
        for i in np.lexsort((ids[near], -cosine)):
            v = int(ids[near[i]])
            if v not in seen:
                out.append((int(q_id), v, float(cosine[i])))
                seen.add(v)
                if len(seen) == top:
                    break
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id long, v array<double>) of the rows that take part, but for their length."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    fine = "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return rows.where(F.expr(fine)).where(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)").between(1e-300, 1e300))


def search(vectors: DataFrame, query_mod: int = 50, top: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``query_mod`` its nearest other rows."""
    spark = vectors.sparkSession
    rows = staged(usable(vectors, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % query_mod == 0, 1)).alias("q")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None or not sizes["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == sizes["d"])
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "row").limit(4 * PIVOTS).select("v").collect()
    pivots = np.unique(_unit(np.array([r["v"] for r in sample])), axis=0)
    pivots = pivots[np.random.default_rng(0).permutation(len(pivots))[:PIVOTS]]
    shared = spark.sparkContext.broadcast(pivots)       # PIVOTS vectors

    n_blocks, n_queries = -(-sizes["n"] // VECTORS), -(-sizes["q"] // QUERIES)
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    base = rows.select(deal(n_blocks, 1).alias("block"), numbers(n_queries).alias("q_block"), F.lit(False).alias("query"), "vec_id", "v")
    asked = rows.where(F.col("vec_id") % query_mod == 0).select(numbers(n_blocks).alias("block"), deal(n_queries, 2).alias("q_block"), F.lit(True).alias("query"), "vec_id", "v")

    def cell(frame: pd.DataFrame) -> pd.DataFrame:
        q, b = frame[frame["query"]], frame[~frame["query"]]
        found = search_block(b["vec_id"].to_numpy(), np.stack(b["v"]), q["vec_id"].to_numpy(), np.stack(q["v"]), shared.value, top) if len(q) and len(b) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = base.unionByName(asked).groupBy("block", "q_block").applyInPandas(cell, _FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
