"""Hard-negative mining with an inverted multi-index (operator 13).

Vectors are cut into two halves, and each half has a codebook of its own; the pair of a vector's
nearest codewords is its cell. For an anchor, codeword i of a half bounds the half's scores by
anchor . codeword + |anchor| * radius, the radius being the largest distance of the half's vectors
from the codeword. The bounds of both halves, sorted, make a grid whose cells a heap visits by their
sum (multi-sequence), highest first. A search stops when no cell that is left can have a row for it,
so its result is exact: positives, when the least found beats the next bound; a window of negatives,
when it is full and its last beats the next bound, or the next bound is below the window. Cells that
lie above every window by their lower bounds are passed over.

Vectors and anchors are dealt into blocks; each pair of blocks is one task's work, with an index of
the block's vectors, and only its best rows go on. First all blocks give the anchors' positives;
those fix the windows, and all blocks give the negatives in them. Codebooks come from a bounded
sample (``SAMPLE`` vectors, by hash of the id); all vectors are indexed and results do not depend on
the sample.

Defined results: rows whose id, label or vector is null, or whose vector has null or non-finite
components, take no part; nor do those with a scaled component beyond 2^31 / sqrt(length), as scores
would not fit a long, or with another length than the most common (ties: the longer). Of rows that
repeat an id the least (by label, then vector) takes part. Anchors without positives, and positives
without negatives in their window, have no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged, table

SCALE = 256
CODEWORDS, SAMPLE, ROUNDS = 16, 4096, 8         # of a half; vectors and rounds of k-means
VECTORS, ANCHORS = 8192, 2048                   # of a block
LEAST_ROWS = 256                                # scored at once, doubled as a search goes on


def codebook(x: np.ndarray, k: int = CODEWORDS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of k-means from evenly spaced starts."""
    c = x[np.unique(np.linspace(0, len(x) - 1, min(k, len(x))).astype(int))].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        for i in range(len(c)):
            if (near == i).any():
                c[i] = x[near == i].mean(axis=0)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)


class MultiIndex:
    """Rows of a block by cell. ``x``: whole numbers, as doubles or longs."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.books, self.half = books, books[0].shape[1]
        halves = x[:, :self.half].astype(float), x[:, self.half:].astype(float)
        codes = [nearest(h, c) for h, c in zip(halves, books)]
        self.radius = []
        for h, c, code in zip(halves, books, codes):
            far = np.full(len(c), -np.inf)
            np.maximum.at(far, code, np.sqrt(((h - c[code]) ** 2).sum(axis=1)))
            self.radius.append(far)
        self.width = len(books[1])
        cell = codes[0] * self.width + codes[1]
        order = np.argsort(cell, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.start = np.searchsorted(cell[order], np.arange(len(books[0]) * self.width + 1))

    def cells(self, q: np.ndarray, above: float) -> Iterator[tuple[float, int, int]]:
        """(bound, first row, end) of the cells by falling bound; those whose rows all score over ``above`` are left out."""
        parts = q[:self.half].astype(float), q[self.half:].astype(float)
        middle = [c @ p for c, p in zip(self.books, parts)]
        reach = [np.sqrt(p @ p) * r for p, r in zip(parts, self.radius)]
        upper, lower = [m + r for m, r in zip(middle, reach)], [m - r for m, r in zip(middle, reach)]
        sides = [np.argsort(-u, kind="stable") for u in upper]
        sides = [[int(i) for i in s if self.radius[h][i] >= 0] for h, s in enumerate(sides)]      # codewords with rows
        if not sides[0]:
            return
        (a, b), start, width = sides, self.start, self.width
        (up_a, up_b), (low_a, low_b) = upper, lower
        heap = [(-(up_a[a[0]] + up_b[b[0]]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(b):
                heapq.heappush(heap, (-(up_a[a[i]] + up_b[b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(up_a[a[i + 1]] + up_b[b[0]]), i + 1, 0))
            cell = a[i] * width + b[j]
            low = low_a[a[i]] + low_b[b[j]]
            if start[cell] < start[cell + 1] and low - 1 - 1e-9 * abs(low) <= above:
                yield -bound + 1 + 1e-9 * abs(bound), start[cell], start[cell + 1]       # rounding only widens a bound

    def search(self, q: np.ndarray, take: Callable[[np.ndarray, np.ndarray, float], bool], above: float = np.inf) -> None:
        """Give ``take`` rows and their scores, and the bound of the rows after them, until it wants no more."""
        held, n, wanted = [], 0, LEAST_ROWS
        for bound, first, end in self.cells(q, above):
            if n >= wanted:
                rows = np.concatenate(held)
                if take(rows, self.x[rows] @ q, bound):
                    return
                held, n, wanted = [], 0, 2 * wanted
            held.append(np.arange(first, end))
            n += end - first
        if n:
            rows = np.concatenate(held)
            take(rows, self.x[rows] @ q, -np.inf)


class Best:
    """The first ``top`` rows by falling score, then id, whose score is in [low, high]."""

    def __init__(self, top: int, low: float = -np.inf, high: float = np.inf):
        self.top, self.low, self.high = top, low, high
        self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fine = (scores >= self.low) & (scores <= self.high)
        if len(self.ids) == self.top:
            fine &= scores >= self.scores[-1]
        if fine.any():
            ids, scores = np.concatenate([self.ids, ids[fine]]), np.concatenate([self.scores, scores[fine].astype(np.int64)])
            order = np.lexsort((ids, -scores))[:self.top]
            self.ids, self.scores = ids[order], scores[order]

    def certified(self, bound: float) -> bool:
        """Whether no row with a score up to ``bound`` belongs in."""
        return bound < self.low or (len(self.ids) == self.top and bound < self.scores[-1])


def window_of(score: int, least: int, most: int) -> tuple[int, int]:
    """The whole numbers n with least * score <= 100 * n <= most * score."""
    return -(-least * score // 100), most * score // 100


def positives_in(index: MultiIndex, anchor: int, label: int, q: np.ndarray, top: int) -> Best:
    best = Best(top)

    def take(rows: np.ndarray, scores: np.ndarray, bound: float) -> bool:
        own = (index.labels[rows] == label) & (index.ids[rows] != anchor)
        best.add(index.ids[rows][own], scores[own])
        return best.certified(bound)

    index.search(q, take)
    return best


def negatives_in(index: MultiIndex, label: int, q: np.ndarray, windows: list[tuple[int, int]], top: int) -> list[Best]:
    best = [Best(top, low, high) for low, high in windows]

    def take(rows: np.ndarray, scores: np.ndarray, bound: float) -> bool:
        other = index.labels[rows] != label
        ids, scores = index.ids[rows][other], scores[other]
        for b in best:
            if not b.certified(np.inf):
                b.add(ids, scores)
        return all(b.certified(bound) for b in best)

    index.search(q, take, max(high for _, high in windows))
    return best


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label (longs), v of the rows that take part, but for their length. Ids are unique."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v")).where("vec_id is not null and label is not null and v is not null")
    fine = f"forall(v, x -> x is not null and not isnan(x) and abs({scale} * cast(x as double)) * sqrt(size(v)) <= 2147483648D)"
    return rows.where(F.expr(fine))


def unique_ids(rows: DataFrame) -> DataFrame:
    """One row of each id: the least by label, then vector."""
    repeated = rows.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if repeated.isEmpty():
        return rows
    least = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("least")).select("vec_id", "least.label", "least.v")
    return rows.join(repeated, "vec_id", "left_anti").unionByName(least)


def _matrix(column: pa.ChunkedArray, d: int, scale: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(float(scale) * flat.astype(float)).reshape(len(column), d)


def _exact(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where all scores are exact in them, else as longs."""
    most = np.abs(x).max(initial=0.0) * np.abs(q).max(initial=0.0) * max(1, x.shape[1])
    return (x, q) if most < 2 ** 53 else (x.astype(np.int64), q.astype(np.int64))


def mine(vectors: DataFrame, anchor_mod: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         block: int = VECTORS, anchor_block: int = ANCHORS, codewords: int = CODEWORDS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each id divisible by ``anchor_mod`` and each of its ``positives`` best other rows of its label: the first
    ``negatives`` rows of other labels that score ``least`` to ``most`` per cent of the positive's score."""
    spark = vectors.sparkSession
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = staged(unique_ids(usable(vectors, id_col, vector_col, label_col, scale)), "candidates")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % anchor_mod == 0, 1)).alias("q")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None or not sizes["q"]:
        return spark.createDataFrame([], empty)
    d = sizes["d"]
    rows = rows.where(F.size("v") == d)
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(SAMPLE).select("v").collect()
    x = np.floor(float(scale) * np.array([r["v"] for r in sample], float).reshape(len(sample), d))
    shared = spark.sparkContext.broadcast((codebook(x[:, :d // 2], codewords), codebook(x[:, d // 2:], codewords)))      # 2 * codewords halves

    n_blocks, n_asked = -(-sizes["n"] // block), -(-sizes["q"] // anchor_block)
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    base = rows.select(deal(n_blocks, 1).alias("block"), numbers(n_asked).alias("asked"), "vec_id", "label", "v").groupBy("block", "asked")
    anchors = staged(rows.where(F.col("vec_id") % anchor_mod == 0).select(deal(n_asked, 2).alias("asked"), "vec_id", "label", "v"), "anchors")

    def indexed(left: pa.Table, right: pa.Table) -> Iterator[tuple[MultiIndex, int, int, int, np.ndarray]]:
        """(index, place, anchor, label, vector) of each anchor."""
        if not len(left) or not len(right):
            return
        x, q = _exact(_matrix(left["v"], d, scale), _matrix(right["v"], d, scale))
        index = MultiIndex(left["vec_id"].to_numpy(), left["label"].to_numpy(), x, shared.value)
        for at, (anchor, label) in enumerate(zip(right["vec_id"].to_pylist(), right["label"].to_pylist())):
            yield index, at, anchor, label, q[at]

    def longs(columns: dict[str, list]) -> pa.Table:
        return pa.table({k: pa.array(np.concatenate(v) if v else [], pa.int64()) for k, v in columns.items()})

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor_id": [], "positive_id": [], "positive_score": []}
        for index, _, anchor, label, q in indexed(left, right):
            best = positives_in(index, anchor, label, q, positives)
            for name, values in zip(out, (np.full(len(best.ids), anchor), best.ids, best.scores)):
                out[name].append(values)
        return longs(out)

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor_id": [], "positive_id": [], "positive_score": [], "negative_id": [], "negative_score": []}
        found = right["found"].to_pylist()
        for index, at, anchor, label, q in indexed(left, right):
            windows = [window_of(p["positive_score"], least, most) for p in found[at]]
            for p, best in zip(found[at], negatives_in(index, label, q, windows, negatives)):
                n = len(best.ids)
                for name, values in zip(out, (np.full(n, anchor), np.full(n, p["positive_id"]), np.full(n, p["positive_score"]), best.ids, best.scores)):
                    out[name].append(values)
        return longs(out)

    def search(asked: DataFrame, find: Callable[[pa.Table, pa.Table], pa.Table], fields: str) -> DataFrame:
        spread = asked.withColumn("block", numbers(n_blocks))
        return base.cogroup(spread.groupBy("block", "asked")).applyInArrow(find, fields)

    found = search(anchors, find_positives, "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    best = staged(found.withColumn("rank", rank).where(F.col("rank") <= positives).drop("rank"), "positives")
    of = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("found"))        # ``positives`` of each
    asked = anchors.join(of, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    found = search(asked, find_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def contract_labels(vectors: DataFrame) -> DataFrame:
    """The given table with the label moved on by one, modulo 10, where the id is divisible by 7."""
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(contract_labels(table(spark, sf_dir, "embeddings")))


SQL = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM fine AS a, fine AS b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT * FROM ranked WHERE rank <= 10
"""
