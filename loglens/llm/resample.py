"""Target-distribution importance resampling (operator 11).

A document's weight is the sum, over its features, of the gain of the feature's hash bucket: the
log ratio of the bucket's share in the target texts to its share in all documents, out of an array
with a place for each bucket. Gumbel noise by a hash of the id makes the highest scores a draw
without replacement in proportion to exp(weight).

Ranks come from parallel sorting by regular sampling. Each task sorts its rows and writes them as
a run; regular samples of the runs (their gap doubles as a run goes on, so a task holds few) give
the driver the splitters; these cut every run into segments; the segments of a part are exchanged
and merged in one task; the counts of the parts before it make a row's place in its part its exact
rank. Parts beyond the draw are not exchanged. The row's number is the last key, so that any
number of equal rows is cut into parts as well.

Only bounded things reach the driver: a count for each bucket, samples (``SAMPLES``, or two a run
if there are more runs), a count for each part.

Defined results: null and wordless texts have no features and weight 0; a null id is hashed as the
empty string and comes last among equal scores, equal ids by features; repeated rows are drawn
each for itself; without benchmark texts T and t are 0; an empty table has no rows. A column named
like an output is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, fresh, letter_words, staged, table, whole_text

BUCKETS, LONGEST = 10_000, 1            # of hashed features; words of a feature at most
SEED, LEAST_WORDS, PERCENT = 2024, 20, 10
SAMPLES, PARTS, PART_ROWS = 1 << 16, 1 << 13, 1 << 13       # in all; of the sorted rows at most; rows of one wanted
WORDS, LONG_WORD = 1 << 18, 64          # of a worker's memory of words
_KEYS = ["score", "id_key", "n_features", "row"]


class _Buckets(dict):
    """Feature -> its bucket."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        bucket = crc32(feature) % self.n
        if len(feature) <= LONG_WORD:
            if len(self) >= WORDS:
                self.clear()
            self[feature] = bucket
        return bucket


def feature_buckets(words: list[bytes], known: _Buckets, longest: int = LONGEST) -> np.ndarray:
    """The bucket of every run of 1 to ``longest`` words, repeats included."""
    found = [list(map(known.__getitem__, words))]
    for k in range(2, longest + 1):
        found.append(list(map(known.__getitem__, map(b" ".join, zip(*(words[i:] for i in range(k)))))))
    return np.array(sum(found[1:], found[0]), np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text_col: str = "text") -> np.ndarray:
    """How many features of all texts each bucket holds."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                total += np.bincount(feature_buckets(letter_words(text), known, longest), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select(whole_text(text_col).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / raw share)) of each bucket, one added to every count."""
    s_all, t_all, n = int(raw.sum()), int(target.sum()), len(raw)
    ratio = (target + 1.0) * float(s_all + n) / ((raw + 1.0) * float(t_all + n))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def noise(doc_id: str | Column, seed: int = SEED) -> Column:
    """The Gumbel noise of an id, times 1000 and floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score(docs: DataFrame, gain: np.ndarray, seed: int = SEED, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text", out_col: str = "importance") -> DataFrame:
    """Add ``out_col``: struct of n_words, n_features, weight and score (longs)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)     # a number for each bucket
    kept: dict[int, _Buckets] = {}

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def weigh(texts: pa.Array) -> pa.Array:
        known, gain = kept.setdefault(0, _Buckets(len(shared.value))), shared.value
        out = []
        for text in as_bytes(texts):
            words = letter_words(text)
            ids = feature_buckets(words, known, longest)
            out.append((len(words), len(ids), int(gain[ids].sum())))
        columns = zip(*out) if out else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n_words", "n_features", "weight"])

    found = fresh(docs, "weighed")
    scored = docs.withColumn(found, weigh(whole_text(text_col)))
    own = [F.col(f"{found}.{c}").alias(c) for c in ("n_words", "n_features", "weight")]
    return scored.withColumn(out_col, F.struct(*own, (F.col(f"{found}.weight") + noise(id_col, seed)).alias("score"))).drop(*({found} - {out_col}))


def _order(score: np.ndarray, id_key: np.ndarray, n_features: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Highest score first, then id, features, row. The stable sort by score merges runs that are sorted
    already; rows of one score are put in order after it."""
    order = np.argsort(-score, kind="stable")
    s = score[order]
    tied = np.zeros(len(s), bool)
    same = s[1:] == s[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    if tied.any():
        at = np.flatnonzero(tied)
        own = order[at]
        order[at] = own[np.lexsort((row[own], n_features[own], id_key[own], -score[own]))]
    return order


def _keys(batch: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
    return [batch.column(k).to_numpy() if isinstance(batch, pa.Table) else batch.column(k).to_numpy(zero_copy_only=False) for k in _KEYS]


def _sampler(wanted: int):
    """Regular samples of sorted runs, with the number of rows that each stands for."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, at, gap, taken = None, 0, 1, []

        def made() -> pa.RecordBatch:
            columns = [np.concatenate([t[i] for t in taken]) for i in range(len(_KEYS))]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.full(len(columns[0]), gap))], names=[*_KEYS, "stands_for"])

        for batch in batches:
            runs, keys = batch.column("run").to_numpy(zero_copy_only=False), _keys(batch)
            edges = [0, *(np.flatnonzero(runs[1:] != runs[:-1]) + 1).tolist(), len(runs)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if runs[start] != run:
                    if taken:
                        yield made()
                    run, at, gap, taken = runs[start], 0, 1, []
                taken.append([k[start:end][-at % gap::gap] for k in keys])
                at += end - start
                while sum(len(t[0]) for t in taken) > 2 * wanted:
                    taken = [[np.concatenate([t[i] for t in taken])[::2] for i in range(len(_KEYS))]]
                    gap *= 2
        if taken:
            yield made()

    return sample


def _splitters(samples: list, parts: int) -> list[np.ndarray]:
    """Keys at which the sampled rows fall into ``parts`` parts of like size."""
    columns = [np.array([r[k] for r in samples], np.int64) for k in [*_KEYS, "stands_for"]]
    order = _order(*columns[:4])
    before = np.cumsum(columns[4][order]) - columns[4][order]
    total = int(columns[4].sum())
    at = np.unique(np.searchsorted(before, [total * j // parts for j in range(1, parts)]))
    picked = order[at[(at > 0) & (at < len(order))]]
    return [c[picked] for c in columns[:4]]


def part_of(keys: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """The part of each row: how many splitters are not after it."""
    m = len(splitters[0])
    order = _order(*(np.concatenate([s, k]) for s, k in zip(splitters, keys)))       # of equal keys the splitter is first
    part = np.empty(len(order), np.int64)
    part[order] = np.cumsum(order < m)
    return part[m:]


def ranked(runs: DataFrame, n: int, n_runs: int, draw: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``runs`` with rank (long): 1 to ``draw`` in the order of the keys for the eligible rows, null for the rest.

    ``runs``: score, id_key, n_features, row, run, eligible and more; read from sorted files, of which
    ``n_runs`` are runs and ``n`` rows eligible."""
    spark = runs.sparkSession
    if draw < 1:
        return runs.withColumn("rank", F.lit(None).cast("long"))
    fields = ", ".join(f"{k} long" for k in [*_KEYS, "stands_for"])
    eligible = runs.where("eligible")
    samples = eligible.select(*_KEYS, "run").mapInArrow(_sampler(max(1, SAMPLES // max(1, n_runs))), fields).collect()
    shared = spark.sparkContext.broadcast(_splitters(samples, min(PARTS, -(-n // part_rows))))     # PARTS keys at most

    @F.arrow_udf("long")
    def part(score: pa.Array, id_key: pa.Array, n_features: pa.Array, row: pa.Array) -> pa.Array:
        return pa.array(part_of([x.to_numpy(zero_copy_only=False) for x in (score, id_key, n_features, row)], shared.value))

    counts = {r["part"]: r["count"] for r in eligible.select(part(*_KEYS).alias("part")).groupBy("part").count().collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p] = total
        total += counts[p]
    beyond = [p for p in sorted(counts) if before[p] >= draw]       # the first of these starts at splitter p - 1
    inside = F.col("eligible")
    if beyond:
        s, i, f, r = (int(x[beyond[0] - 1]) for x in shared.value)
        after = (F.col("n_features") > f) | ((F.col("n_features") == f) & (F.col("row") >= r))
        after = (F.col("id_key") > i) | ((F.col("id_key") == i) & after)
        inside = inside & ~((F.col("score") < s) | ((F.col("score") == s) & after))
    offsets = spark.sparkContext.broadcast(before)

    def merge(segments: pa.Table) -> pa.Table:
        order = _order(*_keys(segments))
        out = segments.take(pa.array(order))
        ranks = offsets.value[out.column("part")[0].as_py()] + 1 + np.arange(len(order))
        return out.drop_columns(["part"]).append_column("rank", pa.array(ranks, mask=ranks > draw))

    schema = runs.withColumn("rank", F.lit(None).cast("long")).schema
    drawn = runs.where(inside).withColumn("part", part(*_KEYS)).groupBy("part").applyInArrow(merge, schema)
    return drawn.unionByName(runs.where(~inside).withColumn("rank", F.lit(None).cast("long")))


def _sorted_runs(scored: DataFrame, found: str, id_col: str, least_words: int, name: str, keep: list[Column]) -> tuple[DataFrame, int, int]:
    """The scored rows as sorted, written runs; the eligible rows and the runs."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id_key")
    rows = scored.select(*keep, F.col(f"{found}.n_features").alias("n_features"), F.col(f"{found}.weight").alias("weight"), F.col(f"{found}.score").alias("score"), key,
                         (F.col(f"{found}.n_words") >= least_words).alias("eligible"), F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("run"))
    runs = staged(rows.sortWithinPartitions(F.desc("eligible"), F.desc("score"), "id_key", "n_features", "row"), name)
    r = runs.agg(F.count(F.when(F.col("eligible"), 1)).alias("n"), F.count_distinct("run").alias("runs")).first()
    return runs, r["n"], r["runs"]


def ranks(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text",
          part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank from 1 for the ``percent`` per cent (floor) of the
    documents with ``least_words`` words that are drawn, else null."""
    docs = docs.select(id_col, text_col)
    gain = gains(bucket_counts(docs, buckets, longest, text_col), bucket_counts(target, buckets, longest))
    found = fresh(docs, "importance")
    runs, n, n_runs = _sorted_runs(score(docs, gain, seed, longest, id_col, text_col, found), found, id_col, least_words, "runs", [F.col(id_col).cast("long").alias("doc_id")])
    return ranked(runs, n, n_runs, percent * n // 100, part_rows).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text",
             out_col: str = "rank") -> DataFrame:
    """The drawn documents with all their columns and their rank (``out_col``, a column of that name is replaced)."""
    gain = gains(bucket_counts(docs, buckets, longest, text_col), bucket_counts(target, buckets, longest))
    rest = [c for c in docs.columns if c.lower() != out_col.lower()]
    found = fresh(docs, "importance")
    whole = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("document")
    runs, n, n_runs = _sorted_runs(score(docs, gain, seed, longest, id_col, text_col, found), found, id_col, least_words, "drawn-from", [whole])
    drawn = ranked(runs, n, n_runs, percent * n // 100).where("rank is not null")
    return drawn.select(*[F.col("document").getField(c).alias(c) for c in rest], F.col("rank").alias(out_col))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 is built from its rule: DuckDB has no function for it.
SQL = r"""
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), docs AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM low
), items AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), used AS (
  SELECT n, unnest(words) AS word FROM docs
), aimed AS (
  SELECT unnest(words) AS word FROM items
), crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), vocabulary AS (
  SELECT DISTINCT word, hex(encode(word)) AS h FROM (SELECT word FROM used UNION ALL SELECT word FROM aimed)
), hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket FROM vocabulary, crc
), raw AS (
  SELECT bucket, count(*) AS s FROM used JOIN hashed USING (word) GROUP BY bucket
), wanted AS (
  SELECT bucket, count(*) AS t FROM aimed JOIN hashed USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT count(*) FROM used) AS s_all, (SELECT count(*) FROM aimed) AS t_all
), gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM raw LEFT JOIN wanted USING (bucket), totals
), weights AS (
  SELECT n, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM used JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY n
), scored AS (
  SELECT n, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (n)
), places AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, n) AS place, count(*) OVER () AS eligible FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * eligible // 100 THEN place END AS rank FROM scored LEFT JOIN places USING (n)
"""
