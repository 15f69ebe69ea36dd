"""Mixing sources to target weights by a low-discrepancy schedule (operator 3).

The mix is a row of slots of equally many words. Slot i gets the point frac((i + 1/2) / golden
ratio); the source whose span of the cumulative target shares holds the point owns the slot, so
every stretch of the mix is close to the target shares. Slots are ranked within their source, and
rank k takes the k-th block of words of the source's shuffled documents, which are gone through
again when they end. The points' counts differ from the targets by a few slots; slots at the end
bring each source to its target to the word, and points beyond it take nothing.

Points come from exact integer arithmetic modulo 2^31, so the schedule is the same everywhere. A
point finds its source through a grid over [0, 1) and an equality join, block words through
(source, rank), and running sums through buckets, so a source may hold any share of the rows.

Defined results: a null source is a source of its own, last in order; a null text has size 0 and
takes nothing; rows of one id and size are told apart by no rule, and need none; without words all
targets are 0. Extra columns stay out of the way: only doc_id, source and the size are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, fresh, keyed, numbered, prefix_sums, staged, table, whole_text

REPEATS = 3                 # a source's words are used so often at most
SLOTS, BLOCK = 1 << 16, 1024            # slots wanted for small inputs, and words of a slot at most
CELLS = 4096                # of the grid
ROWS = 1024                 # of a bucket of documents or slots, on average
_GOLDEN = 1327217885        # 2^31 / golden ratio, rounded to an odd number
_UNIT = 1 << 31


def sources(docs: DataFrame) -> DataFrame:
    """key, source_size, target, words (the whole words of the target) of each source; a row each.

    ``docs``: key, size. Weights 1, 2, 3 by code point order; no target is above REPEATS times its
    source, and what is cut is shared again by weight. Sorted by cap over weight, the sources that
    reach their cap come first; the rest share what is left."""
    one = docs.groupBy("key").agg(F.sum("size").alias("source_size"))
    one = one.withColumn("weight", (F.row_number().over(W.orderBy("key")) - 1) % 3 + 1).withColumn("cap", REPEATS * F.col("source_size"))
    by, every = W.orderBy(F.col("cap") / F.col("weight"), "key"), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    capped = F.coalesce(F.sum("cap").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by.rowsBetween(0, W.unboundedFollowing))
    one = one.withColumn("level", (F.sum("source_size").over(every) - capped) / left)
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "key", "level"))).over(every)["level"]
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return one.withColumn("target", target).select("key", "source_size", "target", F.floor(F.col("target") + 1e-6).cast("long").alias("words"))


def slots(shares: DataFrame, block: int, n_slots: int) -> DataFrame:
    """slot, key, rank: the schedule. ``shares``: key, target, words."""
    total = F.sum("target").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    upper = F.sum("target").over(W.orderBy("key").rowsBetween(W.unboundedPreceding, 0)) / total
    spans = shares.where("words > 0").withColumn("upper", F.round(upper * _UNIT).cast("long"))
    spans = spans.withColumn("lower", F.coalesce(F.lag("upper").over(W.orderBy("key")), F.lit(0)))
    width = _UNIT // CELLS
    spans = spans.where("lower < upper").select("key", "lower", "upper", F.explode(F.expr(f"sequence(lower div {width}, (upper - 1) div {width})")).alias("cell"))
    spark = shares.sparkSession
    # ((2 i + 1) * golden / 2) mod 2^31; i is cut to 31 bits first, so that the product fits a long
    point = F.expr(f"(((id % {_UNIT}) * {_GOLDEN}) + {_GOLDEN // 2}) % {_UNIT}")
    points = spark.range(n_slots).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.expr(f"point div {width}"))
    owned = points.join(spans, "cell").where("point >= lower and point < upper").select("slot", "key")
    ranked = prefix_sums(owned.withColumn("part", F.expr(f"slot div {ROWS}")), ["key"], "part", ["slot"], F.lit(1), "rank").select("slot", "key", "rank")
    ranked = staged(ranked, "slots")
    have = ranked.groupBy("key").agg(F.count("*").alias("have"))
    need = shares.where("words > 0").join(have, "key", "left").select("key", F.coalesce("have", F.lit(0)).alias("have"), F.expr(f"(words - 1) div {block} + 1").alias("need"))
    tail = need.where("have < need").select("key", F.explode(F.expr("sequence(have, need - 1)")).alias("rank"))
    return ranked.unionByName(tail.select((F.lit(n_slots) + F.col("rank")).alias("slot"), "key", "rank"))


def mix(docs: DataFrame, also: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id, key, size, source_size, target) and the mix (slot, key, row, from_word, n_words).

    ``docs``: doc_id, source, size, and columns ``also`` that the rows keep. ``from_word`` counts from the start of the row's document."""
    key = F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1"))        # sorts like the source, null last
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = staged(docs.select(*also, "doc_id", key.alias("key"), F.col("size").cast("long").alias("size"), order.alias("order"), F.monotonically_increasing_id().alias("row")), "sized")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(1, min(BLOCK, total // SLOTS))
    shares = staged(sources(rows), "sources")
    digits = 0
    while ROWS * 16 ** digits < n:
        digits += 1
    placed = prefix_sums(rows.withColumn("bucket", F.expr(f"left(order, {digits})")), ["key"], "bucket", ["order", "size", "row"], "size", "at").drop("bucket", "order")
    placed = staged(placed.join(shares, "key"), "placed")
    rounds = placed.where("size > 0").withColumn("round", F.explode(F.array(*[F.lit(i) for i in range(REPEATS)])))
    rounds = rounds.withColumn("start", F.expr("round * source_size + at")).where("start < words").withColumn("end", F.expr("least(start + size, words)"))
    pieces = rounds.withColumn("rank", F.explode(F.expr(f"sequence(start div {block}, (end - 1) div {block})")))
    low, high = F.greatest("start", F.col("rank") * block), F.least("end", (F.col("rank") + 1) * block)
    pieces = pieces.select("key", "rank", "row", (low - F.col("start")).alias("from_word"), (high - low).alias("n_words"))
    mixed = slots(shares, block, -(-total // block)).join(pieces, ["key", "rank"]).select("slot", "key", "row", "from_word", "n_words")
    return placed, mixed


def taken(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the columns ``also``, of every row of ``docs`` (doc_id, source, size)."""
    rows, mixed = mix(docs, also)
    per_row = mixed.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return rows.join(per_row, "row", "left").select(*also, "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def sized(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size (the words of each whole text), and the columns ``also``."""
    return docs.select(*also, "doc_id", "source", F.regexp_count(whole_text("text"), F.lit(WORD)).cast("long").alias("size"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes its words, rounded to whole documents."""
    rows, key = keyed(docs)
    narrow = rows.select("doc_id", "source", "text", F.col(key).alias("document"))
    words = taken(sized(narrow, ("document",)), ("document",))
    times = words.groupBy(F.col("document").alias(key)).agg(F.round(F.sum("taken") / F.max("size")).cast("int").alias("times")).where("times > 0")
    copies = fresh(rows, "times")
    one, number = numbered(rows.join(times.withColumnRenamed("times", copies), key), key)
    each = F.explode(F.sequence(F.lit(1), F.col(copies)))
    return one.where(F.col(number) == 1).withColumn(copies, each).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(sized(table(spark, sf_dir, "documents")))


#: The same rows in closed form: a document is gone through as often as its source's target says.
SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source),
a AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM s),
b AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM a),
c AS (SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT arg_min(level, cap::DOUBLE / weight) FROM b WHERE level * weight <= cap)) AS target FROM b),
e AS (SELECT d.*, c.source_size, c.target, floor(c.target + 1e-6)::BIGINT AS words,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
      FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size + greatest(0, least(size, words % source_size - begins)) END)::BIGINT AS taken FROM e
"""
