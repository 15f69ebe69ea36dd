"""Chat formatting by multi-party perspective rotation (operator 7); DataFrame functions only.

Every participant of a conversation gets the whole dialogue rendered with that speaker as the
assistant and all others as named users; system messages stay system messages. The rendering of a
conversation for one speaker is the concatenation of its segments by ``position``; each segment
carries its place in it (``start`` to ``end``, in characters) and the span to learn from
(``loss_start`` to ``loss_end``: the speaker's own words and the end mark; null elsewhere).

Rows stay one a message and speaker. Messages are sorted once by range, equal ones spread too, and
cut into buckets of ``ROWS``; places come from running sums of buckets. So no task gathers a
conversation, whatever its share of all messages and however its turns repeat.

Defined results: a null role speaks as ``unknown``; null text is empty; rows with null ``conv_id``
form one conversation; messages are ordered by turn (null last), then role, then text, and equal
rows in either order, which render alike; a conversation without a participant has no rows.
Extra columns are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prefix_sums, staged, table, whole_text

SYSTEM = "system"
ROWS = 4096                 # messages of a bucket


def rotate(messages: DataFrame) -> DataFrame:
    """conv_id, speaker, position, turn, role, segment, start, end, loss_start, loss_end."""
    own = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), whole_text("text").alias("text"))
    own = own.withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")))
    order = [F.col("conv"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), F.col("tie")]
    n = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # `at` is partition << 33 | row within it: the order of all messages
    own = staged(own.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("at", F.monotonically_increasing_id()).drop("tie"), "messages")
    speakers = own.where(F.col("role") != SYSTEM).groupBy(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).agg(F.lit(1).alias("one")).drop("one")
    speaks = F.col("role") == F.col("speaker")
    head = F.when(speaks, "<|im_start|>assistant\n").when(F.col("role") == SYSTEM, f"<|im_start|>{SYSTEM}\n").otherwise(F.concat(F.lit("<|im_start|>user name="), "role", F.lit("\n")))
    both = own.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    both = both.withColumn("head", F.length(head)).withColumn("segment", F.concat(head, "text", F.lit("<|im_end|>\n")))
    both = both.withColumn("bucket", F.expr(f"at div {ROWS}"))
    placed = prefix_sums(both, ["conv", "speaker"], "bucket", ["at"], [F.lit(1).cast("long"), F.length("segment").cast("long")], ["position", "start"])
    placed = placed.withColumn("end", F.col("start") + F.length("segment"))
    return placed.select("conv_id", "speaker", "position", "turn", "role", "segment", "start", "end",
                         F.when(speaks, F.col("start") + F.col("head")).alias("loss_start"), F.when(speaks, F.col("end") - 1).alias("loss_end"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> 'system'),
r AS (SELECT m.*, p.speaker, CASE WHEN role = speaker THEN E'<|im_start|>assistant\n' WHEN role = 'system' THEN E'<|im_start|>system\n'
             ELSE '<|im_start|>user name=' || role || E'\n' END AS head FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (SELECT *, head || text || E'<|im_end|>\n' AS segment FROM r),
t AS (SELECT *, row_number() OVER w - 1 AS position, sum(length(segment)) OVER w AS "end" FROM s
      WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS LAST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, speaker, position, turn, role, segment, ("end" - length(segment))::BIGINT AS start, "end"::BIGINT AS "end",
       (CASE WHEN role = speaker THEN "end" - length(segment) + length(head) END)::BIGINT AS loss_start, (CASE WHEN role = speaker THEN "end" - 1 END)::BIGINT AS loss_end FROM t
"""
