"""A corpus pipeline over ``documents``, built from the operators of ``loglens.llm``.

Toxic documents go, then those that the quality rules reject; one document of each group of near
copies stays; sources are mixed to their target weights; what is left is encoded. Labels are read
from the tables beside the documents and used for the rows that are still there. Each stage takes
the table that the one before it wrote and works on all its rows.

Defined results: a null ``doc_id`` cannot be matched to a label and is judged like any other row;
of a group of near copies the row with the smallest id stays (one row, if the id is repeated; of a
group without ids one row); a document that the mix takes k times, rounded to whole documents, is
there k times. Extra columns go through all stages but the last. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import bpe, mixing, quality, simhash, toxicity
from loglens.llm.common import fresh, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents whose toxicity score is 0.5 or more go."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    found = fresh(docs, "toxicity")
    scored = toxicity.score(docs, model, out_col=found)
    return scored.where(F.col(f"{found}.score") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that fail the base or that the decision list rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4, with 3-word shingles and 2 bits: one document of each group stays."""
    return simhash.one_of_each(docs, shingle=3, max_distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document as often as the mix takes its words, rounded to whole documents."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: ids of each document, and the digest of what they decode to. The stages share their workers, so
    the encoder remembers less than it does on its own."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, remembered=1 << 18)


STAGES = [("toxicity", drop_toxic), ("quality rules", drop_poor), ("near copies", drop_near_copies), ("mix", mix_sources), ("byte bpe", encode)]

#: Learned rules, XXH64 fingerprints and tokens are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
