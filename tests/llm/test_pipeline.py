import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from loglens.llm import bpe, mixing, quality, simhash, toxicity


def test_stages_against_their_operators(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality rules", "near copies", "mix", "byte bpe"]
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    clean = quality.staged(stages["toxicity"](spark, docs, folder), "t")
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).where("toxicity.score < 0.5")
    assert clean.columns == docs.columns and ids(clean) == ids(scored) and clean.count() < docs.count()

    good = quality.staged(stages["quality rules"](spark, clean, folder), "q")
    assert good.columns == docs.columns and ids(good) == ids(quality.judge(clean, labels).where("kept"))

    unique = quality.staged(stages["near copies"](spark, good, folder), "n")
    found = simhash.near_duplicates(good).where("doc_id = component_id")
    assert unique.columns == docs.columns and ids(unique) == ids(found)

    mixed = quality.staged(stages["mix"](spark, unique, folder), "m")
    want = [r["doc_id"] for r in mixing.taken(mixing.sized(unique)).collect() if r["size"] for _ in range(round(r["taken"] / r["size"]))]
    assert mixed.columns == docs.columns and ids(mixed) == sorted(want)

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    last = stages["byte bpe"](spark, mixed, folder).collect()
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(last) == mixed.count()
    assert all(r["n_tokens"] == len(own.encode_ordinary(text[r["doc_id"]])) and r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in last)


def test_run_and_odd_rows(spark, sf_dir, odd_docs):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    for start in (odd_docs, odd_docs.limit(0)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = quality.staged(stage(spark, docs, sf_dir), "odd")
            if name != "byte bpe":
                assert docs.columns == start.columns
