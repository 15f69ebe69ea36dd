import collections
import math
import zlib

import numpy as np
import pytest

from loglens.llm import lm


def tokens(text):
    return (text or "").encode().lower().split() + [b" end"]


def brute(rows):
    counts = collections.Counter()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, t in rows:
        if not held[i]:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(i, held[i], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows]


@pytest.mark.parametrize("heavy", [1 << 19, 8])
def test_base_against_brute_force(spark, sf_dir, monkeypatch, heavy):
    monkeypatch.setattr(lm, "HEAVY_WORDS", heavy)       # at 8 almost all words take the join
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {r[0]: r for r in brute(rows)}
    got = lm.query(spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[1:5] and math.isclose(r["base_score"], w[5], rel_tol=1e-9)
        assert r["score"] <= 0


def test_scores_beat_the_base_on_held_out_rows(spark):
    got = [r for r in lm.query(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_filter_never_loses_a_count():
    rng = np.random.default_rng(2)
    keys, counts = rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.geometric(0.2, 5000)
    keys.sort()
    import pandas as pd
    bits, least = 3, {1: 1, 2: 2}
    at = lm._bucket(keys, bits)
    merged = pd.DataFrame([(1, b, keys[at == b].tobytes(), counts[at == b].astype("<i8").tobytes()) for b in np.unique(at)], columns=["order", "bucket", "keys", "counts"])
    segments = pd.concat(lm._segment_task(least)(iter([merged])))
    filter_ = lm.Filter(bits, least, list(segments.itertuples(index=False, name=None)))
    found = filter_.counts(keys, 1)
    assert (found >= lm._VALUES[lm.level(counts)]).all() and (found == lm._VALUES[lm.level(counts)]).mean() > 0.97
    assert (filter_.counts(rng.integers(0, 1 << 63, 20_000).astype(np.uint64), 1) > 0).mean() < 0.02
    assert (filter_.counts(keys, 2) == 0).all()


def test_size_bound_raises_the_least_level():
    per_level = {1: {1: 1000, 2: 100, 5: 10}, 2: {2: 5000, 3: 500}}
    assert lm.cutoffs(per_level, 1 << 30) == {1: 1, 2: 2}
    tight = lm.cutoffs(per_level, 400)
    size = sum(n * (lv - tight[o] + 1) for o, d in per_level.items() for lv, n in d.items() if lv >= tight[o])
    assert size * lm.BITS_PER_ENTRY <= 3200 and tight[2] > 2


def test_small_filter_still_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = lm.score(docs, max_filter_bytes=1000).collect()
    assert len(got) == docs.count() and all(r["score"] < 0 for r in got)


def exact_scores(rows):
    """Total score of held-out rows by all counts, quantised, and by the grid's best cell over all training rows."""
    one, two, held = collections.Counter(), collections.Counter(), {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    grams = [(i, [(v, w) for v, w in zip([b" begin"] + tokens(t), tokens(t))]) for i, t in rows]
    for i, pairs in grams:
        if not held[i]:
            one.update(w for _, w in pairs)
            two.update(pairs)
    n, v, begin = sum(one.values()), len(one), one[b" end"]

    def value(c):
        return lm._VALUES[lm.level(np.array([c]))[0]] if c else 0.0

    found = {h: np.array([(value(one[w]), value(begin if b == b" begin" else one[b]), value(two[b, w])) for i, pairs in grams if held[i] == h for b, w in pairs]).T for h in (False, True)}

    def total(x, a, m):
        return np.log10((x[2] + m * ((x[0] + a) / (n + a * (v + 1)))) / (np.maximum(x[1], x[2]) + m)).sum()

    best = max(lm.GRID, key=lambda g: total(np.maximum(found[False] - 1, 0), *g))
    return total(found[True], *best)


@pytest.mark.parametrize("bound", [1 << 27, 1000])
def test_all_ngrams_count_whatever_the_bound(spark, sf_dir, bound):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = exact_scores([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = sum(r["score"] for r in lm.score(docs, max_filter_bytes=bound).collect() if r["held_out"])
    assert math.isclose(got, want, rel_tol=0.01)


def test_smoothing_weights_come_from_all_training_documents(spark, monkeypatch):
    rng = np.random.default_rng(3)      # words in any order: pairs say nothing, so m must be large
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 200, 100))) for i in range(200)]
    monkeypatch.setattr(lm, "TUNE_DOCS", 0, raising=False)      # once the size of a sample
    got = sum(r["score"] for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["held_out"])
    assert math.isclose(got, exact_scores(rows), rel_tol=0.01)


def test_chunks_and_buckets_do_not_change_results(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = {r["doc_id"]: r for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "TOGETHER", 1000)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 3000)
    for r in lm.score(docs.repartition(5)).collect():
        w = whole[r["doc_id"]]
        assert r[1:5] == w[1:5] and math.isclose(r["base_score"], w["base_score"], rel_tol=1e-9) and math.isclose(r["score"], w["score"], rel_tol=0.1)


def test_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in lm.score(odd_docs).collect())
    assert got == sorted((str(r[0]), r[2], r[3], round(r[5], 6)) for r in brute(rows))
    assert lm.score(odd_docs.limit(0)).count() == 0
    only_held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    none = lm.score(odd_docs.where("doc_id = 1").selectExpr(f"{only_held}L doc_id", "text")).collect()
    assert all(r["held_out"] and r["train_tokens"] == 0 and abs(r["score"]) < 1e-9 and r["base_score"] == 0 for r in none)
