import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest

from loglens.llm import resample

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM = "item_id long, text string"


def brute(docs, items, percent=10, least=20, longest=1):
    """doc_id, n_features, weight, score, rank of (doc_id, text) rows."""
    def features(text):
        words = WORDS.findall((text or "").translate(LOWER))
        return [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10000 for k in range(1, longest + 1) for i in range(len(words) - k + 1)], len(words)

    s, t = [0] * 10000, [0] * 10000
    for out, rows in ((s, docs), (t, items)):
        for _, text in rows:
            for b in features(text)[0]:
                out[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + 10000.0) / ((s[b] + 1.0) * (sum(t) + 10000.0)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        f, n = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawn = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for rank, r in enumerate(drawn[:percent * len(drawn) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_sql_and_brute_force(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = sorted(con.execute(resample.SQL).fetchall(), key=str)
    assert found(resample.query(spark, sf_dir)) == want
    pairs = [con.execute(f"SELECT {c}, text FROM {t}").fetchall() for t, c in (("documents", "doc_id"), ("benchmark", "item_id"))]
    assert want == brute(*pairs) and sum(r[4] is not None for r in want) > 10


@pytest.mark.parametrize("part_rows", [1, 7, 100, 10_000])
def test_many_runs_and_parts(spark, monkeypatch, part_rows):
    """Hot ids, equal rows and equal texts are cut into parts too."""
    monkeypatch.setattr(resample, "SAMPLES", 64)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows = [(i if i % 3 else 7, " ".join(words[(i * k) % 5] for k in range(1, 4 + i % 29)) if i % 4 else "one two three " * 9) for i in range(1, 900)]
    items = [(1, "alpha beta beta"), (2, None)]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string").repartition(13), spark.createDataFrame(items, ITEM)
    assert found(resample.ranks(docs, target, percent=37, part_rows=part_rows)) == brute(rows, items, 37)


def test_longer_features(spark):
    rows, items = [(i, f"a b c d {i} " * 5) for i in range(60)], [(1, "b c d"), (2, "A B")]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEM)
    assert found(resample.ranks(docs, target, percent=50, longest=3)) == brute(rows, items, 50, longest=3)


def test_odd_rows(spark, odd_docs):
    target = spark.createDataFrame([(1, "the cat"), (None, None), (2, "")], ITEM)
    docs = odd_docs.withColumn("importance", odd_docs.t).withColumn("part", odd_docs.t).withColumn("rank", odd_docs.t)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for percent in (0, 10, 100):
        assert found(resample.ranks(docs, target, percent, least_words=1)) == brute(rows, [(1, "the cat")], percent, 1)
    assert resample.ranks(docs.limit(0), target).count() == 0
    assert found(resample.ranks(docs, target.limit(0), 100, 1)) == brute(rows, [], 100, 1)
    drawn = resample.resample(docs, target, 100, 1)
    assert sorted(drawn.columns) == sorted(docs.columns)
    assert sorted((r["rank"], r["doc_id"]) for r in drawn.collect()) == sorted((r[4], r[0]) for r in brute(rows, [(1, "the cat")], 100, 1) if r[4])


def test_gain_array_and_runs():
    raw, target = np.array([5, 0, 3]), np.array([0, 2, 1])
    assert resample.gains(raw, target).tolist() == [math.floor(1000 * math.log((t + 1.0) * 11.0 / ((s + 1.0) * 6.0))) for s, t in zip(raw, target)]
    rng = np.random.default_rng(0)
    keys = [rng.integers(0, 9, 500) for _ in range(3)] + [np.arange(500)]
    want = np.lexsort((keys[3], keys[2], keys[1], -keys[0]))
    assert (resample._order(*keys) == want).all()
    cut = [k[want[[100, 101, 400]]] for k in keys]
    part = resample.part_of(keys, cut)
    assert np.bincount(part).tolist() == [100, 1, 299, 100] and (np.diff(part[want]) >= 0).all()
