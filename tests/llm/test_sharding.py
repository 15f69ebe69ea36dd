import math
import zlib
from collections import Counter

import numpy as np

from loglens.llm import sharding


def gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    return {s: len(v) for s, v in by.items()}


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = sharding.query(spark, sf_dir).collect()
    sizes = gapless(rows)
    assert len(rows) == len(docs) and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.query(spark, sf_dir).collect()))


def test_matrix_margins():
    counts = [5, 0, 17, 1, 1000, 3]
    m = sharding.matrix(counts, 7, 1)
    assert [sum(r) for r in m] == counts
    columns = [sum(r[s] for r in m) for s in range(7)]
    assert sum(columns) == sum(counts) and max(columns) - min(columns) <= 1


def test_large_populations_have_the_law():
    rng = np.random.default_rng(3)
    good, bad, n = 3 * 10 ** 9, 7 * 10 ** 9, 10_000
    draws = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(400)])
    sd = math.sqrt(n * 0.3 * 0.7)
    assert abs(draws.mean() - 3000) < 5 * sd / 20 and 0.85 * sd < draws.std() < 1.15 * sd
    assert sharding.hypergeometric(rng, 5 * 10 ** 9, 0, 7) == 7 and sharding.hypergeometric(rng, 0, 5, 3) == 0


def test_uniform_over_shards_and_slots(spark):
    """Where one row goes, over many seeds: shards and ends of a shard equally often."""
    df = spark.range(64, numPartitions=3)
    seen, first = Counter(), Counter()
    for seed in range(40):
        rows = sharding.shuffle(df, 4, seed).collect()
        gapless(rows)
        seen.update((r["id"] // 16, r["shard"]) for r in rows)
        first.update(r["id"] // 16 for r in rows if r["slot"] == 0)
    assert all(100 <= seen[g, s] <= 220 for g in range(4) for s in range(4))      # 160 expected
    assert all(20 <= first[g] <= 62 for g in range(4))                              # 40 expected


def test_odd_rows(spark, odd_docs, tmp_path):
    out = sharding.shuffle(odd_docs, 4)
    assert sorted(out.columns) == sorted(odd_docs.columns)
    sizes = gapless(out.collect())
    assert sum(sizes.values()) == odd_docs.count() and max(sizes.values()) - min(sizes.values()) <= 1
    assert sharding.shuffle(odd_docs.limit(0), 4).count() == 0
    path = sharding.write(out, str(tmp_path / "shards"))
    assert spark.read.parquet(path).count() == odd_docs.count()
