import math

import duckdb
import numpy as np
import pytest

from loglens.llm import negatives

VEC = "vec_id long, embedding array<float>, label int"


def brute(rows, mod=100, n_pos=5, n_neg=10, least=30, most=90):
    """Rows of (vec_id, vector, label), already fit to take part."""
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows]
    out = []
    for a, q, y in rows:
        if a % mod:
            continue
        scored = sorted((-sum(s * t for s, t in zip(q, v)), i, l) for i, v, l in rows if i != a)
        for p, pid, _ in [s for s in scored if s[2] == y][:n_pos]:
            inside = [(i, -n) for n, i, l in scored if l != y and least * -p <= 100 * -n <= most * -p][:n_neg]
            out += [(a, pid, r, i, -p, n) for r, (i, n) in enumerate(inside, 1)]
    return sorted(out)


def clusters(n, d, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(7, d))
    x = centre[rng.integers(0, 7, n)] + spread * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32), rng.integers(0, 4, n)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = sorted(con.execute(negatives.SQL).fetchall())
    assert sorted(map(tuple, negatives.query(spark, folder).collect())) == want and len(want) > 100


@pytest.mark.parametrize("d,spread,block,asked", [(6, 0.4, 8192, 2048), (6, 0.05, 150, 3), (1, 0.3, 100, 2), (9, 1.5, 200, 4)])
def test_against_brute_force(spark, d, spread, block, asked):
    x, y = clusters(700, d, d, spread)
    rows = [(i, [float(v) for v in x[i]], int(y[i])) for i in range(700)]
    rows += [(1000 + i, rows[i % 3][1], int(i % 4)) for i in range(150)]        # copies: ties by id
    got = negatives.mine(spark.createDataFrame(rows, VEC), block=block, anchor_block=asked)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_index_visits_by_bound_and_stops_early():
    x, y = clusters(4000, 8, 3, 0.03)
    x = np.floor(256.0 * x)
    index = negatives.MultiIndex(np.arange(4000), y, x, (negatives.codebook(x[:, :4]), negatives.codebook(x[:, 4:])))
    scored = 0
    for a in range(0, 4000, 100):
        q, left = x[a], np.ones(4000, bool)
        last = np.inf
        for bound, first, end in index.cells(q, np.inf):
            assert bound <= last and (index.x[first:end] @ q <= bound).all()
            left[first:end], last = False, bound
        assert not left.any()
        for _, first, end in index.cells(q, 30_000):
            left[first:end] = True
        assert (index.x[~left] @ q > 30_000).all()
        rows_seen = []
        take = lambda rows, scores, bound: rows_seen.append(len(rows)) or scores.max() > bound
        index.search(q, take)
        scored += sum(rows_seen)
    assert scored < 0.6 * 40 * 4000


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(0, [1.0, 0.5], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.0], 2), (4, [0.25, 0.25], 3), (5, [-1.0, 0.0], 2), (100, [0.0, 0.0], 2), (200, [-1.0, -1.0], 9)]
    bad = [(6, None, 1), (7, [1.0, None], 1), (8, [inf, 0.0], 1), (9, [nan, 1.0], 2), (10, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (11, [1.0, 2.0, 3.0], 2), (12, [], 1), (13, [3e37, 0.0], 2)]
    df = spark.createDataFrame(good + bad + good[:4], VEC).selectExpr("*", "1 as block", "2 as asked", "3 as v")
    want = brute(good)
    assert sorted(map(tuple, negatives.mine(df).collect())) == want and want
    assert negatives.mine(df.limit(0)).count() == 0 and negatives.mine(df.where("vec_id = 1")).count() == 0
    assert negatives.mine(df.where("vec_id = 0")).count() == 0 and negatives.mine(df.where("size(embedding) = 0 or vec_id is null")).count() == 0
    repeated = spark.createDataFrame([(0, [1.0], 2), (0, [2.0], 1), (0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 3), (2, [0.75], 2)], VEC)
    assert sorted(map(tuple, negatives.mine(repeated).collect())) == [(0, 1, 1, 2, 65536, 49152)]


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(v)) for v in rng.uniform(-3e6, 3e6, 5)], i % 3) for i in range(0, 300, 4)]
    got = negatives.mine(spark.createDataFrame(rows, VEC), least=1, most=100)
    assert sorted(map(tuple, got.collect())) == brute(rows, least=1, most=100)
    labels = [(r["vec_id"], r["label"]) for r in negatives.contract_labels(spark.createDataFrame([(7, [1.0], 9), (8, [1.0], 9), (14, None, None)], VEC)).collect()]
    assert labels == [(7, 0), (8, 9), (14, None)]
