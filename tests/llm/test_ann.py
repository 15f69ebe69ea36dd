import numpy as np

from loglens.llm import ann

VEC = "vec_id long, embedding array<float>, label int"


def brute(rows, mod, top):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q % mod == 0:
            best = sorted((-(v @ x) / (np.sqrt(v @ v) * np.sqrt(x @ x)), i) for i, v in rows if i != q)
            out[q] = [(i, -s) for s, i in best[:top]]
    return out


def test_query_small_table_is_exact(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {}
    for r in ann.query(spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute(rows, 50, 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_recall_on_a_larger_table(spark):
    """Vectors of the given table, and as many again between pairs of them: more than one block."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    other = given.selectExpr("(vec_id * 7919 + 13) % 2000 as vec_id", "embedding as far")
    between = [given.join(other, "vec_id").selectExpr(f"vec_id + {2000 * i} as vec_id", f"transform(embedding, (x, i) -> cast({1 - 0.1 * i}D * x + {0.1 * i}D * far[i] as float)) as embedding") for i in range(1, 6)]
    df = given
    for rows in between:
        df = df.unionByName(rows)
    df = df.cache()
    assert df.count() > ann.VECTORS
    rows = df.select("vec_id", "embedding").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in ann.search(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        s = x @ x[at]
        s[at] = -9
        best = set(ids[np.argsort(-s)[:5]])
        hits += len(best & got[ids[at]])
        total += 5
    assert hits >= 0.9 * total


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], 1), (50, [0.0, 2.0], 1), (1, [3.0, 0.0], 1), (2, [1.0, 1.0], 1), (3, [1.0, 1.0], 1), (3, [1.0, 1.0], 1), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [1.0, None], 1), (8, [inf, 1.0], 1), (9, [nan, 1.0], 1), (None, [1.0, 0.0], 1), (10, [1.0, 2.0, 3.0], 1), (100, [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, VEC)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 9)) for r in ann.search(df).collect()}
    half = round(0.5 ** 0.5, 9)
    assert got == {(0, 1): (1, 1.0), (0, 2): (2, half), (0, 3): (3, half), (0, 4): (50, 0.0),
                   (50, 1): (2, half), (50, 2): (3, half), (50, 3): (0, 0.0), (50, 4): (1, 0.0)}
    assert ann.search(df.limit(0)).count() == 0 and ann.search(df.where("vec_id = 1")).count() == 0
    assert ann.search(df.where("vec_id = 0")).count() == 0


def test_blocks_agree_with_one_block(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(600)], VEC)
    one = sorted(map(tuple, ann.search(df).collect()))
    monkeypatch.setattr(ann, "VECTORS", 100)
    monkeypatch.setattr(ann, "QUERIES", 5)
    assert [r[:3] for r in sorted(map(tuple, ann.search(df).collect()))] == [r[:3] for r in one]
