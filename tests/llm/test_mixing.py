import duckdb

from loglens.llm import mixing


def rounds(sizes, total):
    """Share by weight, cap, share the excess again until none is above."""
    keys = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(keys)}
    target, open_ = {}, set(keys)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in above}
        open_ -= above
    return target


def check(df):
    rows = [r.asDict() for r in mixing.taken(df).collect()]
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    sizes = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
    for r in df.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = rounds(sizes, sum(sizes.values()))
    for s in sizes:
        own = [r for r in rows if source[r["doc_id"]] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * (1 + want[s]) for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 1
    return rows


def test_targets_against_rounds(spark):
    schema = "doc_id long, source string, size long"
    df = spark.createDataFrame([(i, "abcdefg"[i * i % 7], i * 37 % 211) for i in range(900)] + [(1000, None, 5), (1001, "é", 3), (1002, "Z", 0)], schema)
    check(df)
    check(spark.createDataFrame([(1, "a", 100_000), (2, "b", 7), (3, "c", 1)], schema))


def test_reruns_agree_and_pieces_tile(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], i % 50) for i in range(400)], "doc_id long, source string, size long")
    rows, mixed = mixing.mix(df)
    first = sorted(map(tuple, mixed.collect()))
    assert first == sorted(map(tuple, mixing.mix(df)[1].collect()))
    size = {r["row"]: r["size"] for r in rows.collect()}
    for _, _, row, start, n in first:
        assert 0 <= start and n > 0 and start + n <= size[row]


def test_schedule_is_even(spark):
    """Any prefix of the mix holds each source near its share."""
    shares = spark.createDataFrame([("a", 1000.0, 1000), ("b", 3000.0, 3000), ("c", 6000.0, 6000)], "key string, target double, words long")
    order = [r["key"] for r in mixing.slots(shares, 1, 10_000).orderBy("slot").collect()]
    for n in (100, 1000, 5000, 10_000):
        for key, share in (("a", 0.1), ("b", 0.3), ("c", 0.6)):
            assert abs(order[:n].count(key) - share * n) <= 6


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    key = lambda r: (r[0], *(round(x, 6) for x in r[1:]))
    assert sorted(map(key, mixing.query(spark, sf_dir).select("doc_id", "size", "source_size", "target", "taken").collect())) == sorted(map(key, con.execute(mixing.SQL).fetchall()))


def test_odd_rows(spark, odd_docs):
    got = mixing.taken(mixing.sized(odd_docs)).collect()
    assert len(got) == odd_docs.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    assert mixing.taken(mixing.sized(odd_docs.limit(0))).count() == 0
    assert mixing.mixed_documents(odd_docs.limit(0)).count() == 0
    assert all(r["taken"] == 0 and r["target"] == 0 for r in mixing.taken(mixing.sized(odd_docs.where("text is null"))).collect())
