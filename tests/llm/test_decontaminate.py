import hashlib
import random
import re

import duckdb
import pytest

from loglens.llm import decontaminate

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM, DOC = "item_id long, text string", "doc_id long, text string"


def words_of(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    """(doc_id, n_words, hit word positions, item ids)."""
    cut = []
    for i, text in items:
        w = words_of(text)
        k = min(window, len(w))
        cut += [(i, tuple(w[j:j + k])) for j in range(len(w) - k + 1) if k]
    out = []
    for i, text in docs:
        w, hit, ids = words_of(text), set(), set()
        for item, x in cut:
            for j in range(len(w) - len(x) + 1):
                if tuple(w[j:j + len(x)]) == x:
                    hit |= set(range(j, j + len(x)))
                    ids |= {str(item)} - {"None"}
        out.append((i, len(w), sorted(hit), sorted(ids)))
    return sorted(out, key=str)


def found(df):
    rows = []
    for r in df.collect():
        spans = [(s["start"], s["end"]) for s in r["contamination"]["spans"]]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        rows.append((r["doc_id"], r["contamination"]["n_words"], [x for a, b in spans for x in range(a, b)], r["contamination"]["items"]))
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def generated():
    """Few words, so windows repeat, overlap and nearly match; short items; shared and hot passages."""
    rng = random.Random(4)
    vocabulary = ["a", "b", "ab", "ba", "aab", "é", "日本", "x1", "long" * 9]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(60)] + [(7, "a b, A"), (None, "x1 x1 x1 x1"), (99, None)]
    docs = []
    for i in range(150):
        text = rng.choices(vocabulary, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = (rng.choice(items)[1] or "").split()[:rng.choice([9, 10, 30])]
        docs.append((i, rng.choice([" ", " - ", "\n"]).join(text)))
    return docs, [i for i in items if i[1] is None or len(i[1].split()) != 1]


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = sorted(map(tuple, decontaminate.query(spark, sf_dir).collect()))
    assert got == sorted(con.execute(decontaminate.SQL).fetchall()) and 0 < sum(r[5] for r in got) < len(got)


@pytest.mark.parametrize("block_bytes", [1 << 23, 4000])
def test_against_brute_force(spark, generated, block_bytes):
    docs, items = generated
    want = brute(docs, items)
    got = decontaminate.contamination(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), block_bytes=block_bytes)
    assert found(got) == want and sum(bool(h) for _, _, h, _ in want) > 50


def test_other_windows_and_clean_rest(spark, generated):
    docs, items = generated
    docs_df, items_df = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)
    for window in (1, 3, 20):
        want = brute(docs, items, window)
        assert found(decontaminate.contamination(docs_df, items_df, window)) == want
        clean = decontaminate.uncontaminated(docs_df, items_df, window)
        assert clean.columns == docs_df.columns and sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _, h, _ in want if not h)


def test_tables_find_every_occurrence():
    rng = random.Random(1)
    for _ in range(300):
        strings = {bytes(rng.choices(b"ab ", k=rng.randrange(1, 12))) for _ in range(rng.randrange(1, 6))}
        text = bytes(rng.choices(b"ab ", k=80))
        want = sorted((i, s) for s in strings for i in range(len(text)) if text.startswith(s, i))
        assert sorted(decontaminate.Tables(list(strings)).search(text)) == want
    long = [b"q" * 500 + b"x", b"q" * 500 + b"y"]
    assert [s for _, s in decontaminate.Tables(long).search(b"z" + b"q" * 600 + b"y")] == [long[1]]


@pytest.mark.parametrize("block_bytes", [1 << 23, 1 << 17])
def test_odd_rows(spark, odd_docs, block_bytes):
    docs = odd_docs.withColumn("contamination", odd_docs.t).withColumn("found", odd_docs.t).withColumn("found_in", odd_docs.t)
    items = [(1, "The cat sat on the mat the cat sat on the"), (1, "one"), (2, ""), (3, None), (None, "a b c d"), (4, "w" * 200_000), (5, "日本")]
    target = spark.createDataFrame(items, ITEM)
    got = decontaminate.contamination(docs, target, block_bytes=block_bytes)
    assert sorted(got.columns) == sorted(docs.columns)
    short = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 100_000 or "w" in r["text"]]
    assert found(got.where("doc_id is null or doc_id <> 6")) == brute(short, items)
    cat = got.where("doc_id = 6").first()["contamination"]
    assert cat["n_words"] == 120_000 and [(s["start"], s["end"]) for s in cat["spans"]] == [(0, 119_999)] and cat["items"] == ["1"]
    assert decontaminate.contamination(docs.limit(0), target, block_bytes=block_bytes).count() == 0
    clean = decontaminate.contamination(docs, target.limit(0)).collect()
    assert len(clean) == docs.count() and not any(r["contamination"]["spans"] or r["contamination"]["items"] for r in clean)


def test_digest_of_items(spark, tmp_path):
    spark.createDataFrame([(1, "a b"), (2, None)], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, "a"), (9, "b")], ITEM).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, decontaminate.query(spark, str(tmp_path)).collect()))
    assert got == [(1, 2, 2, 2, hashlib.sha256(b"10,9").hexdigest(), True), (2, 0, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
