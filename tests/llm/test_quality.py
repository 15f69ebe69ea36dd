import collections
import re

from loglens.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_against_brute_force(spark, odd_docs, sf_dir):
    for docs in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = docs.select("doc_id", "text").collect()
        want = sorted((str(r["doc_id"]), *brute(r["text"])) for r in rows)
        got = sorted((str(r["doc_id"]), *(r[c] for c in BASE)) for r in quality.statistics(docs).collect())
        assert got == want


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = quality.query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    features = quality.staged(quality.with_features(quality.statistics(docs)), "features")
    rules = quality.learn(features, labels.where("doc_id % 4 <> 0"))
    assert rules and all(len(r) <= quality.CONDITIONS for r in rules)
    judged = quality._judged(features, rules).join(labels.where("doc_id % 4 = 0"), "doc_id").where("not base_failed").collect()
    assert sum(r["kept"] == bool(r["quality"]) for r in judged) >= 0.95 * len(judged)


def test_two_rules_with_two_conditions(spark):
    """Bad rows: many symbols, or many repeats together with few capitals."""
    rows = []
    for i in range(1200):
        symbols, repeats, capitals = (i * 7 % 100) / 100, (i * 13 % 97) / 100, (i * 29 % 89) / 100
        bad = symbols > 0.7 or (repeats > 0.5 and capitals <= 0.3)
        rows.append((i, symbols, repeats, capitals, int(not bad)))
    flat = spark.createDataFrame(rows, "doc_id long, symbols double, repeats double, capitals double, quality int")
    from pyspark.sql import functions as F
    features = flat.withColumns({f: F.lit(0.0) for f in quality.FEATURES if f not in flat.columns}).withColumn("base_failed", F.lit(False))
    rules = quality.learn(features, flat.select("doc_id", "quality"))
    judged = quality._judged(features, rules).collect()
    assert len(rules) >= 2 and sum(r["kept"] == bool(r["quality"]) for r in judged) >= 0.93 * len(judged)


def test_without_labels_or_rows(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, None), (6, None, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        got = quality.judge(odd_docs, labels).collect()
        assert len(got) == odd_docs.count() and all(r["kept"] == (not r["base_failed"]) for r in got)
    kept = quality.keep_good(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["kept"] for r in got)
    assert quality.judge(odd_docs.limit(0), none).count() == 0
