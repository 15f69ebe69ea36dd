import duckdb
from pyspark.sql import functions as F

from loglens.llm import chat


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    got = chat.query(spark, sf_dir)
    want = con.execute(chat.SQL)
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_three_speakers(spark):
    rows = [("c", 0, "system", "be kind"), ("c", 1, "Ann", "hi"), ("c", 2, "Bob", "yo"), ("c", 3, "Cy", ""), ("c", 300, "Ann", "bye"), ("d", 0, "system", "alone"),
            (None, 1, "Ann", None), ("e", None, None, "x"), ("e", None, None, "x"), ("e", 1, "Bob", "last\nline")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("speaker", "bucket", "head", "place", "conv", "of")})
    out = chat.rotate(df).orderBy("conv_id", "speaker", "position").collect()
    assert {(r["conv_id"], r["speaker"]) for r in out} == {("c", "Ann"), ("c", "Bob"), ("c", "Cy"), (None, "Ann"), ("e", "Bob"), ("e", "unknown")}
    for conv, speaker in {(r["conv_id"], r["speaker"]) for r in out}:
        own = [r for r in out if (r["conv_id"], r["speaker"]) == (conv, speaker)]
        text = "".join(r["segment"] for r in own)
        assert [r["position"] for r in own] == list(range(len(own)))
        for r in own:
            assert text[r["start"]:r["end"]] == r["segment"]
            if r["role"] == speaker:
                assert r["segment"].startswith("<|im_start|>assistant\n") and text[r["loss_start"]:r["loss_end"]].endswith("<|im_end|>")
            else:
                assert r["loss_start"] is None and r["loss_end"] is None
    ann = "".join(r["segment"] for r in out if r["conv_id"] == "c" and r["speaker"] == "Ann")
    assert ann == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=Bob\nyo<|im_end|>\n"
                   "<|im_start|>user name=Cy\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n")
    assert [r["turn"] for r in out if r["conv_id"] == "e" and r["speaker"] == "Bob"] == [1, None, None]
    assert chat.rotate(df.limit(0)).count() == 0


def test_long_conversation_is_spread(spark):
    df = spark.range(5000).select(F.lit("big").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.col("id").cast("string").alias("text"))
    out = chat.rotate(df)
    ends = out.where("speaker = 'a'").orderBy("position").select("start", "end", "turn").collect()
    assert len(ends) == 5000 and all(x["end"] == y["start"] for x, y in zip(ends, ends[1:])) and [r["turn"] for r in ends] == list(range(5000))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_equal_and_null_turns_are_spread(spark, monkeypatch):
    seen, sums = [], chat.prefix_sums

    def watched(df, group, bucket, *rest):
        seen.append(df.groupBy(*group, bucket).count().agg(F.max("count")).first()[0])
        return sums(df, group, bucket, *rest)

    monkeypatch.setattr(chat, "ROWS", 100, raising=False)
    monkeypatch.setattr(chat, "prefix_sums", watched)
    df = spark.range(5000).select(F.lit(None).cast("string").alias("conv_id"), F.when(F.col("id") % 2 == 0, 3).cast("long").alias("turn"), F.lit("a").alias("role"), F.lit("x").alias("text"))
    out = chat.rotate(df).orderBy("position").select("position", "start", "end", "turn").collect()
    assert seen == [100]
    assert [r["position"] for r in out] == list(range(5000)) and all(x["end"] == y["start"] for x, y in zip(out, out[1:]))
    assert [r["turn"] for r in out] == [3] * 2500 + [None] * 2500


def test_more_messages_than_a_packed_sum_holds(spark):
    n = (1 << 23) + 1000
    df = spark.range(n).select(F.lit("big").alias("conv_id"), F.col("id").alias("turn"), F.lit("a").alias("role"), F.lit("").alias("text"))
    size = len("<|im_start|>assistant\n<|im_end|>\n")
    out = chat.rotate(df).agg(F.max("position"), F.max("end"), F.max(F.abs(F.col("position") - F.col("turn"))), F.max(F.abs(F.col("start") - size * F.col("turn"))))
    assert tuple(out.first()) == (n - 1, n * size, 0, 0)
