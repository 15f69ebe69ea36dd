from hypothesis import given, settings
from hypothesis import strategies as st

from loglens.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS = [("idiot", False, 1), ("worthless", False, 2), ("scum", False, 0), ("veju", True, 0), ("idiotic", False, 1)]
WORDS = st.sampled_from(["idiot", "worthless", "scum", "vejute", "idiotic", "idot", "worthles"]).flatmap(
    lambda w: st.lists(st.tuples(st.integers(0, 10), st.sampled_from("iodtwsx")), max_size=3).map(
        lambda changes: "".join(changes_at(w, changes))))


def changes_at(word, changes):
    out = list(word)
    for i, (at, ch) in enumerate(changes):
        at = min(at, len(out))
        if i % 3 == 0 and at < len(out):
            out[at] = ch
        elif i % 3 == 1:
            out.insert(at, ch)
        elif at < len(out):
            del out[at]
    return out


@settings(max_examples=400, deadline=None)
@given(WORDS | st.text("idotwrhlescumv", max_size=10))
def test_automaton_equals_edit_distance(word):
    matcher = toxicity.Matcher(TERMS)
    near = [distance(word, t) for t, p, e in TERMS if not p and distance(word, t) <= e]
    found = matcher.word(word)
    if near and min(near) == 0:
        assert found[0] == toxicity.EXACT
    elif word.startswith("veju"):
        assert found[0] == toxicity.PREFIX
    elif near:
        assert found[0] == toxicity.MISSPELLED + min(near) - 1
    else:
        assert found == 0


def test_states_can_be_forgotten(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 3)
    matcher = toxicity.Matcher(TERMS)
    assert [bool(matcher[w]) for w in ("idiot!", "worthlss", "(scum)", "fine", "you-idiot")] == [True, True, True, False, True]


def test_quotation():
    tokens = 'he said "you idiot" to them'.split()
    assert toxicity.quoted(tokens, 3)
    assert not toxicity.quoted("you are an idiot and a moron".split(), 3)


def test_learns_and_scores(spark, make_docs):
    from pyspark.sql import functions as F
    rows = []
    for i in range(400):
        term = ["idiot", "worthless"][i // 4 % 2] if i % 4 == 0 else "fox"
        rows.append((i, f"the quick number {i} you are w{i} {term} over hill {i * 7} go", "x"))
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    assert {"idiot", "worthless"} <= {t for t, _, _ in model[0]}
    asked = make_docs([(1, "what an idiot", "x"), (2, "what an idiiot", "x"), (3, "a quick fox", "x"), (4, None, "x"), (5, "", "x"), (6, "what a worhtless fox", "x")])
    got = {r["doc_id"]: r["toxicity"]["score"] for r in toxicity.score(asked, model).select("doc_id", "toxicity").collect()}
    assert got[1] > 0.5 and got[2] > 0.5 and got[6] > 0.5 and got[3] < 0.5 and got[4] == got[5] < 0.5
    assert got[1] >= got[2]
    assert toxicity.score(asked.withColumn("toxicity", F.lit(1)), model).columns.count("toxicity") == 1


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in toxicity.query(spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    assert sum(got[r["doc_id"]]["predicted"] == r["toxic"] for r in labels) >= 0.9 * len(labels)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_rows(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(odd_docs, none)
    out = toxicity.score(odd_docs, model)
    assert out.count() == odd_docs.count() and len({r["toxicity"]["score"] for r in out.collect()}) == 1
    one_class = spark.createDataFrame([(1, 1, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.learn(odd_docs, one_class)[0] == []
    assert toxicity.score(odd_docs.limit(0), model).count() == 0
