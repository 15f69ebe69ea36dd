"""Toxicity by Levenshtein automata intersected with a lexicon trie (operator 6).

The lexicon is learned from labelled training rows: words, and prefixes that at least three
different words share, that occur in toxic texts far oftener than chance allows. Its trie is
intersected with the Levenshtein automaton of each term (no edit below 5 letters, one below 8,
two from 8 on); the product is made deterministic as texts need it, so that a word costs one
table step for each character and leaves at the first that no term allows. Each hit is scored in
its context window: a term within quotation marks, or next to a word of reported speech, counts
as quoted. A logistic model over the counts of exact, prefix, misspelled and quoted hits, with a
prior that holds where the labels show no case, gives the score.

A word's support is the number of its toxic texts, but no more than the number of different words
that precede it there, so a text with a thousand copies does not make its words suspicious. Misspellings of a term are used only if the training texts don't show the
words near it to be harmless.

Defined results: null and empty texts get the score of a text without hits; labels that are null
are not used, a row labelled twice is toxic if one label says so; a null ``doc_id`` is not held
out; without labels, or with one class, there is no lexicon and every text gets the base rate.
Repeated rows each get their row; a column named like an output is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, staged, table, whole_text

#: Labelled rows to learn from, at most (in expectation: rows are taken by a hash of their id).
TRAIN_ROWS = 8192
#: Terms of a lexicon, at most; those with most support.
TERMS = 4096
STEMS = (4, 5, 6)                       # letters of a prefix
PRECISION, CHANCE = 0.9, 0.01
WINDOW = 6
WORDS, STEPS = 1 << 18, 1 << 18         # of a worker's memory
KEYS = 1 << 16                          # counted in a task before they are sent on

_QUOTES = "\"'“”„‟«»‹›‘’‚"
_STRIP = _QUOTES + ".,;:!?()[]{}<>…|*#$%&_~`+=/\\-–—"
_OPEN, _CLOSE = tuple("\"'“„«‹‘‚»"), tuple("\"'”“»›’«")
_REPORTED = frozenset("said says say saying quote quoted quotes quoting wrote writes called calls word words term terms "
                      "insult insults sagte sagt schrieb nannte wort wörter zitat dit écrit appelé mot mots cite "
                      "dijo dice escribió llamó palabra palabras cita".split())

EXACT, PREFIX, MISSPELLED, TWICE = 1, 2, 3, 4
_FEATURES = 4
#: Prior mean of the bias and of the weights of exact, prefix, misspelled and quoted hits.
_PRIOR = np.array([-3.0, 5.0, 5.0, 4.5, 1.0])


def edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Matcher(dict):
    """Token -> 0, or (kind, term). ``lexicon``: (term, is prefix, allowed edits)."""

    def __init__(self, lexicon: list[tuple[str, bool, int]]):
        super().__init__()
        self.lexicon = lexicon
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]           # terms that end at a node
        self.most = [0]                             # edits that a term below a node allows
        for t, (term, _, allowed) in enumerate(lexicon):
            node = 0
            for ch in term:
                self.most[node] = max(self.most[node], allowed)
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.children[node][ch]
            self.most[node] = max(self.most[node], allowed)
            self.ends[node].append(t)
        self.reset()

    def reset(self) -> None:
        """Forget the states made so far. State 0 is dead, 1 the start."""
        self.states: list[frozenset] = [frozenset(), self._close({0: 0})]
        self.number = {s: i for i, s in enumerate(self.states)}
        self.step: list[dict[str, int]] = [{}, {}]
        self.verdicts: list[tuple[int, int] | int | None] = [0, None]
        self.n_steps = 0

    def _close(self, nodes: dict[int, int]) -> frozenset:
        """Add what a missing letter reaches, and prefixes that are complete (as -1 - term)."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if node < 0 or nodes[node] < e:
                continue
            if e == 0:
                for t in self.ends[node]:
                    if self.lexicon[t][1]:
                        nodes[-1 - t] = 0
            for child in self.children[node].values():
                if e + 1 <= self.most[child] and e + 1 < nodes.get(child, 99):
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(nodes.items())

    def _next(self, state: int, ch: str) -> int:
        nodes: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if node < 0 or e <= self.most[node]:
                if e < nodes.get(node, 99):
                    nodes[node] = e

        for node, e in self.states[state]:
            if node < 0:
                reach(node, 0)
                continue
            reach(node, e + 1)                      # a letter too many
            for c, child in self.children[node].items():
                reach(child, e + (c != ch))         # the letter, or another in its place
        made = self._close(nodes)
        if made not in self.number:
            self.number[made] = len(self.states)
            self.states.append(made)
            self.step.append({})
            self.verdicts.append(None)
        self.step[state][ch] = self.number[made]
        self.n_steps += 1
        return self.number[made]

    def _verdict(self, state: int):
        if self.verdicts[state] is None:
            best = (99, 0, 0)
            for node, e in self.states[state]:
                if node < 0:
                    best = min(best, (1, PREFIX, -1 - node))
                    continue
                for t in self.ends[node]:
                    _, prefix, allowed = self.lexicon[t]
                    if e <= allowed and not prefix:
                        best = min(best, (2 * e, (EXACT, MISSPELLED, TWICE)[e], t))
            self.verdicts[state] = best[1:] if best[0] < 99 else 0
        return self.verdicts[state]

    def word(self, word: str):
        if self.n_steps > STEPS:
            self.reset()
        state = 1
        for ch in word:
            after = self.step[state].get(ch)
            state = self._next(state, ch) if after is None else after
            if not state:
                return 0
        return self._verdict(state)

    def __missing__(self, token: str):
        core = token.strip(_STRIP)
        found = self.word(core)
        if not found and ("-" in core or "/" in core):
            found = next((f for f in map(self.word, core.replace("/", "-").split("-")) if f), 0)
        if len(self) >= WORDS:
            self.clear()
        self[token] = found
        return found


def quoted(tokens: list[str], i: int) -> bool:
    """Whether the window around token ``i`` shows a quotation: marks on both sides, or reported speech."""
    before, after = tokens[max(0, i - WINDOW):i + 1], tokens[i:i + WINDOW + 1]
    if any(t.startswith(_OPEN) for t in before) and any(t.rstrip(".,;:!?)").endswith(_CLOSE) for t in after):
        return True
    near = tokens[max(0, i - 3):i] + tokens[i + 1:i + 3]
    return any(t.strip(_STRIP) in _REPORTED for t in near)


def hits(text: str, matcher: Matcher) -> list[tuple[int, int, str, bool]]:
    """(token position, kind, term, quoted) of every hit in a whole text."""
    tokens = text.lower().split()
    found = list(map(matcher.__getitem__, tokens))
    return [(i, f[0], matcher.lexicon[f[1]][0], quoted(tokens, i)) for i, f in enumerate(found) if f] if any(found) else []


def features(found: list[tuple[int, int, str, bool]]) -> tuple[int, ...]:
    out = [0] * _FEATURES
    for _, kind, _, is_quoted in found:
        out[_FEATURES - 1 if is_quoted else min(kind, MISSPELLED) - 1] += 1
    return tuple(min(x, 8) for x in out)


def _inputs(rows: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(rows)), np.log2(1.0 + rows)])


def _fit(rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic weights around ``_PRIOR`` (unit variance), by Newton steps."""
    x, w = _inputs(rows), _PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (toxic - p)) - (w - _PRIOR)
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.eye(len(w)), grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


_WORD, _PAIR, _STEM = 0, 1, 2


def _support(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and clean texts have each word, (word, preceding word) and stem, summed over a task's texts."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pd.DataFrame:
        keys = list(seen[0].keys() | seen[1].keys())
        out = pd.DataFrame(keys, columns=["kind", "word", "before"])
        out["clean"], out["toxic"] = ([c[k] for k in keys] for c in seen)
        for c in seen:
            c.clear()
        return out

    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"]):
            words = [w for w in (t.strip(_STRIP) for t in text.lower().split()) if w]
            own = seen[1 if toxic else 0]
            own.update((_PAIR, w, v) for w, v in set(zip(words, [""] + words[:-1])))
            words = set(words)
            own.update((_WORD, w, "") for w in words)
            own.update((_STEM, p, "") for p in {w[:n] for w in words for n in STEMS if len(w) > n})
            if len(seen[0]) + len(seen[1]) > KEYS:
                yield flush()
    if seen[0] or seen[1]:
        yield flush()


def _significant(words: DataFrame, rate: float, n_words: int) -> DataFrame:
    """Rows whose toxic share is ``PRECISION`` or more, beyond chance among ``n_words`` tries."""
    n, p = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    part = lambda q, r: F.when(q > 0, q * F.log(q / F.lit(r))).otherwise(0.0)
    evidence = n * (part(p, rate) + part(1 - p, 1 - rate))
    return words.where((p >= PRECISION) & (evidence >= float(np.log(max(n_words, 1) / CHANCE))))


def learn(docs: DataFrame, labels: DataFrame, held_out_mod: int = 5) -> tuple[list[tuple[str, bool, int]], list[float]]:
    """Lexicon and weights, from labelled rows that are not held out (crc32 of the id modulo ``held_out_mod`` is not 0)."""
    named = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(fold("doc_id", held_out_mod) != 0)
    n = named.count()
    share = min(1.0, TRAIN_ROWS / max(1, n))
    rows = named.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))
    # the broadcast side has at most TRAIN_ROWS rows (expected) of two numbers
    train = staged(docs.select("doc_id", whole_text("text").alias("text")).join(F.broadcast(rows), "doc_id").dropDuplicates(["doc_id"]), "labelled")
    base = np.array([[r["toxic"], r["n"]] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()]).reshape(-1, 2)
    n_toxic, n_clean = (int(base[base[:, 0] == y, 1].sum()) for y in (1, 0))
    if not n_toxic or not n_clean:
        rate = np.log((n_toxic + 0.5) / (n_clean + 0.5)) if n_toxic + n_clean else -3.0
        return [], [float(rate), *_PRIOR[1:]]

    seen = train.mapInPandas(_support, "kind int, word string, before string, clean long, toxic long").groupBy("kind", "word", "before").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    seen = staged(seen, "support")
    texts = lambda c, kind: F.sum(F.when(F.col("kind") == kind, F.col(c)))
    contexts = F.sum(F.when((F.col("kind") == _PAIR) & (F.col("toxic") > 0), 1).otherwise(0))
    words = staged(seen.where(F.col("kind") != _STEM).groupBy("word").agg(F.least(texts("toxic", _WORD), contexts).alias("toxic"), texts("clean", _WORD).alias("clean")), "words")
    n_words = words.count()
    rate = min(n_toxic / (n_toxic + n_clean), 0.85)
    top = lambda df: df.orderBy(F.desc("toxic"), "word").limit(TERMS).collect()
    terms = [r["word"] for r in top(_significant(words, rate, n_words))]
    forms = words.where("toxic > 0").select(F.explode(F.array_distinct(F.array(*[F.expr(f"if(length(word) > {n}, left(word, {n}), null)") for n in STEMS]))).alias("word"), "toxic").where("word is not null")
    forms = forms.groupBy("word").agg(F.count("*").alias("forms"), F.sum("toxic").alias("contexts")).where("forms >= 3")
    stems = seen.where(F.col("kind") == _STEM).join(forms, "word").select("word", F.least("toxic", "contexts").alias("toxic"), "clean")
    prefixes: list[str] = []
    for p in sorted((r["word"] for r in top(_significant(stems, rate, n_words))), key=lambda p: (len(p), p)):
        if not any(p.startswith(q) for q in prefixes):
            prefixes.append(p)
    lexicon = [(t, False, edits(t)) for t in sorted(terms)] + [(p, True, 0) for p in prefixes]
    lexicon = _trusted(words, lexicon)

    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(shared.value)
        for frame in frames:
            rows = [(int(y), *features(hits(t, matcher))) for t, y in zip(frame["text"], frame["toxic"])]
            yield pd.DataFrame(rows, columns=["toxic", "f0", "f1", "f2", "f3"])

    names = [f"f{i}" for i in range(_FEATURES)]
    cells = train.mapInPandas(counted, "toxic int, " + ", ".join(f"{x} int" for x in names)).groupBy("toxic", *names).count().collect()
    x = np.array([[r[c] for c in names] for r in cells], float)
    return lexicon, _fit(x, np.array([r["toxic"] for r in cells], float), np.array([r["count"] for r in cells], float)).tolist()


def _trusted(words: DataFrame, lexicon: list[tuple[str, bool, int]]) -> list[tuple[str, bool, int]]:
    """Allow a term only so many edits as the training words near it bear out."""
    shared = words.sparkSession.sparkContext.broadcast(lexicon)

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(shared.value)
        for frame in frames:
            rows = [(f[1], f[0], int(a), int(b)) for f, a, b in zip(map(matcher.word, frame["word"]), frame["toxic"], frame["clean"]) if f and f[0] >= MISSPELLED]
            yield pd.DataFrame(rows, columns=["term", "kind", "toxic", "clean"])

    allowed = [e for _, _, e in lexicon]
    for r in words.mapInPandas(near, "term int, kind int, toxic long, clean long").groupBy("term", "kind").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect():
        if r["clean"] and r["toxic"] < PRECISION * (r["toxic"] + r["clean"]):
            allowed[r["term"]] = min(allowed[r["term"]], r["kind"] - MISSPELLED)
    return [(t, p, e) for (t, p, _), e in zip(lexicon, allowed)]


def score(df: DataFrame, model: tuple[list[tuple[str, bool, int]], list[float]], text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """Add ``out_col``: struct of score (0 to 1) and hits (token position, term, kind, quoted)."""
    shared = df.sparkSession.sparkContext.broadcast(model)      # at most 2 * TERMS short words
    kept: dict[int, Matcher] = {}

    @F.pandas_udf("score double, hits array<struct<at:int, term:string, kind:int, quoted:boolean>>")
    def toxicity(texts: pd.Series) -> pd.DataFrame:
        lexicon, weights = shared.value
        if 0 not in kept:
            kept[0] = Matcher(lexicon)
        matcher = kept[0]
        found = [hits(t, matcher) for t in texts]
        z = _inputs(np.array([features(f) for f in found], float).reshape(-1, _FEATURES)) @ np.array(weights)
        return pd.DataFrame({"score": 1 / (1 + np.exp(-z)), "hits": [[{"at": i, "term": t, "kind": k, "quoted": q} for i, k, t, q in f] for f in found]})

    return df.withColumn(out_col, toxicity(whole_text(text_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), F.col("toxicity.score").alias("score"),
                         F.when(F.col("toxicity.score") >= 0.5, 1).otherwise(0).alias("predicted"))
