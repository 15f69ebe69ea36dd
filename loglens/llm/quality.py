"""Quality rules: a learned decision list (operator 2); DataFrame and SQL functions only.

Statistics of every whole text come from SQL functions. On the labelled rows a decision list is
learned by sequential covering: a rule grows by the threshold condition with the best information
gain on two thirds of the rows, is pruned from its end on the other third, and is kept if it is
right there more often than not; the rows that it covers are taken out before the next rule. The
list becomes one ordered conditional expression. Counting is done by Spark, one small grouped
aggregate a step; the driver sees thresholds and counts, never rows.

Thresholds are midpoints between neighbouring quantiles of each class, so a rule's border stands
off from both classes.

Defined results: a null text has no words and fails the base; labels that are null are not used,
a row labelled twice has the lower label; without labels, or with one class, the list is empty
and keeps what passes the base. Repeated rows each get their row; extra columns are not used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, WORD, staged, table, whole_text

RULES, CONDITIONS = 8, 4            # a list's rules and a rule's conditions, at most
LEAST = 0.002                       # share of the rejected rows that a rule has to cover, at least
QUANTILES = 12

FEATURES = {
    "mean_word": "word_chars / n_words",
    "symbols": "n_symbols / n_words",
    "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
    "capitals": "n_capitals / word_chars",
    "marks": "n_marks / n_words",
    "distinct": "n_distinct / n_words",
    "words": "cast(n_words as double)",
}


def statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the counts of every whole text."""
    t = whole_text(text_col)
    count = lambda pattern: F.regexp_count("t", F.lit(pattern)).cast("long")
    one = df.select(*keep, t.alias("t"))
    one = one.select(*keep, F.array_remove(F.split("t", f"{SPACE}+"), "").alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
                     (F.length("t") - count(SPACE)).cast("long").alias("word_chars"), count(r"[#*$%&|<>]").alias("n_symbols"),
                     count(r"\p{Lu}").alias("n_capitals"), count(r"[!?]").alias("n_marks"))
    windows = F.expr("if(size(w) < 3, cast(array() as array<bigint>), transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))")
    one = one.withColumn("h", windows)
    # windows found twice or more, in the order of their hashes; most texts have none
    found = F.expr("if(size(array_distinct(h)) = size(h), null, sort_array(transform(h, (x, i) -> struct(x, i))))")
    one = one.withColumn("s", found).withColumn("p", F.expr("sort_array(transform(filter(s, (x, k) -> x.x <=> get(s, k - 1).x or x.x <=> get(s, k + 1).x), x -> x.i))"))
    covered = F.expr("coalesce(aggregate(transform(p, (x, k) -> if(k = 0, 3, least(3, x - p[k - 1]))), 0, (a, x) -> a + x), 0)")
    return one.select(*keep, F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                      covered.cast("long").alias("n_repeat_words"), "n_capitals", "n_marks", F.size("lines").cast("long").alias("n_lines"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))


def with_features(stats: DataFrame) -> DataFrame:
    """Add ``base_failed`` and the features (0 where there is no word)."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumns({k: F.when(F.col("n_words") > 0, F.expr(e)).otherwise(0.0) for k, e in FEATURES.items()})


@dataclass(frozen=True)
class Condition:
    """feature > threshold, or not; ``bin`` is the threshold's number."""
    feature: str
    bin: int
    threshold: float
    above: bool
    margin: float = 0.0         # between the two values that the threshold parts

    def on_bins(self) -> Column:
        return F.col(self.feature) > self.bin if self.above else F.col(self.feature) <= self.bin

    def on_values(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold


def _all(conditions, on: str) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & getattr(c, on)()
    return out


def thresholds(rows: DataFrame) -> dict[str, list[tuple[float, float]]]:
    """Midpoints between neighbouring quantiles of either class, and how far these are apart."""
    at = [i / QUANTILES for i in range(QUANTILES + 1)]
    found: dict[str, set[float]] = {f: set() for f in FEATURES}
    for r in rows.groupBy("bad").agg(*[F.percentile_approx(f, at, 2000).alias(f) for f in FEATURES]).collect():
        for f in FEATURES:
            found[f].update(r[f])
    return {f: [((a + b) / 2, b - a) for a, b in zip(v, v[1:])] for f, v in ((f, sorted(x)) for f, x in found.items())}


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """FOIL: the rejected rows covered, times the bits that the condition makes them surer."""
    from math import log2

    return p * (log2((p + 0.5) / (p + n + 1)) - log2((p0 + 0.5) / (p0 + n0 + 1)))


def _grow(rows: DataFrame, cuts: dict[str, list[tuple[float, float]]], p0: int, n0: int) -> list[Condition]:
    """The rule that ``rows`` (bins, bad, weight) suggest."""
    rule: list[Condition] = []
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES])).alias("x")
    while n0 and len(rule) < CONDITIONS:
        counts = rows.where(_all(rule, "on_bins")).select("bad", "weight", each).groupBy("x.f", "x.b").agg(
            F.sum(F.col("bad") * F.col("weight")).alias("p"), F.sum((1 - F.col("bad")) * F.col("weight")).alias("n")).collect()
        best: list[tuple[float, int, int, Condition]] = []
        for f in FEATURES:
            by_bin = {r["b"]: (r["p"], r["n"]) for r in counts if r["f"] == f}
            p = n = 0
            for b, (threshold, margin) in enumerate(cuts[f]):
                p, n = p + by_bin.get(b, (0, 0))[0], n + by_bin.get(b, (0, 0))[1]
                best.append((_gain(p0 - p, n0 - n, p0, n0), p0 - p, n0 - n, Condition(f, b, threshold, True, margin)))
                best.append((_gain(p, n, p0, n0), p, n, Condition(f, b, threshold, False, margin)))
        top = max((x[0] for x in best), default=0.0)
        if top <= 1e-9:
            break
        first = next(x for x in best if x[0] >= top - 1e-9)[3]
        ties = [x for x in best if x[0] >= top - 1e-9 and (x[3].feature, x[3].above) == (first.feature, first.above)]
        _, p0, n0, chosen = max(ties, key=lambda x: x[3].margin)    # of equally good thresholds the one in the widest gap
        rule.append(chosen)
    return rule


def learn(features: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """The rules that reject, in order, from labelled rows that pass the base."""
    named = labels.where("quality is not null").groupBy("doc_id").agg((1 - F.min("quality")).cast("int").alias("bad"))
    rows = staged(features.where(~F.col("base_failed")).join(named, "doc_id").select("doc_id", "bad", *FEATURES), "labelled")
    total = {r["bad"]: r["n"] for r in rows.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return []
    cuts = thresholds(rows)
    bin_of = lambda f: sum((F.col(f) > t).cast("int") for t, _ in cuts[f]) if cuts[f] else F.lit(0)
    part = (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(3)) == 0).alias("prune")
    cells = staged(rows.select("bad", part, *[bin_of(f).alias(f) for f in FEATURES]).groupBy("bad", "prune", *FEATURES).agg(F.count("*").alias("weight")), "cells")

    rules: list[list[Condition]] = []
    left = cells
    while len(rules) < RULES:
        n = {(r["prune"], r["bad"]): r["n"] for r in left.groupBy("prune", "bad").agg(F.sum("weight").alias("n")).collect()}
        if n.get((False, 1), 0) < max(2, LEAST * total[1]):
            break
        rule = _grow(left.where("not prune"), cuts, n.get((False, 1), 0), n.get((False, 0), 0))
        if not rule:
            break
        cut = left.where("prune").agg(*[F.sum(F.when(_all(rule[:k], "on_bins") & (F.col("bad") == y), F.col("weight")).otherwise(0)).alias(f"c{k}_{y}")
                                        for k in range(1, len(rule) + 1) for y in (0, 1)]).first()
        value = lambda k: ((cut[f"c{k}_1"] or 0) - (cut[f"c{k}_0"] or 0)) / max(1, (cut[f"c{k}_1"] or 0) + (cut[f"c{k}_0"] or 0))
        size = max(range(1, len(rule) + 1), key=lambda k: (value(k), -k))
        if value(size) <= 0 or (cut[f"c{size}_1"] or 0) < max(1, LEAST * n.get((True, 1), 0)):
            break
        rules.append(rule[:size])
        left = left.where(~_all(rule[:size], "on_bins"))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as an ordered conditional: the number of the first rule that rejects, else 0."""
    out = F
    for i, rule in enumerate(rules, 1):
        out = out.when(_all(rule, "on_values"), i)
    return out.otherwise(0) if rules else F.lit(0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, rule, kept of every row of ``docs`` (doc_id, text)."""
    features = staged(with_features(statistics(docs)), "features")
    return _judged(features, learn(features, labels))


def _judged(features: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    return features.withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base and the list keep, with all their columns.

    Rows are written once with their counts beside them, so texts are counted once and never
    shuffled; the list is learned from the narrow columns alone."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("own_text"))
    counted = staged(with_features(statistics(packed, "own_text", keep=("row",))), "features")
    rules = learn(counted.select("row.doc_id", "base_failed", *FEATURES), labels)
    return _judged(counted, rules).where("kept").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
