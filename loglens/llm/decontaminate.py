"""Benchmark decontamination by Wu-Manber search for many strings (operator 12).

The strings are the windows of the benchmark's items: ``window`` consecutive words, or all of an
item of fewer. A text is searched as its words between single spaces, so a string with a space at
both ends can only occur at words. Strings are classed by length (powers of two); for each class
the table of shifts says, for the block of bytes before the current place, how far the search may
go on without missing a string, which for most blocks is nearly the length of the shortest string.
A block that ends some string's first ``m`` bytes shifts by nothing: the bucket of that block and
of the bytes ``m`` before it has the strings to test, and direct comparison confirms each.

The windows are dealt into blocks of about ``BLOCK_BYTES``; only one block at a time reaches the
driver and is broadcast. One block, the usual case, is searched where the documents are. More of
them take one pass over the (then written) documents each, and the findings are joined by row.

Defined results: a null, empty or wordless text has no words and is clean; an item without words
has no windows; items of one id are one item; an item without id marks words but is not counted or
listed; without benchmark items all is clean; repeated rows each get their row. A column named
like the output is replaced, all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, fresh, letter_words, staged, table, whole_text

WINDOW = 10
BLOCK_BYTES = 1 << 23                   # of windows that are searched in one pass
HASHED, FIRST = 8, 128                  # bytes of a hashed block; of a string that the tables know, at most
CHUNK = 64                              # neighbouring windows stay together, as they share table entries
_FOUND = "struct<n_words: long, spans: array<struct<start: int, end: int>>, items: array<string>>"
_FOUND_TYPE = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))])


def spaced(words: list[bytes]) -> bytes:
    return b" %s " % b" ".join(words)


class Tables:
    """Shift table and suffix buckets of strings of like length."""

    def __init__(self, strings: list[bytes]):
        self.m = m = min(FIRST, min(map(len, strings)))
        self.hashed = b = max(1, min(HASHED, m // 2))
        self.most = m - b + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[bytes]]] = {}
        for s in strings:
            for end in range(b, m + 1):
                block = s[end - b:end]
                if m - end < self.shift.get(block, self.most):
                    self.shift[block] = m - end
            self.buckets.setdefault(s[m - b:m], {}).setdefault(s[:b], []).append(s)

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(offset, string) of every occurrence, by offset."""
        m, b, most, shift = self.m, self.hashed, self.most, self.shift.get
        at, n = m, len(text)
        while at <= n:
            block = text[at - b:at]
            step = shift(block, most)
            if step:
                at += step
                continue
            start = at - m
            for s in self.buckets[block].get(text[start:start + b], ()):
                if text.startswith(s, start):
                    yield start, s
            at += 1


class Matcher:
    """All windows of a block: the tables of each class of length, and each window's items."""

    def __init__(self, windows: list[tuple[bytes, str | None]]):
        self.items: dict[bytes, set[str]] = {}
        for w, item in windows:
            own = self.items.setdefault(w, set())
            if item is not None:
                own.add(item)
        classes: dict[int, list[bytes]] = {}
        for w in self.items:
            classes.setdefault(min(len(w), FIRST).bit_length(), []).append(w)
        self.tables = [Tables(c) for _, c in sorted(classes.items())]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words that windows cover, joined and in order, and the items of those windows."""
        text = spaced(words)
        hits = [h for t in self.tables for h in t.search(text)]
        if not hits:
            return [], set()
        hits.sort(key=lambda h: h[0])
        spans, seen, at, word = [], set(), 0, 0
        for offset, s in hits:
            word += text.count(b" ", at, offset)
            at = offset
            end = word + s.count(b" ") - 1
            seen.add(s)
            if spans and word <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([word, end])
        return [(a, b) for a, b in spans], set().union(*(self.items[s] for s in seen))


_BUILT: dict[str, Matcher] = {}


def _matcher(token: str, shared) -> Matcher:
    """The matcher of a broadcast block; a worker keeps one, also from task to task."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Matcher(shared.value)
    return _BUILT[token]


def windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """window (binary), item (string), chunk (long): the windows of every item, in chunks of neighbours."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, item, row in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = letter_words(text)
                starts = range(max(1, len(words) - window + 1)) if words else range(0)
                for i in range(0, len(starts), CHUNK):
                    some = [spaced(words[j:j + window]) for j in starts[i:i + CHUNK]]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array([item] * len(some), pa.string()), pa.array([row * 1_000_003 + i] * len(some), pa.int64())], names=["window", "item", "chunk"])

    rows = items.select(whole_text(text_col).alias("text"), F.col(id_col).cast("string").alias("item"), F.xxhash64(id_col, text_col).bitwiseAND((1 << 40) - 1).alias("row"))
    return rows.mapInArrow(cut, "window binary, item string, chunk long")


def _search(text_col: str, block: list[tuple[bytes, str | None]], spark: SparkSession):
    """A column of n_words, spans (ranges of words, end exclusive) and items of every text, for one block of windows."""
    shared, token = spark.sparkContext.broadcast(block), uuid4().hex        # about BLOCK_BYTES

    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        matcher, out = _matcher(token, shared), []
        for text in as_bytes(texts):
            words = letter_words(text)
            spans, items = matcher.find(words)
            out.append({"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items)})
        return pa.array(out, _FOUND_TYPE)

    return found(whole_text(text_col))


def _joined(lists: pa.Array) -> pa.Array:
    """Ranges from several passes as ranges that don't touch, in order."""
    out = []
    for spans in lists.to_pylist():
        own: list[dict] = []
        for s in sorted(spans or (), key=lambda s: s["start"]):
            if own and s["start"] <= own[-1]["end"]:
                own[-1]["end"] = max(own[-1]["end"], s["end"])
            else:
                own.append(dict(s))
        out.append(own)
    return pa.array(out, _FOUND_TYPE.field("spans").type)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", out_col: str = "contamination", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``out_col``: struct of n_words, spans (hit ranges of words: start, end exclusive; apart and in order), items
    (ids as strings, sorted)."""
    spark = docs.sparkSession
    dealt = staged(windows(items, window, item_col, item_text_col), "windows")
    size = dealt.agg(F.coalesce(F.sum(F.length("window") + F.coalesce(F.length("item"), F.lit(0))), F.lit(0)).alias("n")).first()["n"]
    number = F.pmod(F.xxhash64("chunk"), F.lit(max(1, -(-size // block_bytes))))

    def block(b: int) -> list[tuple[bytes, str | None]]:
        rows = dealt.where(number == b).select("window", "item").distinct().collect()
        return [(bytes(r["window"]), r["item"]) for r in rows]

    if size <= block_bytes:
        return docs.withColumn(out_col, _search(text_col, block(0), spark))
    blocks = [r["b"] for r in dealt.select(number.alias("b")).distinct().collect()]      # size / block_bytes numbers at most
    row, found, of = fresh(docs, "row"), fresh(docs, "found"), fresh(docs, "found_in")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "searched")
    passes = []
    for b in blocks:
        one = rows.select(row, text_col).withColumn(found, _search(text_col, block(b), spark)).where(F.size(f"{found}.spans") > 0)
        passes.append(staged(one.select(F.col(row).alias(of), f"{found}.spans", f"{found}.items"), "pass"))
    hits = passes[0]
    for p in passes[1:]:
        hits = hits.unionByName(p)
    hits = hits.groupBy(of).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = hits.select(of, F.struct("spans", "items").alias(found))
    words = rows.withColumn(f"{found}_n", _search(text_col, [], spark).getField("n_words"))
    both = words.join(hits, words[row] == hits[of], "left")
    joined, none = F.arrow_udf(_joined, "array<struct<start: int, end: int>>"), F.array().cast("array<string>")
    out = F.struct(F.col(f"{found}_n").alias("n_words"), joined(F.col(f"{found}.spans")).alias("spans"), F.coalesce(F.col(f"{found}.items"), none).alias("items"))
    return both.withColumn(out_col, out).drop(*({row, of, found, f"{found}_n"} - {out_col}))


def n_hit(found: str) -> Column:
    """Words in the spans of a ``contamination`` column."""
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def uncontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a window of any item, with their own columns."""
    found = fresh(docs, "contamination")
    return contamination(docs, items, window, out_col=found).where(F.size(f"{found}.spans") == 0).drop(found)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.col("contamination.items")
    return found.select("doc_id", F.col("contamination.n_words").alias("n_words"), n_hit("contamination").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.size("contamination.spans") > 0).alias("contaminated"))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), cut AS (
  SELECT item_id, words, least(len(words), 10) AS k, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM items WHERE len(words) > 0
), patterns AS MATERIALIZED (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(words, i, i + k - 1), ' ') AS w FROM cut
), starts AS (
  SELECT n, k, words, unnest(range(1, len(words) - k + 2)) AS p FROM docs, (SELECT DISTINCT k FROM patterns) WHERE len(words) >= k
), hits AS MATERIALIZED (
  SELECT n, p, k, item_id FROM (SELECT n, k, p, array_to_string(list_slice(words, p, p + k - 1), ' ') AS w FROM starts) JOIN patterns USING (k, w)
), marked AS (
  SELECT n, count(DISTINCT place) AS n_hit FROM (SELECT n, unnest(range(p, p + k)) AS place FROM hits) GROUP BY n
), named AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT n, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY n
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (n) LEFT JOIN named USING (n)
"""
