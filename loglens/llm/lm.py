"""Language-model scoring with a log-frequency Bloom filter (operator 10).

Words and word pairs of the training documents are counted exactly, by hashed key, in buckets of
the key space. A Bloom filter then holds, for each n-gram of count c, one entry for every level
up to ``level(c) = 1 + floor(log1.5 c)``; a count is read back by probing level after level until
one is missing. The filter has one segment per order and bucket, is built where its counts are,
and is probed there. Probabilities are Dirichlet-smoothed, from probes alone:

    P1(w) = (c(w) + a) / (N + a (V + 1)),  P(w | v) = (c(v w) + m P1(w)) / (c(v) + m)

``a`` and ``m`` are chosen from a small grid by leave-one-out likelihood of all training documents.

Documents are cut into chunks of tokens. A chunk sends each bucket its distinct n-grams, with their
counts in its training documents, and gets back the level of each, and of words the exact count. So
all n-grams are in the filter at every input size, nothing is broadcast, and a task holds one chunk
or one bucket.

Defined results: a null text is empty and scores its end token only; a null ``doc_id`` counts as
training; repeated rows each count and each get their row; with no training document the model
gives every token probability 1 (base and score 0). Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, staged, table, whole_text

BASE = 1.5                  # of the levels
PROBES = 4                  # bits of an entry
BITS_PER_ENTRY = 12
LEAST_PAIR = 2              # of `cutoffs` alone
HEAVY_WORDS = 1 << 19       # not used: all exact counts come with the answers
BUCKET_TOKENS = 1 << 21     # tokens for each bucket of the key space, on average
CHUNK_TOKENS = 1 << 20      # tokens of a chunk; a longer text is one chunk
TOGETHER = 1 << 21          # characters of texts that a task works on at a time
GRID = list(product((0.02, 0.1, 0.5, 1.0), (2.0, 20.0, 200.0, 2000.0, 20000.0, 1e6)))

_U = np.uint64
_K1, _K2, _K3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
#: Keys of the end token and of the context before a text; no word holds a space.
_END, _BEGIN = (_U(xxhash.xxh64_intdigest(x)) for x in (b" end", b" begin"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _K2
    x = (x ^ (x >> _U(27))) * _K3
    return x ^ (x >> _U(31))


def _pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return _mix(before * _K1 + words)


def level(counts: np.ndarray) -> np.ndarray:
    """Quantised counts, from 1."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def _least(lv: int) -> int:
    """Smallest count of a level."""
    return int(np.ceil(BASE ** (lv - 1) - 1e-9))


_VALUES = np.array([0.0] + [max(1.0, (_least(lv) + _least(lv + 1) - 1) / 2) for lv in range(1, 110)])


class Words(dict):
    """Word bytes -> a small number; ``keys_`` has their 64-bit keys. Number 0 is the end token."""

    def __init__(self):
        super().__init__({b" end": 0})
        self.keys_ = [int(_END)]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.keys_.append(xxhash.xxh64_intdigest(word))
        return n


def _tokens(texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens, each text's end included, and where each text starts."""
    number, parts, sizes = words.__getitem__, [], []
    for t in texts:
        w = t.encode("utf-8", "surrogatepass").lower().split()      # A-Z alone; 20 and 09-0D alone
        w.append(b" end")
        parts.append(np.fromiter(map(number, w), np.int32, len(w)))
        sizes.append(len(w))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    return np.concatenate(parts), starts


def _portions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows, in frames of about ``TOGETHER`` characters; a longer text has its own."""
    for frame in frames:
        if len(frame):
            size = frame["text"].str.len().cumsum() // TOGETHER
            yield from (part for _, part in frame.groupby(size.to_numpy()))


def _contexts(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[starts] = _BEGIN
    return before


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


_TOKENS = "chunk long, doc_ids array<long>, no_id array<boolean>, held array<boolean>, sizes array<long>, words binary, ids binary"
_COUNTED = "order int, bucket long, chunk long, keys binary, counts binary"
_ANSWERS = "order int, bucket long, chunk long, levels binary, counts binary, n_keys long, n_total long"
_LEVELS = "doc_id long, no_id boolean, held_out boolean, n_tokens long, n_known long, exact_log double, levels binary"


def _chunk_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a chunk: its rows, the keys of its words in order of appearance, and its tokens as numbers of words."""
    words, ids, sizes, doc_ids, no_id, held, chunk = Words(), [], [], [], [], [], TaskContext.get().partitionId() << 32

    def flush() -> pd.DataFrame:
        width = max(1, (len(words) - 1).bit_length() + 7 >> 3)      # bytes of a number; all lowest bytes come first
        planes = np.concatenate(ids).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()
        return pd.DataFrame({"chunk": [chunk], "doc_ids": [doc_ids], "no_id": [no_id], "held": [held], "sizes": [np.concatenate(sizes)],
                             "words": [np.array(words.keys_, "<u8").tobytes()], "ids": [planes]})

    for frame in _portions(frames):
        own, starts = _tokens(frame["text"], words)
        ids.append(own)
        sizes.append(np.diff(np.append(starts, len(own))))
        doc_ids += frame["doc_id"].tolist()
        no_id += frame["no_id"].tolist()
        held += frame["held_out"].tolist()
        if sum(map(len, ids)) >= CHUNK_TOKENS:
            yield flush()
            words, ids, sizes, doc_ids, no_id, held, chunk = Words(), [], [], [], [], [], chunk + 1
    if ids:
        yield flush()


def _chunk(words: bytes, planes: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a chunk's words, numbers of its tokens, where its texts start, and keys of the pairs."""
    keys = np.frombuffer(words, "<u8")
    ids = np.zeros(int(sizes.sum()), np.uint32)
    for i, plane in enumerate(np.frombuffer(planes, np.uint8).reshape(-1, len(ids))):
        ids |= plane.astype(np.uint32) << np.uint32(8 * i)
    starts = np.cumsum(sizes) - sizes
    own = keys[ids]
    return keys, ids, starts, _pair_keys(_contexts(own, starts), own)


def _count_task(bits: int):
    def rows(order: int, chunk: int, keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        at = _bucket(keys, bits)
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(keys)]
        return pd.DataFrame([(order, int(at[s]), chunk, keys[s:e].tobytes(), counts[s:e].astype("<u4").tobytes()) for s, e in zip(edges, edges[1:])],
                            columns=["order", "bucket", "chunk", "keys", "counts"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for chunk, held, sizes, words, planes in zip(frame["chunk"], frame["held"], frame["sizes"], frame["words"], frame["ids"]):
                keys, ids, _, pairs = _chunk(words, planes, np.asarray(sizes))
                train = np.repeat(~np.asarray(held, bool), sizes)
                by = np.argsort(keys)
                yield rows(1, chunk, keys[by], np.bincount(ids[train], minlength=len(keys))[by])
                pairs, at = np.unique(pairs, return_inverse=True)
                yield rows(2, chunk, pairs, np.bincount(at[train], minlength=len(pairs)))
    return run


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Builds the filter of one bucket from all its counts, and gives each chunk the levels of the n-grams it sent."""
    order = int(group["order"].iloc[0])
    keys, at = np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in group["keys"]]), return_inverse=True)
    sent = [np.frombuffer(x, "<u4") for x in group["counts"]]
    counts = np.bincount(at, np.concatenate(sent), len(keys)).astype("<i8")     # exact below 2^53
    seen = counts > 0
    merged = pd.DataFrame({"order": [order], "bucket": [0], "keys": [keys[seen].tobytes()], "counts": [counts[seen].tobytes()]})
    least = {1: 1, 2: 1}
    segment = next(_segment_task(least)(iter([merged])))["bits"].iloc[0]
    probed = Filter(0, least, [(order, 0, segment)])
    levels = np.concatenate([probed.levels(x, order).astype(np.uint8) for x in np.array_split(keys, 1 + (len(keys) >> 17))])
    parts = np.split(at, np.cumsum([len(x) for x in sent])[:-1])
    out = group[["order", "bucket", "chunk"]].copy()
    out["levels"] = [levels[x].tobytes() for x in parts]
    out["counts"] = [counts[x].tobytes() if order == 1 else b"" for x in parts]
    out["n_keys"], out["n_total"] = [[total] + [0] * (len(out) - 1) for total in (int(seen.sum()), int(counts.sum()))]
    return out


def _levels_of_chunk(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Per row the exact base, and the levels of its words, of their contexts and of the pairs, one after the other."""
    answers = answers.sort_values(["order", "bucket"])      # keys of a bucket are sorted, and all above those of lower ones
    one, two = (answers[answers["order"] == o] for o in (1, 2))
    (doc_ids, no_id, held, sizes, words, planes), = zip(*(chunk[c] for c in ("doc_ids", "no_id", "held", "sizes", "words", "ids")))
    sizes = np.asarray(sizes)
    keys, ids, starts, pairs = _chunk(words, planes, sizes)
    by = np.argsort(keys)
    word, exact = np.empty(len(keys), np.uint8), np.empty(len(keys), np.int64)
    word[by] = np.frombuffer(b"".join(one["levels"]), np.uint8)
    exact[by] = np.frombuffer(b"".join(one["counts"]), "<i8")
    pair = np.frombuffer(b"".join(two["levels"]), np.uint8)[np.unique(pairs, return_inverse=True)[1]]
    own, counts = word[ids], exact[ids]
    context = np.empty_like(own)
    context[1:] = own[:-1]
    context[starts] = word[0]       # texts begin as often as they end
    context = np.maximum(context, pair)
    return pd.DataFrame({
        "doc_id": doc_ids, "no_id": no_id, "held_out": held, "n_tokens": sizes, "n_known": np.add.reduceat((counts > 0).astype(np.int64), starts),
        "exact_log": np.add.reduceat(np.log10(counts + 1.0), starts),
        "levels": [np.concatenate([x[s:s + n] for x in (own, context, pair)]).tobytes() for s, n in zip(starts, sizes)]})


def cutoffs(per_level: dict[int, dict[int, int]], max_bytes: int) -> dict[int, int]:
    """The least level of each order that a filter of bounded size could hold. ``score`` does not cut: its filter holds all."""
    least = {1: 1, 2: int(level(np.array([LEAST_PAIR]))[0])}

    def size(order: int) -> int:
        return sum(n * (lv - least[order] + 1) for lv, n in per_level.get(order, {}).items() if lv >= least[order])

    while (size(1) + size(2)) * BITS_PER_ENTRY > max_bytes * 8:
        least[2 if size(2) else 1] += 1
    return least


def _entry_bits(keys: np.ndarray, lv: int, size: np.ndarray):
    """The ``PROBES`` bit positions of (key, level), within a segment of ``size`` bits, one array at a time."""
    for i in range(0, PROBES, 2):
        h = _mix(keys + _U((2 * i + 1) * int(_K1) * (lv + 1) & 0xFFFFFFFFFFFFFFFF))
        yield ((h >> _U(32)) * size) >> _U(32)
        yield ((h & _U(0xFFFFFFFF)) * size) >> _U(32)


def _segment_task(least: dict[int, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for order, bucket, raw, counts in zip(frame["order"], frame["bucket"], frame["keys"], frame["counts"]):
                keys, lvs = np.frombuffer(raw, "<u8"), level(np.frombuffer(counts, "<i8"))
                low = least[order]
                n = int(np.maximum(lvs - low + 1, 0).sum())
                bits = max(64, -(-n * BITS_PER_ENTRY // 64) * 64)
                out = np.zeros(bits, bool)
                for lv in range(low, int(lvs.max(initial=0)) + 1):
                    own = keys[lvs >= lv]
                    for at in _entry_bits(own, lv, np.full(len(own), bits, _U)):
                        out[at.astype(np.int64)] = True
                yield pd.DataFrame({"order": [order], "bucket": [bucket], "bits": [np.packbits(out, bitorder="little").tobytes()]})
    return run


class Filter:
    """Segments of the filter; ``levels`` and ``counts`` probe them."""

    def __init__(self, bits: int, least: dict[int, int], segments: list[tuple[int, int, bytes]]):
        self.bits, self.least = bits, least
        self.data = np.frombuffer(b"".join(x[2] for x in segments) or b"\0" * 8, np.uint8)
        self.start, self.size = np.zeros((3, 1 << bits), _U), np.zeros((3, 1 << bits), _U)
        at = 0
        for order, bucket, raw in segments:
            self.start[order, bucket], self.size[order, bucket] = at * 8, len(raw) * 8
            at += len(raw)

    def counts(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Approximate counts, 0 where nothing is found; never below an entry's own level."""
        return _VALUES[self.levels(keys, order)]

    def levels(self, keys: np.ndarray, order: int) -> np.ndarray:
        at = _bucket(keys, self.bits)
        live = np.flatnonzero(self.size[order][at])
        found, lv = np.zeros(len(keys), np.int64), self.least[order]
        while len(live):
            own = keys[live]
            size, start = self.size[order][at[live]], self.start[order][at[live]]
            for place in range(PROBES):     # those that miss a bit leave at once
                for i, p in enumerate(_entry_bits(own, lv, size)):
                    if i == place:
                        break
                p = (p + start).astype(np.int64)
                hit = np.flatnonzero(self.data[p >> 3] >> (p & 7).astype(np.uint8) & 1)
                live, own, size, start = live[hit], own[hit], size[hit], start[hit]
            found[live] = lv
            lv += 1
        return found


def _log10(levels: np.ndarray, n: int, v: int, a: float, m: float, less: int = 0) -> np.ndarray:
    """Of rows of levels (word, context, pair); with ``less`` 1, as if the token had not been counted."""
    words, context, pairs = (np.maximum(_VALUES[x] - less, 0) for x in levels)
    return np.log10((pairs + m * ((words + a) / (n + a * (v + 1)))) / (context + m))


def _joined(blobs) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, np.uint8).reshape(3, -1) for x in blobs], axis=1)


def _tune_task(n: int, v: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                levels = _joined(frame["levels"]).astype(np.int32)
                codes, times = np.unique(levels[0] << 14 | levels[1] << 7 | levels[2], return_counts=True)
                levels = np.stack([codes >> 14, codes >> 7 & 127, codes & 127])
                yield pd.DataFrame({"cell": range(len(GRID)), "total": [float(times @ _log10(levels, n, v, *g, 1)) for g in GRID]})
    return run


def _score_task(n: int, v: int, a: float, m: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                sizes = frame["n_tokens"].to_numpy()
                out = frame[["doc_id", "no_id", "held_out", "n_tokens", "n_known"]].copy()
                out["train_tokens"] = n
                out["base_score"] = frame["exact_log"] - sizes * np.log10(float(n + v + 1))
                out["score"] = np.add.reduceat(_log10(_joined(frame["levels"]), n, v, a, m), np.cumsum(sizes) - sizes)
                yield out
    return run


def score(docs: DataFrame, held_out_mod: int = 7, held_out_rest: int = 2, max_filter_bytes: int = 128 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    ``max_filter_bytes`` bounds the mean segment of a bucket: there are as many buckets as that takes."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), whole_text("text").alias("text"), F.coalesce(fold("doc_id", held_out_mod) == held_out_rest, F.lit(False)).alias("held_out"))
    n_chars = own.agg(F.sum(F.length("text") + 1)).first()[0]
    most = min(BUCKET_TOKENS, max(1, max_filter_bytes * 8 // BITS_PER_ENTRY))       # a token adds one entry at most
    bits = max(0, int(np.ceil(np.log2(max(1, (n_chars or 0) / 6 / most)))))
    chunks = staged(own.mapInPandas(_chunk_task, _TOKENS), "chunks")
    answers = staged(chunks.drop("doc_ids", "no_id").mapInPandas(_count_task(bits), _COUNTED).groupBy("order", "bucket").applyInPandas(_answer, _ANSWERS), "answers")
    n, v = (x or 0 for x in answers.where("order = 1").agg(F.sum("n_total"), F.sum("n_keys")).first())
    levels = staged(chunks.groupBy("chunk").cogroup(answers.drop("n_keys", "n_total").groupBy("chunk")).applyInPandas(_levels_of_chunk, _LEVELS), "levels")

    train = levels.where(~F.col("held_out")).select("levels")
    totals = {r["cell"]: r["total"] for r in train.mapInPandas(_tune_task(n, v), "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect()}
    a, m = GRID[max(totals, key=lambda c: (totals[c], -c))] if totals else GRID[0]     # without training all give the same

    scored = levels.mapInPandas(_score_task(n, v, a, m), "doc_id long, no_id boolean, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
