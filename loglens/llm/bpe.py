"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 1).

The pre-tokens that a worker has not met before lie one after the other in one linked list of
tokens. Their neighbouring pairs are queued by merge rank: one bucket per rank holds the positions
where that pair starts, and a bitmap of 64-bit words over the ranks, with two summary levels above
it, gives the lowest rank in use by three find-first-set steps. A merge changes at most two
neighbouring pairs; their old entries stay in their buckets and are skipped when they come up. A
pre-token of n bytes takes O(n log n) steps, so runs of letters of any length are safe.

Defined results: a null text is the empty text and has no ids; an id outside the vocabulary,
or null ids, decode to null; a column named like the output column is replaced, all other
columns stay. Every row is encoded on its own, so ties and repeated rows need no rule.
"""

from __future__ import annotations

import base64
import gc
import re
from functools import lru_cache
from itertools import filterfalse, islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, whole_text

#: Entries of a generation of a worker's memory of encoded pieces (about 200 bytes each; there are two, and what is met
#: again goes from the older to the newer), and the longest piece that it keeps.
CACHE_ENTRIES = 1 << 20
CACHE_CHARS = 48
#: Characters of texts that a worker encodes together (a longer text goes alone).
TOGETHER = 1 << 18
#: Bytes of pieces that share one queue (a longer piece has its own): they and their lists stay in a core's cache.
QUEUED = 1 << 14
#: White space before a space.
_SPACES = re.compile(r"\s ").search


class Encoder:
    """Texts -> ids as little-endian unsigned 32-bit integers; remembers the pieces it has encoded.

    The rank queue: ``buckets[rank]`` lists positions, bit ``rank & 63`` of ``words[rank >> 6]``
    says whether it has any, ``groups`` has a bit for each word in use and ``top`` (local to
    ``merge``) a bit for each group in use. ``merge`` leaves the queue empty.

    With ``cuts``, no match of the pattern goes on over a space that follows another character than
    white space, so texts are cut there before the pattern is applied."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cuts: bool, remembered: int | None = None):
        self.ranks, self.cuts, self.remembered = ranks, cuts, remembered or CACHE_ENTRIES
        self.split = regex.compile(pattern).findall
        n = max(ranks.values(), default=0) + 1
        self.buckets: list[list[int]] = [[] for _ in range(n)]
        self.words = [0] * ((n >> 6) + 1)
        self.groups = [0] * ((n >> 12) + 1)
        self.packed = {k: v.to_bytes(4, "little") for k, v in ranks.items()}
        self.of_byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.of_two = np.full(1 << 16, -1, np.int32)
        self.pairs: dict[int, int] = {}     # left token << 20 | right token -> the token that both make
        for token, rank in ranks.items():
            if len(token) == 2:
                self.of_two[token[0] << 8 | token[1]] = rank
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 20 | b] = rank
        self.led: dict[str, bytes] = {}     # what stands between two spaces, with the space before it
        self.older: dict[str, bytes] = {}   # the same, from before ``led`` was begun
        self.bare: dict[str, bytes] = {}    # other pre-tokens

    def encode(self, texts: list[str]) -> list[bytes]:
        out, some, size = [], [], 0
        gc.disable()                        # there are no cycles, only very many short strings
        try:
            for t in texts:
                some.append(t)
                size += len(t)
                if size >= TOGETHER:
                    out += self._together(some)
                    some, size = [], 0
            return out + self._together(some)
        finally:
            gc.enable()

    def _together(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") if self.cuts and not _SPACES(t) else None for t in texts]
        whole = [t if c is None else c[0] for t, c in zip(texts, cut)]      # no space before these
        if len(self.led) > self.remembered:
            self.older, self.led = self.led, {}
        new: set[str] = set()
        for c in cut:
            if c:
                new.update(filterfalse(self.led.__contains__, islice(c, 1, None)))
        met = {c: self.older[c] for c in new if c in self.older}
        self.led.update(met)
        new.difference_update(met)
        whole_ids, long = self._learn(new, set(whole))
        ids = self.led.__getitem__
        out = [b"".join([whole_ids[w], *map(ids, c[1:])]) if c and len(c) > 1 else whole_ids[w] for w, c in zip(whole, cut)]
        for x in long:
            self.led.pop(x, None)
            self.bare.pop(x, None)
        return out

    def _learn(self, new: set[str], whole: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """Add the new cuttings to ``led``. Returns the ids of all whole texts, and what is not worth remembering."""
        if len(self.bare) > self.remembered:
            self.bare.clear()
        led, bare = self.led, self.bare
        # letters after one space are one pre-token, so they need no pattern
        split = {c: self.split(" " + c) for c in new if not (self.cuts and c.isalpha())}
        split_whole = {w: self.split(w) for w in whole}
        pieces = {p for ps in (*split.values(), *split_whole.values()) for p in ps}
        after_space = {p: p[1:] for p in pieces if self.cuts and p[0] == " " and p[1:].isalpha()}
        todo = [(led, x, " " + x) for x in {*after_space.values(), *(c for c in new if c not in split)} if x not in led]
        todo += [(bare, p, p) for p in pieces if p not in after_space and p not in bare]
        for (kept, x, _), ids in zip(todo, self.merge([p.encode("utf-8", "surrogatepass") for _, _, p in todo])):
            kept[x] = ids
        ids_of = {p: led[after_space[p]] if p in after_space else bare[p] for p in pieces}.__getitem__
        for c, ps in split.items():
            led[c] = b"".join(map(ids_of, ps))
        # what holds the end of a line hardly comes again
        long = [c for c in new if len(c) > CACHE_CHARS or "\n" in c] + [x for _, x, p in todo if len(p) > CACHE_CHARS]
        return {w: b"".join(map(ids_of, ps)) for w, ps in split_whole.items()}, long

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece."""
        packed = self.packed
        todo = [p for p in pieces if p not in packed]
        made: dict[bytes, bytes] = {}
        start = size = 0
        for end, piece in enumerate(todo, 1):
            size += len(piece)
            if size >= QUEUED or end == len(todo):
                self._merge(todo[start:end], made)
                start, size = end, 0
        return [packed.get(p) or made[p] for p in pieces]

    def _merge(self, todo: list[bytes], made: dict[bytes, bytes]) -> None:
        """Add the ids of some pieces, which share one queue, to ``made``."""
        raw = b"".join(todo)
        n, rank_of, top = len(raw), self.pairs.get, 0
        buckets, words, groups = self.buckets, self.words, self.groups
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))   # linked list: starts of tokens
        starts = np.cumsum([0] + [len(p) for p in todo])
        first = np.zeros(n + 1, np.uint8)
        first[starts] = 1
        codes = np.frombuffer(raw, np.uint8).astype(np.int32)
        ranks = np.append(self.of_two[codes[:-1] << 8 | codes[1:]], -1)
        ranks[starts[1:] - 1] = -1                                      # pairs over the end of a piece
        pair = ranks.tolist()                                           # rank of the pair that starts here; -1: none
        token = self.of_byte[codes].tolist()                            # token that starts here; -1: none
        first = first.tobytes()
        by = np.argsort(ranks, kind="stable")
        by = by[np.searchsorted(ranks[by], 0):]
        for part in np.split(by, np.flatnonzero(np.diff(ranks[by])) + 1):
            if len(part):
                r = pair[part[0]]
                buckets[r] = part.tolist()
                words[r >> 6] |= 1 << (r & 63)
                groups[r >> 12] |= 1 << (r >> 6 & 63)
                top |= 1 << (r >> 12)
        while top:                                                      # take the bucket of the lowest rank
            g = (top & -top).bit_length() - 1
            group = groups[g]
            w = g << 6 | (group & -group).bit_length() - 1
            word = words[w]
            r = w << 6 | (word & -word).bit_length() - 1
            words[w] = word = word & (word - 1)
            if not word:
                groups[g] = group = group & (group - 1)
                if not group:
                    top &= top - 1
            bucket, buckets[r] = buckets[r], []
            bucket.sort()                                               # leftmost first
            left = r << 20
            for at, i in enumerate(bucket, 1):
                if pair[i] != r:                                        # stale: this pair has changed since
                    continue
                j = after[i]
                k = after[i] = after[j]
                pair[j] = token[j] = -1
                token[i] = least = r
                if first[k]:
                    pair[i] = -1
                else:
                    before[k] = i
                    q = pair[i] = rank_of(left | token[k], -1)
                    if q >= 0:
                        if not buckets[q]:
                            words[q >> 6] |= 1 << (q & 63)
                            groups[q >> 12] |= 1 << (q >> 6 & 63)
                            top |= 1 << (q >> 12)
                        buckets[q].append(i)
                        least = q
                if not first[i]:
                    h = before[i]
                    q = pair[h] = rank_of(token[h] << 20 | r, -1)
                    if q >= 0:
                        if not buckets[q]:
                            words[q >> 6] |= 1 << (q & 63)
                            groups[q >> 12] |= 1 << (q >> 6 & 63)
                            top |= 1 << (q >> 12)
                        buckets[q].append(h)
                        if q < least:
                            least = q
                if least < r and at < len(bucket):                      # a lower rank comes first
                    buckets[r] = bucket[at:]
                    words[r >> 6] |= 1 << (r & 63)
                    groups[r >> 12] |= 1 << (r >> 6 & 63)
                    top |= 1 << (r >> 12)
                    break
        tokens = np.array(token, np.int32)
        live = tokens >= 0
        ids = tokens[live].astype("<u4").tobytes()
        ends = (4 * np.cumsum(live)[starts[1:] - 1]).tolist()
        made.update((p, ids[a:b]) for p, a, b in zip(todo, [0, *ends], ends))


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x.strip())}


@lru_cache(maxsize=4)
def _encoder(data: bytes, pattern: str, remembered: int | None) -> Encoder:
    import public_tokenizers

    return Encoder(read_ranks(data), pattern, pattern == public_tokenizers.PATTERN, remembered)


class Decoder:
    """Ids -> bytes, from one long run of all tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        n = max(ranks.values(), default=-1) + 1
        self.size = np.full(n, -1, np.int64)        # -1: no such id
        self.start = np.zeros(n, np.int64)
        self.blob = np.frombuffer(b"".join(ranks), np.uint8)
        at = 0
        for token, rank in ranks.items():
            self.size[rank], self.start[rank] = len(token), at
            at += len(token)

    def decode(self, packed: bytes) -> bytes | None:
        ids, out = np.frombuffer(packed, "<u4"), []
        for at in range(0, len(ids), TOGETHER):
            some = ids[at:at + TOGETHER]
            if some.max() >= len(self.size) or (size := self.size[some]).min() < 0:
                return None
            ends = np.cumsum(size)
            where = np.repeat(self.start[some] - ends + size, size)
            where += np.arange(len(where))
            out.append(self.blob[where].tobytes())
        return b"".join(out)


@lru_cache(maxsize=4)
def _decoder(data: bytes) -> Decoder:
    return Decoder(read_ranks(data))


def _broadcast(spark: SparkSession, ranks_path: str):
    """The rank file, read by the driver: a fixed vocabulary of under 1 MB, whatever the input."""
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "ids", remembered: int | None = None) -> DataFrame:
    """Add ``out_col`` (binary): each text's ids as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is merged separately, without special tokens. ``remembered``: entries of a generation of
    a worker's memory (``CACHE_ENTRIES`` if not given); fewer take less memory and more time."""
    shared = _broadcast(df.sparkSession, ranks_path)

    @F.pandas_udf(T.BinaryType())
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(_encoder(shared.value, pattern, remembered).encode(list(texts)), dtype=object)

    return df.withColumn(out_col, ids(whole_text(text_col)))


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add ``out_col`` (binary): the bytes that the ids in ``ids_col`` stand for."""
    shared = _broadcast(df.sparkSession, ranks_path)

    @F.pandas_udf(T.BinaryType())
    def decoded(ids: pd.Series) -> pd.Series:
        decode_one = _decoder(shared.value).decode
        return pd.Series([None if x is None else decode_one(x) for x in ids], dtype=object)

    return df.withColumn(out_col, decoded(F.col(ids_col)))


def digests(docs: DataFrame, ranks_path: str, pattern: str, remembered: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of whole documents, by ``encode`` and ``decode``."""
    ids = encode(docs.select("doc_id", "text"), ranks_path, pattern, remembered=remembered).select("doc_id", "ids")
    both = decode(ids, ranks_path)
    return both.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                   public_tokenizers.PATTERN)
