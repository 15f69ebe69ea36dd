"""SimHash near-dedup by multi-index hashing (operator 4).

A 64-bit fingerprint is cut into segments, two for ``max_distance`` 2, and stands in a table under
each (segment, value). It fetches matches from the tables at all values in a small Hamming ball
around its own segment: with two halves, one bit around the first and none around the second find
every fingerprint within two bits. Each match is verified by the distance of the whole fingerprints.

Only different fingerprints take part (equal ones are one node), but any number of them may share a
segment's value. Where a bucket holds more than ``crowded``, the fingerprints within reach of it
meet half-way instead, all of them: each goes to every address within ``max_distance / 2`` bits of
the whole fingerprint, where at most a ball's worth can meet, and those are linked in a chain. So no
bucket is compared pair by pair beyond the bound, and no link is lost. Components come from repeated
contraction of links, each round written to the shared checkpoint folder.

Defined results: a null or wordless text has fingerprint zero and links like any other; a text
with fewer words than a shingle is one shingle; a null ``doc_id`` never names a component unless
its whole component has none; repeated rows each get their row. Extra columns are not used.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keyed, numbered, staged, table, whole_text

SEED = 42
#: Shingles whose bits are laid out at a time: 64 bytes each.
CHUNK = 1 << 15
#: Fingerprints of a bucket that are compared with those that probe it; a fuller bucket's meet half-way.
CROWDED = 64


def _hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of each shingle. ``bytes.lower`` changes A-Z alone and ``bytes.split`` splits at 20 and 09-0D alone."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    n = len(words) - shingle + 1
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    out = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits.sum(axis=0, dtype=np.int32)
    return out


def fingerprint(text: str, shingle: int) -> int:
    """The signed 64-bit SimHash; a bit is 1 if set in over half the hashes."""
    hashes = _hashes(text, shingle)
    if not len(hashes):
        return 0
    bits = 2 * _bit_counts(hashes) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, shingle: int = 3, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Add ``out_col`` (long, replacing a column of that name): the fingerprint of every whole text."""
    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.withColumn(out_col, simhash(whole_text(text_col)))


def _ball(radius: int, bits: int = 64) -> list[int]:
    """Masks of up to ``radius`` flipped bits of ``bits``; signed."""
    masks = [sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _segments(max_distance: int) -> list[tuple[int, int, int]]:
    """(lowest bit, bits, radius of the ball) of each segment.

    With r = m * a + b bits over m segments, one of the first b + 1 segments differs in a bits or fewer, or
    one of the others in a - 1 or fewer: otherwise there would be r + 1 different bits."""
    m = max_distance // 2 + 1
    a, b = divmod(max_distance, m)
    cuts = [64 * i // m for i in range(m + 1)]
    return [(low, high - low, a if i <= b else a - 1) for i, (low, high) in enumerate(zip(cuts, cuts[1:]))]


def _value(low: int, bits: int) -> Column:
    return F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long"))


def _reach(prints: DataFrame, segments: list[tuple[int, int, int]]) -> DataFrame:
    """fingerprint, segment, its own value there, and each value of the ball around it."""
    probes = [F.struct(F.lit(i).alias("segment"), _value(low, bits).alias("own"), F.lit(mask).cast("long").alias("mask"))
              for i, (low, bits, radius) in enumerate(segments) if radius >= 0 for mask in _ball(radius, bits)]
    return (prints.select("fingerprint", F.explode(F.array(*probes)).alias("p"))
            .select("fingerprint", "p.segment", "p.own", F.col("p.own").bitwiseXOR(F.col("p.mask")).alias("value")))


def _half_way(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fingerprint, other): a chain through the fingerprints that meet at each address."""
    ball = F.array(*[F.lit(m).cast("long") for m in _ball(max_distance // 2)])
    probes = (prints.select("fingerprint", F.explode(ball).alias("mask"))
              .select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("address")))
    return (probes.select("fingerprint", F.lag("fingerprint").over(W.partitionBy("address").orderBy("fingerprint")).alias("other"))
            .where("other is not null"))


def links(prints: DataFrame, max_distance: int = 2, crowded: int = CROWDED) -> DataFrame:
    """(src, dst), both ways, between fingerprints within ``max_distance`` bits: enough to connect all that are.

    ``prints`` has one column ``fingerprint`` of different values; it is read several times."""
    if max_distance not in (0, 2, 4):
        raise ValueError("max_distance must be 0, 2 or 4: crowded buckets meet half-way")
    segments = _segments(max_distance)
    rows = [F.struct(F.lit(i).alias("segment"), _value(low, bits).alias("value")) for i, (low, bits, radius) in enumerate(segments) if radius >= 0]
    tables = prints.select(F.col("fingerprint").alias("other"), F.explode(F.array(*rows)).alias("t")).select("other", "t.segment", "t.value")
    reach = _reach(prints, segments)
    full = tables.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > crowded)
    balls = F.element_at(F.array(*[F.array(*[F.lit(m).cast("long") for m in _ball(max(radius, 0), bits)]) for _, bits, radius in segments]), F.col("segment") + 1)
    full = staged(full.select("segment", "value", F.explode(balls).alias("mask"))
                  .select("segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value")).distinct(), "crowded")
    # of two different values that reach each other, the larger one probes
    probes, at = reach.where("value <= own"), ["segment", "value"]
    some = not full.isEmpty()
    if some:
        probes, tables = probes.join(full, at, "left_anti"), tables.join(full, at, "left_anti")
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= max_distance
    pairs = probes.join(tables, at).where(near & ((F.col("own") != F.col("value")) | (F.col("fingerprint") < F.col("other")))).select("fingerprint", "other")
    if some:
        pairs = pairs.union(_half_way(reach.join(full, at, "left_semi").select("fingerprint").distinct(), max_distance))
    both = F.explode(F.array(F.struct(F.col("fingerprint").alias("src"), F.col("other").alias("dst")),
                             F.struct(F.col("other").alias("src"), F.col("fingerprint").alias("dst"))))
    return pairs.select(both.alias("e")).select("e.src", "e.dst").distinct()


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) of every node of ``edges`` (both ways); None without edges.

    Each round joins every node to the least of its neighbourhood, in an order that changes with
    the round, and contracts: a component loses a constant share of its nodes each time."""
    rng = np.random.default_rng(7)
    edges, roots = staged(edges, "edges"), None
    while not edges.isEmpty():
        salt = int(rng.integers(-(1 << 62), 1 << 62))
        step = staged(edges.groupBy("src").agg(F.min(F.col("dst").bitwiseXOR(F.lit(salt))).alias("least"))
                      .select("src", F.least(F.col("least"), F.col("src").bitwiseXOR(F.lit(salt))).bitwiseXOR(F.lit(salt)).alias("to")), "step")
        roots = step.select(F.col("src").alias("node"), F.col("to").alias("root")) if roots is None else staged(
            roots.join(step, roots.root == step.src, "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
        a, b = step.select(F.col("src"), F.col("to").alias("a")), step.select(F.col("src").alias("dst"), F.col("to").alias("b"))
        edges = staged(edges.join(a, "src").join(b, "dst").where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct(), "edges")
    return roots


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint (long), component_id (smallest doc_id reachable) of every row of ``docs``.

    Also ``root``, a fingerprint that names the component, and the columns ``also`` of ``docs``."""
    own = staged(fingerprints(docs.select("doc_id", "text", *also), shingle).select("doc_id", "fingerprint", *also), "fingerprints")
    classes = staged(own.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes.select("fingerprint"), max_distance))
    rooted = classes.withColumn("root", F.col("fingerprint"))
    if roots is not None:
        rooted = classes.join(roots, classes.fingerprint == roots.node, "left").select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(rooted.join(least, "root").select("fingerprint", "component_id", "root"), "components")
    return own.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id", "root", *also)


def one_of_each(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of each component, that with the smallest id, with all columns of ``docs``."""
    rows, key = keyed(docs)
    found = near_duplicates(rows.select("doc_id", "text", F.col(key).alias("row")), shingle, max_distance, also=("row",))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    stay, number = numbered(rows.join(first.select(F.col("first.row").alias(key)), key, "left_semi"), key)
    return stay.where(F.col(number) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
