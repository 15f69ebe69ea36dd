import random
from itertools import product

import pytest
import xxhash

from loglens.llm import simhash


def brute_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """value -> smallest value reachable over differences of 2 bits or fewer."""
    prints, root = sorted(set(prints)), {}
    for p in prints:
        if p in root:
            continue
        todo, group = [p], {p}
        while todo:
            x = todo.pop()
            for y in prints:
                if y not in group and (x ^ y).bit_count() <= 2:
                    group.add(y)
                    todo.append(y)
        root |= dict.fromkeys(group, p)
    return root


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    root = brute_components(want.values())
    least = {}
    for i, p in want.items():
        least[root[p]] = min(i, least.get(root[p], i))
    got = simhash.query(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{p:016x}", least[root[p]]) for i, p in want.items()}
    assert len(got) == len(rows)


def signed(p):
    return p - (1 << 64) if p >> 63 else p


@pytest.mark.parametrize("max_distance", [0, 2, 4])
def test_segments_miss_no_pattern_of_bits(max_distance):
    """However the different bits fall on the segments, one segment is within its ball."""
    segments = simhash._segments(max_distance)
    assert sum(bits for _, bits, _ in segments) == 64
    for split in product(range(max_distance + 1), repeat=len(segments)):
        if sum(split) <= max_distance:
            assert any(n <= radius for n, (_, _, radius) in zip(split, segments))


@pytest.mark.parametrize("crowded", [0, 3, simhash.CROWDED])
def test_links_lose_no_near_pair(spark, crowded):
    """Also where every bucket, or those of some bases only, are crowded."""
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1]
    prints = {b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(4))) for b in base for _ in range(12)}
    prints |= {base[0] ^ x for x in rng.sample(range(1 << 32), 100)}        # one half in common
    edges = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long"), 2, crowded)
    found = {(r["src"] & (1 << 64) - 1, r["dst"] & (1 << 64) - 1) for r in edges.collect()}
    near = {(p, q) for p in prints for q in prints if p != q and (p ^ q).bit_count() <= 2}
    assert found <= near and {(q, p) for p, q in found} == found
    if crowded == simhash.CROWDED:
        assert {(p, q) for p, q in near if (p ^ base[0]) >> 32 and (q ^ base[0]) >> 32} <= found
    roots = simhash.components(edges)
    got = {r["node"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in roots.collect()}
    want = brute_components(prints)
    for p in prints:
        for q in prints:
            assert (want[p] == want[q]) == (got.get(p, p) == got.get(q, q))


def test_long_chain(spark):
    """A path of 200 fingerprints, each two bits from the next: one component."""
    path, x = [0], 0
    for i in range(200):
        x ^= 0b11 << (2 * i % 62) if (i // 31) % 2 == 0 else 0b110 << (2 * i % 60)
        path.append(x)
    edges = simhash.links(spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in set(path)], "fingerprint long"))
    want = brute_components(path)
    roots = {r["node"] & (1 << 64) - 1: r["root"] for r in simhash.components(edges).collect()}
    assert len({roots[p] for p in path}) == len(set(want.values()))


def test_odd_rows(spark, odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    zero = [r for r in got if r["fingerprint"] == 0]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, None} and all(r["component_id"] == 2 for r in zero)
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for _, i in {(r["root"], r["component_id"]) for r in got})
