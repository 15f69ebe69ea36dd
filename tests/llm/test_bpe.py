import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from loglens.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, P.PATTERN, True)


def ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], "<u4").tolist()


PARTS = st.sampled_from(["a", "the", "tion", " ", "  ", "\n", "\n ", "'s", "'LL", "é", "ß", "1", "23", ".", "!!", "\x1c", "\x85", "\xa0", "\t", "日本", "😀", "<|endoftext|>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join) | st.text(max_size=30))
def test_equals_tiktoken(encoder, reference, text):
    assert ids(encoder, text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 20_000, "abcé" * 5_000, "x y " * 10_000, "the" * 9_000 + " " * 500])
def test_long_pre_tokens(encoder, reference, text):
    assert ids(encoder, text) == reference.encode_ordinary(text)


def test_lower_rank_made_by_a_merge_goes_first():
    # merging b c makes a pair (abc) whose rank lies below the rank being merged
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 300, b"bc": 301, b"bcd": 302}
    own = bpe.Encoder(ranks, r"(?s).+", False)
    want = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcabc", "bcdabcbc", "abcbcabcd"):
        assert ids(own, text) == want.encode_ordinary(text)


def test_memory_is_bounded(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 8)
    own = bpe.Encoder(ranks, P.PATTERN, True)
    for i in range(30):
        text = f"word{i} other{i}x {'z' * 60} end{i}"
        assert ids(own, text) == reference.encode_ordinary(text)
    assert len(own.led) < 40 and "z" * 60 not in own.led


def test_query(spark, sf_dir, reference):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in bpe.query(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = np.array(reference.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        assert got[r["doc_id"]]["n_tokens"] == len(want) // 4
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(want).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_odd_rows(spark, odd_docs):
    out = bpe.decode(bpe.encode(odd_docs, PATH, P.PATTERN), PATH)
    assert sorted(out.columns) == sorted([*odd_docs.columns, "decoded"])
    for r in out.collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.encode(odd_docs.limit(0), PATH, P.PATTERN).count() == 0


def test_unknown_ids_decode_to_null(spark):
    df = spark.createDataFrame([(bytearray(np.array([60_000], "<u4").tobytes()),), (None,)], "ids binary")
    assert [r["decoded"] for r in bpe.decode(df, PATH).collect()] == [None, None]


def test_small_memory_gives_the_same_ids(monkeypatch):
    """Pieces go from one generation of the memory to the next, or are encoded anew."""
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "TOGETHER", 40)
    encoder = bpe.Encoder(ranks, P.PATTERN, True, 3)
    texts = [f"the {w} of x{i % 7} and {w}-{i} it's\n the  end" for i in range(60) for w in ("house", "straße", "日本")]
    assert encoder.encode(texts) == [b"".join(t.to_bytes(4, "little") for t in own.encode_ordinary(x)) for x in texts]
    assert len(encoder.led) < 40
