import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from clickspark.llm import bpe
from llm_data import SF_SMALL, docs, none, odd  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(reference, i, text):
    ids = reference.encode_ordinary(text or "")
    raw = b"".join(x.to_bytes(4, "little") for x in ids)
    return i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def run(df):
    return sorted(map(tuple, bpe.round_trip_digests(df, PATH, PATTERN).collect()), key=repr)


def test_matches_the_library_on_documents(spark, reference):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert run(df) == sorted((expected(reference, r.doc_id, r.text) for r in df.collect()), key=repr)


def test_odd_rows(odd, none, reference):
    assert run(odd) == sorted((expected(reference, r.doc_id, r.text) for r in odd.collect()), key=repr)
    assert run(none) == []


def test_encode_and_decode_are_inverse(odd):
    coded = bpe.encode_documents(odd, PATH, PATTERN)
    back = sorted((bytes(r.data) for r in bpe.decode_documents(coded, PATH).collect()))
    assert back == sorted((r.text or "").encode() for r in odd.collect())


def test_random_text_and_long_pieces(reference, monkeypatch):
    vocab = bpe.load_vocabulary(PATH)
    memo, rng = bpe.encoder(vocab), random.Random(3)
    alphabet = "ab zéßñÀ×÷ʫʬ'\u0130ſ \t\n\r\x0b\x0c\x1c\x85\u00a0\u2028²½٣漢字😀<|endoftext|>0 19_-'s"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)] + ["a" * 3000, " " * 500 + "x", "é" * 999]
    for limit in (bpe.LIST_CHARS, 5):
        monkeypatch.setattr(bpe, "LIST_CHARS", limit)
        for t in texts:
            got = b"".join(bpe.encode_blocks(t, memo, PATTERN))
            assert got == b"".join(x.to_bytes(4, "little") for x in reference.encode_ordinary(t)), t
            assert bpe.decode_ids(got, vocab.entries) == t.encode()


def test_perfect_hash_is_minimal_and_perfect():
    keys = [f"k{i}".encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slots) == list(range(5000))
    assert all(h.index(k) == i for i, k in enumerate(keys))
    assert 0 <= h.index(b"unknown") < 5000
