import json
import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickspark.llm import packing
from clickspark.llm.bpe import encode_blocks
from llm_data import SF_SMALL, docs, none, odd  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(df, **more):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    want = sorted(b"".join(x.to_bytes(4, "little") for x in [*tok.encode(r.text or "", add_special_tokens=False).ids, 1])
                  for r in df.collect())
    rows = packing.pack_documents(df, PATH, public_tokenizers.PATTERN, **more).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    return want, rows


def test_documents_round_trip(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want, rows = check(df, bucket_tokens=20_000)
    tok = Tokenizer.from_file(PATH)
    ids = {r.doc_id: b"".join(x.to_bytes(4, "little") for x in [*tok.encode(r.text, add_special_tokens=False).ids, 1]) for r in df.collect()}
    seen = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) // 4
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start:4 * (r.start + r.length)])
        seen[r.doc_id] += r.length
    assert seen == {i: len(b) // 4 for i, b in ids.items()}


def test_odd_rows(odd, none):
    want, rows = check(odd)
    assert sum(r.length for r in rows) == sum(len(b) // 4 for b in want)
    assert sum(r.start == 0 for r in rows) == odd.count()
    assert check(none)[1] == []


@pytest.mark.parametrize("seed", range(20))
def test_assign_covers_every_token_once(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 3, rng.randrange(1, 300), 2048, rng.randrange(1, 9000)]) for _ in range(rng.randrange(1, 200))]
    rows = packing.assign(lengths)
    for d, n in enumerate(lengths):
        at = 0
        for _, s, k, *_ in sorted(r for r in rows if r[0] == d):
            assert s == at and k > 0
            at += k
        assert at == n
    full = packing.capacities(sum(lengths))
    fill = defaultdict(int)
    for _, _, k, q, o in sorted(rows, key=lambda r: (r[3], r[4])):
        assert o == fill[q]
        fill[q] += k
    assert [fill[q] for q in range(len(full))] == full.tolist()


def test_costs_are_balanced():
    rng = random.Random(1)
    lengths = [rng.randrange(20, 900) for _ in range(3000)]
    cost = defaultdict(float)
    fill = defaultdict(int)
    for _, _, n, q, _ in packing.assign(lengths):
        cost[q] += n * (1 + n / packing.QUADRATIC)
        fill[q] += n
    full = [cost[q] for q in cost if fill[q] == 2048]
    assert max(full) < 1.35 * min(full)


def test_pretokens_by_the_model_equal_the_whole_tokenizer():
    with open(PATH, encoding="utf-8") as f:
        definition = f.read()
    tok, memo = packing._tokenizer(definition), packing._encoder(definition)
    rng = random.Random(1)
    pool = [*map(chr, range(0x300)), *"\u4e2d\u0416\U0001f600\ue000\u200b\u2028\ufeff\u0301\u0660\u3000", "<|endoftext|>", "'s"]
    for _ in range(5000):
        text = "".join(rng.choices(pool, k=rng.randrange(40)))
        want = b"".join(x.to_bytes(4, "little") for x in tok.encode(text, add_special_tokens=False).ids)
        assert b"".join(encode_blocks(text, memo, public_tokenizers.PATTERN)) == want


@pytest.mark.parametrize("part, value", [("normalizer", {"type": "Lowercase"}), ("pre_tokenizer", {"type": "Whitespace"}),
                                         ("pre_tokenizer", None)])
def test_other_tokenizers_are_refused(spark, tmp_path, part, value):
    with open(PATH, encoding="utf-8") as f:
        definition = json.load(f) | {part: value}
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(definition))
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        packing.pack_documents(df, str(path), public_tokenizers.PATTERN)
