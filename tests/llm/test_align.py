import functools
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from clickspark.llm import align
from llm_data import LONG, SF_SMALL, docs, none, odd  # noqa: F401
from tokenizers import Tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = ["a", " ", "  ", "\n", " \n", "\n\n x", "a ", "a  ", "a\n", "tab\there", "a 　 b", "　　 x", "x  y", "\x1c a\x1c b", "\x00nul \x00", "it's we'll",
             "日本語 テキスト", "é ñ 🙂🙂", "a▁b", "<s> </s> <unk> <0x0A>", "\r\n win\r\n", "\xa0nb \xa0sp", "<|endoftext|> x", " " * 3000 + "x" + "\n \t" * 900]


@functools.cache
def models():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    letters = {c: b for b, c in align._byte_letters().items()}
    size = {i: bytes(letters[c] for c in s) for s, i in t.get_vocab(with_added_tokens=False).items() if all(c in letters for c in s)}
    return t, size, sentencepiece.SentencePieceProcessor(model_file=B)


def spelled(text):
    """A and B tokens as (id, bytes) of the whole text by the libraries."""
    t, size, sp = models()
    a = [(i, size[i]) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
    return a, b


def brute(rows):
    links, out = {}, []
    for n, (_, text) in enumerate(rows):
        a, b = spelled(text) if text else ([], [])
        if not text or b"".join(x for _, x in a) != (" " + text).encode() or b"".join(x for _, x in b) != (" " + text).encode():
            links[n] = None
            continue
        ends = [{}, {}]
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, x in tokens:
                at += len(x)
                ends[side][at] = i
        both = sorted(set(ends[0]) & set(ends[1]))
        links[n] = (len(a), len(b), [(ends[0][x], ends[1][x]) for x in both],
                    ";".join("|".join(",".join(str(i) for at, i in ends[side].items() if low < at <= high) for side in (0, 1))
                             for low, high in zip([0, *both], both)) if len(a) < 2000 else None)
    counts = Counter(x for v in links.values() if v for x in v[2])
    top = defaultdict(int)
    for (_, b), c in counts.items():
        top[b] = max(top[b], c)
    for n, (i, _) in enumerate(rows):
        if not links[n]:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, pairs, said = links[n]
        out.append((i, n_a, n_b, len(pairs), len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(said.encode()).hexdigest() if said is not None else None))
    return sorted(out, key=repr)


def run(df, **more):
    return sorted(map(tuple, align.align(df, A, B, public_tokenizers.PATTERN, **more).documents.collect()), key=repr)


def same(got, want):
    """Equal rows; the digest of a very long text is left to the comparison of chunk sizes."""
    assert [g[:7] for g in got] == [w[:7] for w in want]
    assert all(w[7] is None or g[7] == w[7] for g, w in zip(got, want))


def test_documents_as_the_libraries_align_them(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    got = run(df)
    same(got, want)
    assert run(df, chunk_bytes=300) == got                  # ranges cut through words; up to three rounds of the tree


@pytest.mark.parametrize("more", [{}, {"chunk_bytes": 3}, {"chunk_bytes": 1000}])
def test_odd_rows(spark, docs, odd, none, more):  # noqa: F811
    extra = docs([(100 + i, t, "en", "a") for i, t in enumerate(ODD_TEXTS)] + [(None, "null id twice", None, None)] * 2)
    df = odd.unionByName(extra) if more.get("chunk_bytes") != 3 else extra
    same(run(df, **more), brute([(r.doc_id, r.text) for r in df.collect()]))
    assert run(none, **more) == []


def aligner():
    with open(A) as a, open(B, "rb") as b:
        return align.Aligner(a.read(), b.read(), public_tokenizers.PATTERN)


def test_ranges_cover_a_text_once_and_overlap_little():
    rng = random.Random(1)
    for text in (" " + LONG, " " + "".join(rng.choices("ab é\n日", k=3000)), " " + "z" * 5000 + " tail", " "):
        for size in (1, 7, 100, 1 << 16):
            parts, data = list(align.ranges(text, size)), text.encode()
            assert parts[0][0] == 0 and parts[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
            assert all(data[start:start + len(w.encode())] == w.encode() and start <= low and start + len(w.encode()) >= high for low, high, start, w in parts)
            assert sum(len(p[3]) for p in parts) <= 2 * len(text) + 2


def test_combination_is_associative_and_rebuilds_the_groups():
    rng, al = random.Random(2), aligner()
    for _ in range(60):
        text = " " + "".join(rng.choices(["the", " quick", "isation", "é", "日", "\n", " ", "xq", "'ll", "1234"], k=rng.randrange(1, 30)))
        a, b, at = [], [], 0
        for unit in align._CUT.split(text):
            x, y = al.tokens(unit, at)
            a, b, at = a + x, b + y, at + len(unit.encode())
        cuts = sorted(rng.sample(range(1, at), min(at - 1, rng.randrange(1, 6))))
        starts = lambda side: [0, *(e for _, e in side)]
        leaves, groups = [], []
        for low, high in zip([0, *cuts], [*cuts, at]):
            f, inner = align.fragment(*[[t for t, s in zip(side, starts(side)) if low <= s < high] for side in (a, b)])
            leaves.append(f)
            groups += inner
        order = list(leaves)
        while len(order) > 1:                               # any order of neighbours
            i = rng.randrange(len(order) - 1)
            f, inner = align.combine(order[i], order[i + 1])
            order[i:i + 2], groups = [f], groups + inner
        assert align.combine(align.Fragment(), order[0]) == (order[0], []) == align.combine(order[0], align.Fragment())
        groups += align.cut(order[0].head_a, order[0].head_b)[0]
        assert sorted(groups) == align.cut(a, b)[0]


def test_groups_and_pair_counts_are_offered(spark):
    df = spark.createDataFrame([(1, "the quick brown fox"), (2, "the end " * 400)], "doc_id long, text string")
    out = align.align(df, A, B, public_tokenizers.PATTERN, chunk_bytes=500, keep_groups=True)
    said = defaultdict(list)
    for r in out.groups.orderBy("doc_id", "at").collect():
        said[r.doc_id].append(r.groups)
    digests = {r.doc_id: (r.groups_sha256, r.n_links) for r in out.documents.collect()}
    assert {i: hashlib.sha256(";".join(x).encode()).hexdigest() for i, x in said.items()} == {i: d[0] for i, d in digests.items()}
    assert sum(r.links for r in out.pair_counts.collect()) == sum(d[1] for d in digests.values())


def test_other_tokenizers_are_refused():
    with open(A) as a, open(B, "rb") as b, pytest.raises(ValueError):
        align.Aligner(a.read(), b.read().replace(b"identity", b"nmt_nfkc"), public_tokenizers.PATTERN)
