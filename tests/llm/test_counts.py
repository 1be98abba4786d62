import math
import random

import public_tokenizers

from clickspark.llm import counts
from llm_data import SF_SMALL, docs, none, odd  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain(model, word):
    """Best (score, -tokens) by plain dynamic programming over one word."""
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        n = len(word[i - 1].encode())
        options = [(best[i - 1][0] + n * model.byte, best[i - 1][1] - n)]
        options += [(best[j][0] + model.scores[word[j:i]], best[j][1] - 1) for j in range(i) if word[j:i] in model.scores]
        best.append(max(options))
    return best[-1]


def test_trie_equals_one_word_at_a_time():
    model, rng = counts.load_unigram(PATH), random.Random(2)
    words = {"▁" + "".join(rng.choices("etaoin shrdlu".replace(" ", ""), k=rng.randrange(1, 14))) for _ in range(800)}
    words |= {"▁the", "▁thethe", "▁", "▁日本語", "▁😀é", "▁" + "ab" * 300}
    got = model.counts(words)
    for w in words:
        s, k = plain(model, w)
        assert got[w][0] == -k and math.isclose(got[w][1], s)


def test_enumeration_of_all_segmentations():
    model = counts.Unigram(["▁", "▁a", "a", "b", "ab", "aba", "▁ab", "ba"])

    def every(w):
        if not w:
            yield 0.0, 0
        for n in range(1, len(w) + 1):
            if w[:n] in model.scores:
                for s, k in every(w[n:]):
                    yield s + model.scores[w[:n]], k - 1
    for w in ("▁abab", "▁a", "▁bbaba", "▁abaaba"):
        s, k = max((round(s, 9), k) for s, k in every(w))
        got = model.counts([w])[w]
        assert got[0] == -k and math.isclose(got[1], s, abs_tol=1e-8)


def run(df):
    return sorted(map(tuple, counts.count_tokens(df, PATH).collect()), key=repr)


def brute(df):
    model = counts.load_unigram(PATH)
    known = {}
    out = []
    for r in df.collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        for w in set(words) - set(known):
            known[w] = -plain(model, "▁" + w)[1] if len(w) < 2000 else model.counts(["▁" + w])["▁" + w][0]
        out.append((r.doc_id, len(words), sum(known[w] for w in words)))
    return sorted(out, key=repr)


def test_documents_and_odd_rows(spark, odd, none):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert run(df) == brute(df)
    assert run(odd) == brute(odd)
    assert run(none) == []
