import random

import pytest
from clickspark.llm import langid
from llm_data import docs  # noqa: F401


@pytest.fixture(scope="module")
def large_alphabet(docs):
    """A language of about 400,000 trigrams, each seen twice, and a small one."""
    rng = random.Random(7)
    text = "".join(map(chr, rng.choices(range(0x4E00, 0x9FA5), k=400_000)))
    return docs([(1, text, "zh", "a"), (2, text, "zh", "a"), (3, "the quick brown fox and the lazy dog " * 20, "en", "a")], extra=False)


def test_table_grows_with_the_trigrams(large_alphabet):
    model = langid.fit(large_alphabet)
    assert model.bits == 23 and len(model.table) == 1 << 23
    assert model.false_rate.max() <= langid.FALSE_RATE
    lang, score = model.predict("the lazy dog")
    assert lang == "en" and score > 0.95
    shares = [model.predict(t)[1] for t in ("zzq wvk xxj", "kkw qqz vvx", "Ωψξ φφχ ζζη")]
    assert max(shares) < 0.2


def test_a_table_too_small_is_an_error(large_alphabet):
    with pytest.raises(ValueError, match="zh: 0.3"):
        langid.fit(large_alphabet, max_bytes=8 << 20)
    with pytest.raises(ValueError, match="zh"):
        langid.fit(large_alphabet, bits=18)


def test_bits():
    assert langid.table_bits(0, 1) == langid.table_bits(2300, 4) == langid.BITS
    assert langid.table_bits(1_300_000, 4) == langid.table_bits(10**9, 4) == 24
    assert langid.table_bits(10**9, 63) == 23 and langid.table_bits(10**6, 1000) == langid.BITS
