import zlib

import numpy as np

from clickspark.llm import langid
from llm_data import SF_MID, docs, none, odd  # noqa: F401


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = langid.fit(df.where(~langid.held_out(df.doc_id)))
    rows = langid.predict(df, model).join(df.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(test) > 100
    assert np.mean([r.lang_pred == r.lang for r in test]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_needs_only_the_text(spark):
    df = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(100)
    model = langid.fit(df)
    changed = df.selectExpr("doc_id + 5000 as doc_id", "text", "'xx' as lang", "null as source", "n_chars")
    a = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    b = {r.doc_id - 5000: r.lang_pred for r in langid.predict(changed, model).collect()}
    assert a == b


def test_masks_name_every_language_of_a_gram(docs):
    rows = [(i, text, lang, "a") for i, (text, lang) in enumerate([("abc abc", "l1"), ("abc xyz", "l2"), ("qqq", "l3")] * 3)]
    model = langid.fit(docs(rows))
    assert model.languages == ["l1", "l2", "l3"]
    keys = next(langid.trigrams("abc"))
    masks = model.table[langid.slots(keys, model.bits)[0], 0]
    for s in langid.slots(keys, model.bits)[1:]:
        masks = masks & model.table[s, 0]
    assert set(masks.tolist()) == {0b011}


def test_more_languages_than_bits(docs):
    words = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}zq" for i in range(150)]
    df = docs([(i, " ".join([w] * 5), f"l{i:03d}", "a") for i, w in enumerate(words)])
    model = langid.fit(df)
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    assert sum(got[i] == f"l{i:03d}" for i in range(150)) >= 148


def test_trigrams_of_a_text():
    def plain(t):
        cs = [c if c.isalpha() else " " for c in t.lower()]
        s = " " + "".join(cs) + " "
        while "  " in s:
            s = s.replace("  ", " ")
        return [s[i:i + 3] for i in range(len(s) - 2)] if s.strip() else []
    for t in ["Hello, World", "a", "", "1 2", "ÀÉ--ß", "日本語 text", "x" * 200 + "é", "İstanbul ʼn"]:
        got = ["".join(chr((int(k) >> s) & 0x1FFFFF) for s in (42, 21, 0)) for part in langid.trigrams(t) for k in part]
        assert got == plain(t), t


def test_odd_rows(odd, none):
    model = langid.fit(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r.lang_pred for r in rows}
    assert by[1] == by[2] == by[3] == by[-8] == langid.UNKNOWN and by[4] == "en"
    assert langid.predict(none, model).count() == 0
    empty = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {langid.UNKNOWN}
    kept = langid.annotate(odd, model).columns
    assert sorted(kept) == sorted(odd.columns)
