from clickspark.llm import licenses
from llm_data import docs, none, odd  # noqa: F401


def scan(spark, df):
    return {(r.doc_id, r.text_digest): r for r in licenses.scan_licenses(df, licenses.known_digests(spark)).collect()}


def test_equivalent_texts_share_a_licence(spark, docs):
    mit = next(t for name, t in licenses.KNOWN_LICENSES if name == "MIT" and len(t) > 500)
    changed = "Copyright (c) 2020 Some Body\n\n" + mit.upper().replace("SUBLICENSE", "sub-licence").replace(",", " ;")
    got = licenses.scan_licenses(docs([(1, mit, None, "a"), (2, changed, None, "a"), (3, mit + " more", None, "a"),
                                       (4, "prose\n  RELEASED under the MIT Licence!!\nLicensed under CC-BY NC 4.0", None, "a"),
                                       (5, "x Released under the MIT License.", None, "a")]),
                                 licenses.known_digests(spark)).collect()
    by = {r.doc_id: (r.license, r.line_licenses) for r in got}
    assert by[1][0] == by[2][0] == "MIT"
    assert by[3] == (None, "") and by[5] == (None, "")
    assert by[4] == (None, "CC-BY-NC-4.0,MIT")


def test_odd_rows(spark, odd, none):
    rows = licenses.scan_licenses(odd, licenses.known_digests(spark)).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].text_digest is None and by[1].n_lines == 0
    assert by[2].text_digest == by[3].text_digest == by[-8].text_digest
    assert licenses.scan_licenses(none, licenses.known_digests(spark)).count() == 0


def test_known_digests_are_unambiguous(spark):
    rows = licenses.known_digests(spark).collect()
    assert len({r.digest for r in rows}) == len(rows) >= 10
