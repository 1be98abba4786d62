from clickspark.llm import licenses
from llm_data import docs  # noqa: F401

TEXTS = {i: max((t for j, t in licenses.known_texts() if i == j), key=len)
         for i in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "BSD-2-Clause", "CC0-1.0", "Unlicense", "ISC", "MIT")}


def scan(spark, df):
    return {r.doc_id: (r.license, r.line_licenses) for r in licenses.scan_licenses(df, licenses.known_digests(spark)).collect()}


def rewrapped(text, width):
    w = text.split()
    return "\n".join(" ".join(w[i:i + width]) for i in range(0, len(w), width))


def test_whole_texts_alone_and_inside_documents(spark, docs):
    names = sorted(TEXTS)
    rows = [(i, TEXTS[n], None, "a") for i, n in enumerate(names)]
    rows += [(100 + i, f"A readme.\n\n{TEXTS[n]}\n\nMore prose here.", None, "a") for i, n in enumerate(names)]
    got = scan(spark, docs(rows))
    for i, n in enumerate(names):
        assert got[i][0] == n
        assert got[100 + i][0] is None and n in got[100 + i][1].split(","), n


def test_rewrapped_respelled_and_repeated_texts(spark, docs):
    isc, bsd = TEXTS["ISC"], TEXTS["BSD-2-Clause"]
    rows = [(1, f"prose\n{rewrapped(isc, 5)}\nprose", None, "a"), (2, f"prose\n{isc} more", None, "a"),
            (3, f"prose {isc}\nprose", None, "a"), (4, f"{isc}\n{rewrapped(isc, 9)}\nprose\n\n{rewrapped(bsd, 7)}\nend", None, "a"),
            (5, "prose\n" + rewrapped(TEXTS["MIT"].replace("sublicense", "sub licence"), 1) + "\nprose", None, "a"),
            (6, isc.replace("fee", "charge") + "\nprose", None, "a")]
    got = {k: v[1] for k, v in scan(spark, docs(rows)).items()}
    assert got == {1: "ISC", 2: "", 3: "", 4: "BSD-2-Clause,ISC", 5: "MIT", 6: ""}


def test_notices_and_identifiers(spark, docs):
    rows = [(1, "prose\nLicensed under the Mozilla Public License 2.0.", None, "a"), (2, "# SPDX-License-Identifier: AGPL-3.0-only\nx = 1", None, "a"),
            (3, "Licensed under CC BY-SA 4.0.", None, "a"), (4, "Released under the BSD 3-Clause License", None, "a")]
    got = scan(spark, docs(rows))
    assert got[1][1] == "MPL-2.0" and got[2][1] == "AGPL-3.0"
    assert got[3] == ("CC-BY-SA-4.0", "CC-BY-SA-4.0") and got[4][0] == "BSD-3-Clause"


def test_a_long_text_of_starts_alone_needs_little_memory(spark, docs):
    """5 MB in which every line begins a known text, and one licence amid them."""
    line = "gnu\ngeneral\npublic\nlicense\n"
    mit = next(t for i, t in licenses.known_texts() if i == "MIT" and t.count("\n") > 5)
    df = docs([(1, line * 200_000, "en", "a"), (2, line * 1000 + mit + "\n" + line * 1000, "en", "a")], extra=False)
    got = {r.doc_id: r.line_licenses for r in licenses.scan_licenses(df, licenses.known_digests(spark)).collect()}
    assert "MIT" in got[2].split(",") and "MIT" not in got[1].split(",")
