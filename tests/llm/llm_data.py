"""Paths and fixtures of these tests; test modules import the fixtures they use."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                     StructField("source", StringType()), StructField("n_chars", LongType())])

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LINE = "the quick brown fox jumps over the lazy dog"
LONG = " ".join(f"w{i % 977} é{i % 31}," for i in range(40_000)) + "\n" + "x" * 70_000


@pytest.fixture(scope="module")
def docs(spark):
    """(rows) -> documents with clashing extra columns."""
    def make(rows, extra=True):
        full = [(i, t, lang, src, len(t or "")) for i, t, lang, src in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            for c in ("id", "key", "fp", "component_id", "fingerprint", "kept", "score", "lang_pred", "n_words", "start",
                      "offset", "digest", "license", "terms", "rank", "n_tokens", "host"):
                df = df.selectExpr("*", f"'x' as `{c}`")
        return df
    return make


@pytest.fixture(scope="module")
def odd(docs):
    """Nulls in any column, empty, blank, very long, tied and repeated rows."""
    return docs([(1, None, "en", "a"), (2, "", None, "a"), (3, " \t\n\x0b ", "en", None), (4, LINE, "en", "a"),
                 (5, LINE, None, "b"), (5, LINE, None, "b"), (None, LINE, "en", "a"), (6, LONG, "fr", "a"),
                 (7, "ÀÉ ß #1 <b> 日本語 '\u00a0'\u2028\x1cend", "de", None), (7, "another text", "de", "b"), (-8, "...", "en", "b")])


@pytest.fixture(scope="module")
def none(docs):
    return docs([])
