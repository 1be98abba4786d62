"""Quality rules: in-document repetition measures and cross-document line frequency.

``base_measures`` works inside one row with array functions only. The method's
rule counts, per host, the distinct documents that hold a normalised line;
lines above the limits are removed, and a document left with too little of its
text is rejected. Exact copies of a text count as one document of their host:
a text is not boilerplate because it was crawled twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.text import SPACES, let, lower_ascii, words
from clickspark.session import scratch_path

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: A line is removed if more than MIN_DOCS distinct documents of its host hold it
#: and their number squared exceeds GROWTH times the host's distinct documents: from
#: 4 of 10 or 50, 11 of 500, 45 of 10,000, 448 of a million.
MIN_DOCS, GROWTH = 3, 0.2
#: A document is depleted if fewer of its words are left than this share.
MIN_LEFT = 0.4

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(positions: Column) -> Column:
    """Words in the union of the 3-word windows at these sorted positions."""
    return F.aggregate(F.transform(positions, lambda p, i: F.least(F.lit(3), F.coalesce(
        F.get(positions, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)


def _repeated(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more (first one included)."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    positions = let(ordered, lambda s: F.sort_array(F.filter(
        F.transform(s, lambda x, i: F.when(
            F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"]), x["p"])),
        lambda p: p.isNotNull())))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        let(positions, _covered))


def _windows(w: Column) -> Column:
    """64-bit hashes of the 3-word windows (a chance collision inside one text
    of n words has a probability below n^2 / 2^65)."""
    return F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
                       lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))


def base_measures(text: Column) -> Column:
    """Struct of the base measures of one text (all long; zeros for null)."""
    t = F.coalesce(text, F.lit(""))
    n = lambda c: c.cast("long")
    per_words = let(words(t), lambda w: F.struct(F.size(w).alias("n"), let(_windows(w), _repeated).alias("r")))
    lines = let(F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
                lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return let(per_words, lambda p: F.struct(
        n(p["n"]).alias("n_words"),
        n(F.length(F.translate(t, SPACES, ""))).alias("word_chars"),
        n(F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).alias("n_symbols"),
        n(lines).alias("n_dup_lines"), n(p["r"]).alias("n_repeat_words")))


def text_hash(text: Column) -> Column:
    """64-bit hash that, with the id, names a row when ids repeat."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def normalized(text: Column) -> Column:
    """Normalised text, lines kept: A-Z lowered, white space to single spaces."""
    t = F.translate(lower_ascii(F.coalesce(text, F.lit(""))), "\t\x0b\x0c\r", "    ")
    return F.regexp_replace(F.regexp_replace(t, " +", " "), " ?\n ?", "\n")


def line_words(norm: Column) -> Column:
    """(line hash, words) of the distinct lines with a word; a line that occurs
    k times in the text has its words counted k times by ``n_words`` but is
    listed once here with the words of one occurrence."""
    lines = F.array_distinct(F.filter(F.transform(F.split(norm, "\n"), lambda x: F.btrim(x)), lambda x: x != ""))
    return F.transform(lines, lambda x: F.struct(
        F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1).alias("w")))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_docs: int = MIN_DOCS, growth: float = GROWTH, min_left: float = MIN_LEFT,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """One row per input row: id, host_col, text_hash, the base measures,
    line_total, line_removed (words in distinct lines, in lines above the
    limits), base_failed, kept.

    One threshold for hosts of every size: it grows with the root of the host's
    documents. A share of them would let a section's menu pass on a large host, and a
    fixed count would take ordinary short lines there.

    Null or empty text: all measures 0, base_failed. A null host is a host of
    its own. Repeated rows each get a row; they count as one document. Other
    columns, whatever their names, are ignored. Ties have no influence: counts
    are exact.

    The measures and line hashes (no text) are written once to the shared
    folder; every later step reads those few columns.
    """
    norm = normalized(F.col(text_col))
    per_row = docs.select(
        F.col(id_col).alias("id"), F.col(host_col).alias("host"), text_hash(F.col(text_col)).alias("text_hash"),
        base_measures(F.col(text_col)).alias("m"),
        let(norm, lambda t: F.struct(F.xxhash64(t).alias("key"), line_words(t).alias("lines"))).alias("n"))
    path = scratch_path(docs.sparkSession, "quality")
    per_row.write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)

    texts = (rows.groupBy("host", F.col("n.key").alias("key")).agg(F.first("n.lines").alias("lines")))
    lines = texts.select("host", "key", F.explode("lines").alias("l")).select("host", "key", "l.h", "l.w")
    counts = lines.groupBy("host", "h").agg(F.count("*").alias("n_docs")).where(
        F.col("n_docs") > min_docs)
    hosts = texts.groupBy(F.col("host").alias("of_host")).agg(F.count("*").alias("host_docs"))
    above = F.col("n_docs") * F.col("n_docs") > growth * F.col("host_docs")
    over = (counts.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).where(above)
            .select(F.col("host").alias("over_host"), F.col("h").alias("over_h")))
    removed = (lines.join(over, (F.col("h") == F.col("over_h")) & F.col("host").eqNullSafe(F.col("over_host")), "left_semi")
               .groupBy("host", "key").agg(F.sum("w").alias("removed"))
               .select(F.col("host").alias("r_host"), F.col("key").alias("r_key"), "removed"))
    joined = rows.join(removed, (F.col("n.key") == F.col("r_key")) & F.col("host").eqNullSafe(F.col("r_host")), "left")
    total = F.aggregate(F.col("n.lines"), F.lit(0).cast("long"), lambda a, x: a + x["w"])
    gone = F.coalesce("removed", F.lit(0).cast("long"))
    failed = (F.col("m.n_words") < min_words) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))
    return joined.select(
        F.col("id").alias(id_col), F.col("host").alias(host_col), "text_hash",
        *[F.col(f"m.{c}").alias(c) for c in BASE],
        total.alias("line_total"), gone.alias("line_removed"), failed.alias("base_failed"),
        (~failed & (total - gone >= min_left * total)).alias("kept"))
