"""Licence scan by canonical digest.

Texts are brought to one canonical form (case, punctuation, copyright lines,
equivalent spellings), and the digest of the *entire* canonical text is
hash-joined to the digests of known licences. The same canonicaliser runs over
the documents and over the known texts, so there is one definition of equality.

Three kinds of unit are looked up: the whole document, each of its lines (a
licence notice usually stands on a line of its own), and runs of whole lines
that begin like a known text of several lines and have as many words.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.llm.text import let, lower_ascii

#: More known texts, one JSON object (license_id, text) a line: licence texts,
#: notices and SPDX identifiers. Read by the driver.
LICENSE_FILE = Path(__file__).with_name("known_licenses.jsonl")
#: A run of lines is looked up if it begins with so many words of a known text.
START_WORDS = 4
#: ... and has the same words at so many places; only such runs are put together.
PROBES = 12

# Public licence texts and their standard notices (id, text).
KNOWN_LICENSES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
]

# Equivalent spellings (spelling, canonical spelling), whole words
# of the canonical text, in order.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
    ("sublicence", "sublicense"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("per cent", "percent"),
    ("organisation", "organization"), ("organisations", "organizations"),
    ("authorisation", "authorization"), ("authorised", "authorized"),
    ("favour", "favor"), ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("sub license", "sublicense"), ("whilst", "while"), ("https", "http"),
]

#: A copyright line: only white space and comment marks before the word or sign,
#: which a sign, a year or "by" must follow ("copyright holders" starts none).
COPYRIGHT_LINE = r"(?md)^[ \t#*/;-]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|by )|\(c\)[ \t]*[0-9]{4}|©)[^\n]*$"
#: What is kept: ASCII letters and digits and every character beyond ASCII.
PUNCTUATION = r"[^a-z0-9\x{80}-\x{10FFFF}\n]+"


def canonical(text: Column) -> Column:
    """Canonical form, line structure kept: lower case (A-Z), copyright lines
    blanked, punctuation and white space to single spaces, spellings unified,
    each line trimmed. Null stays null.

    Spellings are looked for only where one occurs (one test per text).
    """
    t = F.regexp_replace(lower_ascii(text), COPYRIGHT_LINE, "")
    t = F.regexp_replace(t, PUNCTUATION, " ")
    t = F.regexp_replace(t, r" ?\n ?", "\n")
    return F.btrim(t, F.lit(" \n"))


def _spelled(flat: Column) -> Column:
    for spelling, same in SPELLINGS:
        flat = F.regexp_replace(flat, rf"\b{spelling}\b", same)
    return flat


def digest(flat: Column) -> Column:
    """SHA-256 of a canonical text whose lines are joined by single spaces; the
    spelling rules run only on texts that hold one of the spellings."""
    any_of = r"\b(" + "|".join(s for s, _ in SPELLINGS) + r")\b"
    return F.sha2(F.when(flat.rlike(any_of), _spelled(flat)).otherwise(flat), 256)


def _flat(canon: Column) -> Column:
    return F.btrim(F.regexp_replace(canon, r"\n+", " "))


def known_texts() -> list[tuple[str, str]]:
    """(id, text): the fixed values above and those of the data file."""
    with LICENSE_FILE.open(encoding="utf-8") as f:
        return KNOWN_LICENSES + [(x["license_id"], x["text"]) for x in map(json.loads, f)]


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """(digest, license_id, n_lines, n_words, start, probes) of the known texts, by
    default ``known_texts()``; one row per digest. ``start``: the first words of
    the canonical text; ``probes``: the words at PROBES places spread over it."""
    df = spark.createDataFrame(known_texts() if known is None else list(known), "license_id string, text string")
    canon = df.select("license_id", canonical(F.col("text")).alias("canon"))
    flat = canon.select("license_id", _spelled(_flat(F.col("canon"))).alias("flat"),
                        F.size(F.filter(F.split("canon", "\n"), lambda x: x != "")).alias("n_lines"))
    words = F.split("flat", " ")
    return (flat.select(digest(F.col("flat")).alias("digest"), "license_id", "n_lines", F.size(words).alias("n_words"),
                        F.substring_index("flat", " ", START_WORDS).alias("start"),
                        F.transform(_places(F.size(words)), lambda at: F.get(words, at)).alias("probes"))
            .groupBy("digest").agg(F.min("license_id").alias("license_id"), F.max("n_lines").alias("n_lines"),
                                   *[F.first(c).alias(c) for c in ("n_words", "start", "probes")]))


def _places(n: Column) -> Column:
    """Places of the probe words in a text of n words; the last word is one."""
    return F.transform(F.sequence(F.lit(1), F.lit(PROBES)), lambda j: (j * n / PROBES).cast("int") - 1)


def _starts_pattern(starts: list[str]) -> str:
    """Matches a canonical text in which a line begins with one of the starts,
    in any of the equivalent spellings and over any line ends."""
    def one(start: str) -> str:
        for spelling, same in SPELLINGS:
            start = re.sub(rf"\b{same}\b", f"(?:{same}|{spelling})", start)
        return start.replace(" ", r"[ \n]+")
    return r"(?:^|\n)(?:" + "|".join(map(one, sorted(starts))) + ")"


def _spelled_lines(canon: Column) -> Column:
    """Spellings unified, line structure kept (a spelling over a line end goes on one line)."""
    for spelling, same in SPELLINGS:
        canon = F.regexp_replace(canon, rf"\b{spelling}\b".replace(" ", r"[ \n]+"), same)
    return canon


def _runs(canon: Column, lengths: dict[str, list[tuple[int, list[str]]]]) -> Column:
    """Digests of the runs of whole lines, joined by single spaces, that begin with
    a start of ``lengths``, have one of its numbers of words, however wrapped, and the
    words of that text at its probe places. A place costs one look, and a run is put
    together, one at a time, only if all its probes agree; what is kept of it is its
    digest. So a text of starts alone needs no more memory than its words."""
    tokens = F.split(F.concat(F.lit("\n"), F.regexp_replace(_spelled_lines(canon), r"\n+", " \n")), " ")
    number_of = F.create_map(*[x for k, v in sorted(lengths.items()) for x in (F.lit(k), F.array(*[
        F.struct(F.lit(n).alias("n"), F.array(*map(F.lit, probes)).alias("probes")) for n, probes in sorted(v)]))])
    none = F.array().cast("array<struct<n:int,probes:array<string>>>")
    flat = lambda t, at, n: F.replace(F.array_join(F.slice(t, at + 1, n), " "), F.lit("\n"), F.lit(""))
    begins = lambda t, at: F.startswith(F.get(t, at), F.lit("\n"))

    def agrees(t: Column, at: Column, known: Column) -> Column:
        ends = (at + known["n"] == F.size(t)) | F.coalesce(begins(t, at + known["n"]), F.lit(False))
        same = F.forall(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda j: F.coalesce(
            F.ltrim(F.get(t, at + ((j + 1) * known["n"] / PROBES).cast("int") - 1), F.lit("\n")) == F.get(known["probes"], j), F.lit(False)))
        return ends & same

    return let(tokens, lambda t: F.flatten(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda at: begins(t, at)),
        lambda at: F.transform(
            F.filter(F.coalesce(F.element_at(number_of, flat(t, at, F.lit(START_WORDS))), none), lambda known: agrees(t, at, known)),
            lambda known: digest(flat(t, at, known["n"]))))))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: (id, text_digest, n_lines, license, line_licenses).

    ``license``: the known licence whose entire canonical text equals the
    document's; null if none. ``line_licenses``: ids of the licences whose
    entire text equals one of the document's lines or, for known texts of
    several lines, a run of its lines, wrapped in any way; sorted, comma-joined,
    '' if none. Null text: null digest, 0 lines, no licence. An empty or
    punctuation-only text has the digest of the empty text. Rows that share an
    id share ``line_licenses``; rows without an id have none. Other columns,
    whatever their names, are ignored.

    ``known`` joins by hash; its side is broadcast only if Spark measures it
    under the broadcast threshold. Lines that hit are aggregated per document
    before the join back, at most one entry per licence. The driver receives the
    starts, lengths and probe words of the known texts, not of the documents; only
    documents with a line that begins with a start are searched for runs. Memory of a
    row: its text, its words and one run.
    """
    lengths: dict[str, list[tuple[int, list[str]]]] = {}
    for r in known.where("n_lines > 1").select("start", "n_words", "probes").distinct().collect():
        lengths.setdefault(r.start, []).append((r.n_words, r.probes))
    known = known.select("digest", "license_id")
    base = docs.select(F.col(id_col).alias("id"), canonical(F.col(text_col)).alias("canon"))
    whole = base.select("id", digest(_flat(F.col("canon"))).alias("digest"),
                        F.coalesce(F.size(F.filter(F.split("canon", "\n"), lambda x: x != "")), F.lit(0))
                        .cast("long").alias("n_lines"))
    lines = F.filter(F.array_distinct(F.split("canon", "\n")), lambda x: x != "")
    units = F.transform(lines, digest)
    if lengths:
        units = F.when(F.col("canon").rlike(_starts_pattern(list(lengths))),
                       F.concat(units, _runs(F.col("canon"), lengths))).otherwise(units)
    lines = base.where("id is not null").select("id", F.explode(F.array_distinct(units)).alias("digest"))
    found = (lines.join(known, "digest")
             .groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("line_licenses")))
    return (whole.join(known, "digest", "left").join(found, "id", "left")
            .select(F.col("id").alias(id_col), F.col("digest").alias("text_digest"), "n_lines",
                    F.col("license_id").alias("license"),
                    F.coalesce("line_licenses", F.lit("")).alias("line_licenses")))
