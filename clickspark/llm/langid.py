"""Language identification with bit-sliced Bloom filters of character n-grams.

Learning: every training text gives its character trigrams (lower case, each run
of non-letters one space). A trigram belongs to a language if its share of that
language's trigrams is at least ``KEEP`` of its highest share in any language.
All languages share one table of ``2^bits`` slots, each slot a bitmask with one
bit per language (bit-sliced Bloom filters): a language's trigram sets its bit
in ``HASHES`` slots.

Prediction: the AND of a trigram's slots is the mask of all languages that
contain it. Popcounts per language over the text are corrected for the
filters' false-positive rates; the language with the highest corrected share of
trigrams is returned.

The table is sized from the counted trigrams of the largest language, up to a
bound in bytes; a table too full for its languages is an error, not a guess.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clickspark.llm.tasks import map_arrow
from clickspark.session import scratch_path

UNKNOWN = "und"
BITS = 20                           # slots at least, as a power of 2
HASHES = 3
FALSE_RATE = 0.01                   # that the table is sized for
MAX_FALSE_RATE = 0.05               # above it, no model
MAX_BYTES = 1 << 27                 # of a table with more than 2^BITS slots
KEEP = 0.35
MIN_COUNT = 2
WORD_BITS = 62                      # languages per mask word
PENDING = 1 << 20                   # characters counted at once
CHUNK = 1 << 19

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, a space around it and in place of
    each run of non-letters; empty without letters."""
    low = text.lower()
    cp = np.frombuffer(low.encode("utf-32-le"), "<u4")
    distinct, at = np.unique(cp, return_inverse=True) if len(cp) < 64 or cp.max() >= 0x500 else (None, None)
    if distinct is None:
        letter = _TABLE[cp]
    else:
        letter = np.array([chr(c).isalpha() for c in distinct.tolist()], bool)[at] if len(cp) else np.zeros(0, bool)
    if not letter.any():
        return np.zeros(0, np.uint64)
    out = np.zeros(len(cp) + 2, np.uint64)
    out[:] = 32
    out[1:-1][letter] = cp[letter]
    space = out == 32
    keep = np.ones(len(out), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return out[keep]


_TABLE = np.array([chr(c).isalpha() for c in range(0x500)], bool)


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Trigram keys (21 bits per character: exact), in bounded chunks; a chunk
    border counts as a space."""
    text = text or ""
    for at in range(0, len(text), CHUNK):
        c = _letters(text[at:at + CHUNK])
        if len(c) >= 3:
            yield (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]


def slots(keys: np.ndarray, bits: int, hashes: int = HASHES) -> list[np.ndarray]:
    """Slot numbers of the keys, one array per hash function."""
    out = []
    for i in range(hashes):
        x = keys * _MIX[i]
        x ^= x >> np.uint64(29)
        x *= _MIX[(i + 1) % 4]
        out.append((x >> np.uint64(64 - bits)).astype(np.int64))
    return out


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text is divisible by 5; false for null."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text): counted in each task in
    bounded steps, then summed by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)],
                                              names=["lang", "gram", "n"])
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for keys in trigrams(t.as_py()):
                    held.setdefault(lang, []).append(keys)
                    size[lang] = size.get(lang, 0) + len(keys)
                    if size[lang] >= PENDING:
                        yield flush(lang, held.pop(lang))
                        size[lang] = 0
                if sum(size.values()) >= 8 * PENDING:
                    for k in list(held):
                        yield flush(k, held.pop(k))
                    size.clear()
        for k in list(held):
            yield flush(k, held.pop(k))

    counted = map_arrow(labelled.select("lang", "text"), run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """languages, the slot table (2^bits x mask words) and, per language, the
    false-positive rate of its filter; a ValueError above ``MAX_FALSE_RATE``."""

    def __init__(self, languages: list[str], table: np.ndarray, bits: int, hashes: int):
        self.languages, self.table, self.bits, self.hashes = languages, table, bits, hashes
        fill = np.array([sum(np.count_nonzero(self._bit(table[at:at + CHUNK, i // WORD_BITS], i))
                             for at in range(0, len(table), CHUNK)) / len(table) for i in range(len(languages))])
        self.false_rate = fill ** hashes
        full = [f"{x}: {r:.3f}" for x, r in zip(languages, self.false_rate, strict=True) if r > MAX_FALSE_RATE]
        if full:
            raise ValueError(f"2^{bits} slots are too few, false-positive rates above {MAX_FALSE_RATE}: {', '.join(full)}; raise max_bytes")

    @staticmethod
    def _bit(words: np.ndarray, i: int) -> np.ndarray:
        return (words >> np.int64(i % WORD_BITS)) & np.int64(1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the corrected share of the text's trigrams that the
        language contains. Ties go to the first language in sorted order."""
        n, hits = 0, np.zeros(len(self.languages))
        for keys in trigrams(text):
            n += len(keys)
            first, *others = slots(keys, self.bits, self.hashes)
            masks = self.table[first]
            for s in others:
                masks &= self.table[s]
            hits += [np.count_nonzero(self._bit(masks[:, i // WORD_BITS], i)) for i in range(len(hits))]
        if not n or not len(hits):
            return UNKNOWN, 0.0
        share = np.clip((hits / n - self.false_rate) / (1 - self.false_rate), 0, 1)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def table_bits(n_grams: int, n_languages: int, hashes: int = HASHES, max_bytes: int = MAX_BYTES) -> int:
    """Bits of a table in which a language of ``n_grams`` trigrams has a
    false-positive rate of at most ``FALSE_RATE``; ``BITS`` at least, and no more
    than ``max_bytes`` allow."""
    slots_needed = -hashes * n_grams / np.log1p(-FALSE_RATE ** (1 / hashes))
    most = (max_bytes // (8 * -(-n_languages // WORD_BITS))).bit_length() - 1
    return max(BITS, min(int(np.ceil(np.log2(max(slots_needed, 1)))), most))


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int | None = None, hashes: int = HASHES,
        keep: float = KEEP, min_count: int = MIN_COUNT, max_bytes: int = MAX_BYTES) -> Model:
    """Learn from every row with a non-null language and a text.

    Without ``bits`` the table is sized from the trigrams counted (``table_bits``).
    The driver receives the list of languages and the non-empty slots of the
    table, at most 2^bits rows of two integers per mask word: a bound set by
    ``bits`` or ``max_bytes``, not by the data. If a language does not fit into
    that bound, a ValueError names it. Without usable rows the model knows no
    language.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "langid")
    (gram_counts(docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
                 .where("lang is not null and text is not null")).write.parquet(path))
    counts = spark.read.schema("lang string, gram long, n long").parquet(path)
    by_lang = (counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count_if(F.col("n") >= min_count).alias("grams"))
               .collect())
    totals = sorted((r.lang, r.total) for r in by_lang)
    languages = [x for x, _ in totals]
    if not languages:
        bits = bits or BITS
        return Model([], np.zeros((1 << bits, 1), np.int64), bits, hashes)
    bits = bits or table_bits(max(r.grams for r in by_lang), len(languages), hashes, max_bytes)
    number = F.create_map(*[F.lit(x) for i, (lang, total) in enumerate(totals) for x in (lang, i)])
    total_of = F.create_map(*[F.lit(x) for lang, total in totals for x in (lang, float(total))])
    rate = counts.where(F.col("n") >= min_count).select(
        "gram", F.element_at(number, F.col("lang")).alias("i"), (F.col("n") / F.element_at(total_of, F.col("lang"))).alias("rate"))
    # one row per trigram; its list holds one entry per language
    member = (rate.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("i", "rate")).alias("by"))
              .select("gram", F.explode("by").alias("x"), "top").where(F.col("x.rate") >= keep * F.col("top"))
              .select("gram", F.col("x.i").alias("i")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            i = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate(slots(keys, bits, hashes))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(i // WORD_BITS, hashes)),
                                              pa.array(np.tile(np.int64(1) << (i % WORD_BITS), hashes))], names=["slot", "word", "mask"])

    table = np.zeros((1 << bits, -(-len(languages) // WORD_BITS)), np.int64)
    set_slots = (map_arrow(member, run, "slot long, word long, mask long")
                 .groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow())
    table[set_slots["slot"].to_numpy(), set_slots["word"].to_numpy()] = set_slots["mask"].to_numpy()
    return Model(languages, table, bits, hashes)


def annotate(docs: DataFrame, model: Model, text_col: str = "text", prediction: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """All columns of the input plus ``prediction`` and ``score`` in [0, 1],
    which replace columns of these names.

    Only the text is an input. Null text or text without a letter: 'und', 0.
    Repeated rows each get a row. The whole text is read, in bounded chunks. A
    narrow map: no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.drop(*({prediction, score} - {text_col}))
    at = src.columns.index(text_col)
    names = [*src.columns, prediction, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [m.predict(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x for x, _ in got], pa.string()),
                                              pa.array([s for _, s in got], pa.float64())], names=names)

    schema = StructType([*src.schema.fields, StructField(prediction, StringType()), StructField(score, DoubleType())])
    return map_arrow(src, run, schema)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score; see ``annotate``. Columns
    other than the text are not inputs."""
    return annotate(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model).select(
        F.col("id").alias(id_col), "lang_pred", "score")
