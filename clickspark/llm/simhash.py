"""SimHash near-duplicate detection by segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of 2 bits; the vector of segment
popcounts (each 0, 1 or 2) is its embedding. Popcounts of two segments never
differ by more than their bits do, so the Manhattan distance of the embeddings
is a lower bound of the Hamming distance.

Pairs within Manhattan distance 2 come from a grid range-join: the embedding is
split into two halves of 16 dimensions; of two vectors within distance 2, at
least one half is within distance 1. So each fingerprint joins, for both
halves, its own grid cell and the cells one step up (the lower cell of a pair
asks). The full Manhattan bound filters the candidates, then the exact bit
distance verifies them.

Popcounts are held in unary (0 = 00, 1 = 01, 2 = 11), so one 64-bit word holds
the embedding and the Manhattan distance is the bit count of an XOR.

Dense cells (a large group of near copies) would give pairs quadratic in the
group. Between two fingerprints of dense cells the links come from an exact
linear construction instead: both emit themselves and their 64 one-bit
neighbours, and fingerprints that meet in one value (at most 65) are linked to
the smallest of them. Two fingerprints are within 2 bits if and only if they
meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.components import _stored, connected_components
from clickspark.llm.tasks import map_arrow
from clickspark.llm.text import word_blocks

SEED = 42
SEGMENTS = 16            # per half
DENSE_CELL = 128


def _bit_counts(hashes: list[int]) -> np.ndarray:
    h = np.array(hashes, dtype="<u8")
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def simhash(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of the text's word shingles, repeats included.

    Words are taken block by block, so memory does not grow with the text."""
    digest, total, counts, held = xxhash.xxh64_intdigest, 0, np.zeros(64, np.int64), []
    for block in word_blocks((text or "").encode().lower()):        # bytes.lower(): A-Z only
        w = held + block
        if n := max(0, len(w) - shingle + 1):
            counts += _bit_counts([digest(b" ".join(w[i:i + shingle]), SEED) for i in range(n)])
            total += n
        held = w[n:]
    if not total:
        if not held:
            return 0
        counts, total = _bit_counts([digest(b" ".join(held), SEED)]), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, key, fp): the signed fingerprint of every row, null text included (0);
    ``key`` is a hash of the text that, with the id, names the row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([simhash(t.as_py(), shingle) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), fps], names=["id", "key", "fp"])

    return map_arrow(src, run, f"id {src.schema['id'].dataType.simpleString()}, key long, fp long")


def _unary(fp: Column) -> Column:
    """Popcounts of the 2-bit segments, in unary, in place of the segments."""
    low = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(fp, 1)
    either, both = fp.bitwiseOR(high).bitwiseAND(low), fp.bitwiseAND(high).bitwiseAND(low)
    return either.bitwiseOR(F.shiftleft(both, 1))


def _cells(nodes: DataFrame) -> DataFrame:
    """Two rows per fingerprint, one per half: (cell, fp, u). The half's number
    is bit 32 of the cell."""
    u = nodes.select("fp", _unary(F.col("fp")).alias("u"))
    halves = F.array(F.col("u").bitwiseAND(F.lit(0xFFFFFFFF)),
                     F.shiftrightunsigned("u", 32).bitwiseOR(F.lit(1 << 32)))
    return u.select(F.explode(halves).alias("cell"), "fp", "u")


def _probes(cells: DataFrame) -> DataFrame:
    """Each row once for its own cell and once for every cell one step up."""
    ups = []
    for s in range(SEGMENTS):
        seg = F.shiftright("cell", 2 * s).bitwiseAND(F.lit(3))
        ups.append(F.when(seg == 0, F.col("cell").bitwiseOR(F.lit(1 << (2 * s))))
                   .when(seg == 1, F.col("cell").bitwiseOR(F.lit(2 << (2 * s)))))
    asked = F.filter(F.array(F.col("cell"), *ups), lambda c: c.isNotNull())
    return cells.select(F.explode(asked).alias("at"), F.col("cell").alias("from_cell"),
                        F.col("fp").alias("a"), F.col("u").alias("ua"))


def _near(probes: DataFrame, cells: DataFrame, max_bits: int) -> DataFrame:
    """Verified links between probes and the fingerprints of the cells asked for."""
    manhattan = F.bit_count(F.col("ua").bitwiseXOR(F.col("u")))
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("fp")))
    return probes.join(cells, (F.col("at") == F.col("cell")) & (manhattan <= max_bits) & (bits <= max_bits)
                       & ((F.col("from_cell") != F.col("cell")) | (F.col("a") < F.col("fp")))).select("a", F.col("fp").alias("b"))


def _stars(fps: DataFrame) -> DataFrame:
    """Links of fingerprints within 2 bits, through the value they meet in."""
    balls = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) * (i == 63))) for i in range(64)])
    met = (fps.select("fp", F.explode(balls).alias("value")).groupBy("value")
           .agg(F.collect_set("fp").alias("met")).where(F.size("met") > 1))      # at most 65 each
    return met.select(F.array_min("met").alias("a"), F.explode("met").alias("b")).where("a != b").distinct()


def fingerprint_links(nodes: DataFrame, max_bits: int = 2, dense_cell: int = DENSE_CELL) -> DataFrame:
    """Links (a, b) whose components equal those of all pairs within ``max_bits``
    (at most 2) differing bits. ``nodes``: distinct fingerprints, column fp."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the two-half grid covers 0 to 2 differing bits")
    cells = _stored(_cells(nodes), "simhash-cells")
    dense = cells.groupBy("cell").count().where(F.col("count") > dense_cell).select("cell")
    if not dense.head(1):
        return _near(_probes(cells), cells, max_bits)
    dense = _stored(dense, "simhash-dense")
    many, few = cells.join(dense, "cell", "left_semi"), cells.join(dense, "cell", "left_anti")
    stars = _stars(many.select("fp").distinct())
    if max_bits < 2:
        stars = stars.where("bit_count(a ^ b) <= 0") if max_bits == 0 else _one_bit(many.select("fp").distinct())
    return (_near(_probes(cells), few, max_bits).unionByName(_near(_probes(few), many, max_bits))
            .unionByName(stars))


def _one_bit(fps: DataFrame) -> DataFrame:
    flips = F.array(*[F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) * (i == 63))) for i in range(64)])
    return (fps.select(F.col("fp").alias("a"), F.explode(flips).alias("b"))
            .join(fps.withColumnRenamed("fp", "b"), "b", "left_semi").where("a < b").select("a", "b"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 2, dense_cell: int = DENSE_CELL) -> DataFrame:
    """One row per input row: (id, fingerprint, component_id, text_hash, stands).

    ``fingerprint``: 16 lowercase hex digits; zero for a text without words
    (null included). ``component_id``: the smallest id among the rows reachable
    over fingerprints within ``max_bits`` bits, itself included; rows with a
    null id take part, and get a null component only if no reachable row has an
    id. ``stands``: the row is its component's first by (id, text_hash), nulls
    last; exactly the rows identical to that one are marked. Repeated rows each
    get a row. Other columns are ignored.

    Copies meet in one fingerprint, so links grow with the distinct
    fingerprints, never with the pairs inside a group of copies.
    """
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    rows = _stored(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    nodes = _stored(rows.groupBy("fp").agg(F.min(first).alias("least")), "simhash-nodes")
    labels = connected_components(fingerprint_links(nodes.select("fp"), max_bits, dense_cell))
    linked = _stored(labels.join(nodes, F.col("node") == F.col("fp")).select("fp", "component", "least"), "simhash-linked")
    heads = _stored(linked.groupBy(F.col("component").alias("head")).agg(F.min("least").alias("of_all")), "simhash-heads")
    moved = linked.join(heads, F.col("component") == F.col("head")).select(F.col("fp").alias("of"), "of_all")
    per_fp = _stored(nodes.join(moved, F.col("fp") == F.col("of"), "left")
                     .select(F.col("fp").alias("node"), F.coalesce("of_all", "least").alias("head")), "simhash-components")
    return (rows.join(per_fp, F.col("fp") == F.col("node"), "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.id").alias("component_id"), F.col("key").alias("text_hash"),
        (F.col("head.id").eqNullSafe(F.col("id")) & (F.col("head.key") == F.col("key"))).alias("stands")))
