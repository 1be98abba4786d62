"""Row identity and keyed reassembly.

``monotonically_increasing_id`` encodes the partition number, so two files
with different partitioning get different ids for the same row, and joining
them on it misaligns rows. Identity here comes from the natural key:

* ``stable_row_id``: dense ids 0..n-1 in key order, computed with the
  distributed rank (no single-task window), identical for any partitioning.
* ``reassemble_by_key``: the n-way full outer join of column groups that share
  a key, done as one union + one grouped aggregate, i.e. ONE shuffle however
  many pieces there are (chained outer joins re-shuffle the growing result at
  every step).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.operators.prefix import global_rank
from clickspark.spec import FeatureSpec


def stable_row_id(df: DataFrame, spec: FeatureSpec, name: str = "row_id",
                  partitions: int | None = None) -> DataFrame:
    """Dense ids in key order. A hash of the whole row breaks ties, so a key
    that (against the contract) repeats for many rows still spreads over
    several ranges instead of landing in one partition, and duplicates get
    reproducible ids."""
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    ranked = global_rank(df.withColumn("_tie", tie), [*[F.col(k).asc() for k in spec.key], F.col("_tie").asc()],
                         name=name, partitions=partitions)
    return ranked.drop("_tie")


def split_by_columns(df: DataFrame, key: Sequence[str], groups: Sequence[Sequence[str]]) -> list[DataFrame]:
    """Vertical pieces (key + a column group each)."""
    return [df.select(*key, *g) for g in groups]


def reassemble_by_key(pieces: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Full outer join of pieces on a shared unique key, as union + group by.

    Every non-key column must come from exactly one piece; a key missing from a
    piece yields nulls in that piece's columns, as a full outer join would. A key
    that occurs twice in one piece is an error: the pieces of two rows cannot be
    told apart, and merging them would make up a row that neither held.
    """
    key = list(key)
    cols: list[str] = []
    for p in pieces:
        cols += [c for c in p.columns if c not in key and c not in cols]
    tagged = [p.withColumn("_piece", F.lit(i)) for i, p in enumerate(pieces)]
    unioned = tagged[0]
    for p in tagged[1:]:
        unioned = unioned.unionByName(p, allowMissingColumns=True)
    # each (key, column) has at most one non-null value, so max() picks it deterministically
    counted = [F.count_if(F.col("_piece") == i).alias(f"_rows{i}") for i in range(len(pieces))]
    merged = unioned.groupBy(*key).agg(*[F.max(c).alias(c) for c in cols], *counted)
    most = F.greatest(*[F.col(f"_rows{i}") for i in range(len(pieces))], F.lit(0).cast("long"))
    return merged.where(F.assert_true(most <= 1, F.lit("reassemble_by_key: a key repeats inside one piece")).isNull()).select(*key, *cols)
