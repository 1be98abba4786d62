"""Deterministic sampling, splits and folds keyed on the natural row key.

``randomSplit`` and ``sample`` draw per row from a per-partition generator, so
the same seed gives different rows when the input is partitioned differently
(or re-read after a lost executor with another split). Here every decision is a
pure function of md5(key || salt): the same row lands in the same sample, split
and fold on every run, partitioning and cluster size, and the SQL twin is one
expression. Nothing is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.functions import hash_unit, hex_bucket, key_string
from clickspark.spec import FeatureSpec


def hash_sample(df: DataFrame, spec: FeatureSpec, fraction: float, seed: int = 0) -> DataFrame:
    """Bernoulli-like sample without replacement, reproducible from the key."""
    return df.where(hash_unit(spec.key, f"-sample-{seed}") < F.lit(float(fraction)))


def sample_by_label(df: DataFrame, spec: FeatureSpec, fractions: dict[int, float], seed: int = 0) -> DataFrame:
    """Stratified sample: a fraction per label value (``sampleBy``, but reproducible)."""
    u = hash_unit(spec.key, f"-sample-{seed}")
    cond = F.lit(False)
    for lab, frac in fractions.items():
        cond = cond | ((F.col(spec.label) == F.lit(lab)) & (u < F.lit(float(frac))))
    return df.where(cond)


#: Hex digits of a histogram round, and rows that one task may order at the end.
HEX_DIGITS, MAX_ORDERED = 3, 100_000


def sample_exact_by_label(df: DataFrame, spec: FeatureSpec, sizes: dict[int, int | float], seed: int = 0) -> DataFrame:
    """Exactly ``sizes[label]`` rows per label (a float is a share of the label's
    rows, rounded up; all rows where there are fewer): those whose hashed key sorts
    first, ties by key. Labels that are not named have none.

    Histograms of the hash narrow each label's boundary, ``16 ** HEX_DIGITS`` bins a
    round, until its bin holds few rows; only those are ordered. Nothing else is
    sorted or shuffled; the driver sees the bins' counts."""
    y, digest = F.col(spec.label), F.md5(F.concat(key_string(spec.key), F.lit(f"-exact-{seed}")))
    rows = df.withColumn("_h", digest)
    counts = {r["y"]: r["n"] for r in df.where(y.isin(list(sizes))).groupBy(y.alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    taken, edge = F.lit(False), F.lit(False)
    left = {}
    for label, size in sizes.items():
        want = math.ceil(round(size * counts.get(label, 0), 6)) if isinstance(size, float) else size
        prefix, inside = "", counts.get(label, 0)
        while 0 < want < inside and inside > MAX_ORDERED and len(prefix) < 32:
            digits = len(prefix) + HEX_DIGITS
            bins = (rows.where((y == label) & F.startswith("_h", F.lit(prefix))).groupBy(F.substring("_h", 1, digits).alias("b"))
                    .agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect())
            for r in bins:
                if r["n"] >= want:
                    break
                want -= r["n"]
            taken = taken | ((y == label) & F.startswith("_h", F.lit(prefix)) & (F.substring("_h", 1, digits) < r["b"]))
            prefix, inside = r["b"], r["n"]
        here = (y == label) & F.startswith("_h", F.lit(prefix))
        if want >= inside:
            taken = taken | here
        elif want > 0:
            edge, left[label] = edge | here, want
    out = rows.where(taken).drop("_h")
    if left:
        place = F.row_number().over(Window.partitionBy(spec.label).orderBy("_h", *spec.key))
        limit = F.coalesce(*[F.when(y == label, n) for label, n in left.items()])
        out = out.unionByName(rows.where(edge).withColumn("_place", place).where(F.col("_place") <= limit).drop("_h", "_place"))
    return out


def split_expr(spec: FeatureSpec, train_fraction: float = 0.7, seed: int = 2019):
    """'train' when the first 4 hex digits of md5(key-seed) fall below the fraction."""
    cut = int(round(train_fraction * 65536))
    return F.when(hex_bucket(spec.key, f"-{seed}", 4) < F.lit(cut), F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, spec: FeatureSpec, train_fraction: float = 0.7, seed: int = 2019,
               col: str = "split") -> DataFrame:
    """Add a 'train'/'test' column; parts are disjoint and complete by construction."""
    return df.withColumn(col, split_expr(spec, train_fraction, seed))


def train_test(df: DataFrame, spec: FeatureSpec, train_fraction: float = 0.7, seed: int = 2019):
    s = split_expr(spec, train_fraction, seed)
    return df.where(s == "train"), df.where(s == "test")


def split_counts(df: DataFrame, spec: FeatureSpec, train_fraction: float = 0.7, seed: int = 2019) -> DataFrame:
    """(split, n, n_pos, ctr): sizes of both parts in ONE aggregate (two counts
    would be two full passes)."""
    y = F.col(spec.label)
    return (hash_split(df, spec, train_fraction, seed).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_pos"),
                 F.avg((y == 1).cast("double")).alias("ctr")))


def kfold_assign(df: DataFrame, spec: FeatureSpec, k: int = 3, seed: int = 2019, col: str = "fold") -> DataFrame:
    """Fold number in [0, k) from the key; usable as ``CrossValidator(foldCol=...)``."""
    return df.withColumn(col, F.pmod(hex_bucket(spec.key, f"-fold-{seed}", 8), F.lit(k)).cast("int"))


def limit_extract(df: DataFrame, spec: FeatureSpec, n: int, bins: int = 4096, slack: int = 4,
                  max_rounds: int = 8) -> DataFrame:
    """First ``n`` rows in key order (nulls first, as ``orderBy``), exact.

    A plain ``orderBy(key).limit(n)`` keeps n rows per input partition and
    merges partitions x n rows in one task. When the leading key is numeric the
    candidates are narrowed first: an equal-width histogram of the key (one
    aggregate, ``bins`` rows to the driver) finds the bin where the running count
    reaches n; while that bin is crowded, the same is repeated inside it. Whole
    bins are kept, so every row of rank <= n is a candidate; the final ordered
    limit then merges about ``slack`` x n rows. Each round reads only the key
    column, and later rounds filter on a key range the Parquet scan can prune.
    """
    lead = spec.key[0]
    if not isinstance(df.schema[lead].dataType, T.NumericType):
        return df.orderBy(*spec.key).limit(n)
    k = F.col(lead).cast("double")
    head = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(k.isNull()).alias("z"),
                  F.min(k).alias("lo"), F.max(k).alias("hi")).first()
    if head["n"] <= slack * n or head["lo"] is None:
        return df.orderBy(*spec.key).limit(n)
    accepted = k.isNull()               # nulls sort first: always candidates
    below = head["z"]
    window = k.isNotNull()
    lo, hi = head["lo"], head["hi"]
    for _ in range(max_rounds):
        if below >= n:
            break
        if hi == lo:                     # one value left: the whole window is the boundary
            accepted = accepted | window
            break
        b = F.least(F.lit(bins - 1), F.floor((k - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))))
        hist = sorted(df.where(window).groupBy(b.alias("b"))
                      .agg(F.count(F.lit(1)).alias("c"), F.min(k).alias("lo"), F.max(k).alias("hi")).collect())
        cum, star = below, None
        for r in hist:
            if cum + r["c"] >= n:
                star = r
                break
            cum += r["c"]
        if star is None:                 # fewer than n rows in total
            accepted = accepted | window
            break
        accepted = accepted | (window & (b < F.lit(star["b"])))
        window = window & (b == F.lit(star["b"])) & k.between(star["lo"], star["hi"])
        below, lo, hi = cum, star["lo"], star["hi"]
        if below + star["c"] <= slack * n:
            accepted = accepted | window
            break
    else:
        accepted = accepted | window     # rounds exhausted: keep the crowded bin whole
    return df.where(accepted).orderBy(*spec.key).limit(n)
