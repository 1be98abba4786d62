"""Distributed running sums and row numbers over a global order.

``row_number() over (order by ...)`` and ``sum(x) over (order by ... rows
unbounded preceding)`` without ``partition by`` make Spark move every row into a
single task. Exact ROC/PR curves, exact AUC, frequency ranks of categories and
sequential row ids all need exactly that, so they go through this operator:

1. ``repartitionByRange`` on (group, order): Spark samples the keys and cuts the
   data into balanced, ordered ranges; each range is sorted locally.
2. ``mapInPandas`` computes running sums inside each range with numpy (the
   partition's rows are already in order; carries cross Arrow batches). A
   window partitioned by the range id would do the same in the JVM, but Spark
   would first re-shuffle the data by that id; here the rows never leave
   their task.
3. The result is checkpointed into the shared checkpoint folder, which fixes
   the range assignment (a recomputed range shuffle could cut differently) and
   cuts the lineage, so a lost executor re-reads instead of re-sorting.
4. Per (range, group) totals -- at most ``partitions x groups`` rows, a proven
   bound -- are turned into offsets with a window over that small table and
   broadcast back.

Callers use it on aggregated data (one row per distinct score / value / key),
so a hot key is one row, not a third of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.session import checkpoint


def _local_running(group: list[str], sums: list[str]):
    """mapInPandas body: inclusive running count and sums per group within one range."""

    def run(batches):
        carry: dict = {}
        for pdf in batches:
            if pdf.empty:
                continue
            vals = pdf[sums].fillna(0).to_numpy(dtype="float64") if sums else np.zeros((len(pdf), 0))
            if group:
                keys = list(zip(*[pdf[g].tolist() for g in group]))
                codes, uniq = pd.factorize(pd.Series(keys, dtype=object), sort=False)
                base_n = np.zeros(len(uniq))
                base_s = np.zeros((len(uniq), len(sums)))
                for j, k in enumerate(uniq):
                    if k in carry:
                        base_n[j], base_s[j] = carry[k]
                cnt = pd.Series(np.ones(len(pdf))).groupby(codes).cumsum().to_numpy()
                run_s = (pd.DataFrame(vals).groupby(codes).cumsum().to_numpy()
                         if sums else np.zeros((len(pdf), 0)))
                n_out = cnt + base_n[codes]
                s_out = run_s + base_s[codes]
                last = pd.Series(np.arange(len(pdf))).groupby(codes).last().to_numpy()
                for j, k in enumerate(uniq):
                    i = last[j]
                    carry[k] = (n_out[i], s_out[i].copy())
            else:
                base_n, base_s = carry.get((), (0.0, np.zeros(len(sums))))
                n_out = np.arange(1, len(pdf) + 1, dtype="float64") + base_n
                s_out = np.cumsum(vals, axis=0) + base_s
                carry[()] = (n_out[-1], s_out[-1].copy())
            out = pdf.copy()
            out["_lseq"] = (n_out - 1).astype("int64")
            for j, s in enumerate(sums):
                out[f"_lc_{s}"] = s_out[:, j]
            yield out

    return run


def range_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str] = (),
               group: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Rows in sorted ranges: adds ``_pid`` (the range; ids ascend in ``order``),
    ``_lseq`` and ``_lc_<s>`` (row number and inclusive running sum inside the
    range, per group). A row's range is fixed within one execution only: read the
    result once, or checkpoint it."""
    group, sums = list(group), list(sums)
    keys = [F.col(g) for g in group] + list(order)
    # Without an explicit count AQE may merge adjacent small ranges after the
    # shuffle; merged ranges stay contiguous, and the partition id is read after
    # the merge, so ordering by it is still the global order.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id())
    out_schema = T.StructType(ranged.schema.fields + [T.StructField("_lseq", T.LongType())] +
                              [T.StructField(f"_lc_{s}", T.DoubleType()) for s in sums])
    return ranged.mapInPandas(_local_running(group, sums), out_schema)


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str] = (),
                group: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Add ``seq`` (0-based row number), ``cum_<s>`` (inclusive running sum) and
    ``total_<s>`` / ``total_rows`` (group totals) for every row, in ``order`` within ``group``.

    ``order`` must be a total order for ``seq`` to be deterministic (add the key
    as the last tie-breaker).
    """
    group, sums = list(group), list(sums)
    local = checkpoint(range_sums(df, order, sums, group, partitions))

    totals = local.groupBy("_pid", *group).agg(
        F.max("_lseq").alias("_pn"), *[F.max(f"_lc_{s}").alias(f"_pt_{s}") for s in sums])
    w_prev = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*group)
    offsets = totals.select(
        "_pid", *group,
        F.coalesce(F.sum(F.col("_pn") + 1).over(w_prev), F.lit(0)).alias("_on"),
        F.sum(F.col("_pn") + 1).over(w_all).alias("total_rows"),
        *[F.coalesce(F.sum(f"_pt_{s}").over(w_prev), F.lit(0.0)).alias(f"_os_{s}") for s in sums],
        *[F.sum(f"_pt_{s}").over(w_all).alias(f"total_{s}") for s in sums],
    )
    # offsets hold one row per (range, group): bounded by partitions x groups
    joined = local.join(F.broadcast(offsets), ["_pid", *group])
    return joined.select(
        *df.columns,
        (F.col("_on") + F.col("_lseq")).alias("seq"),
        *[(F.col(f"_os_{s}") + F.col(f"_lc_{s}")).alias(f"cum_{s}") for s in sums],
        F.col("total_rows").cast("bigint").alias("total_rows"),
        *[F.col(f"total_{s}") for s in sums],
    )


def global_rank(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (),
                name: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (within ``group``); a distributed row_number."""
    res = prefix_sums(df, order, (), group, partitions)
    return res.select(*df.columns, F.col("seq").alias(name))
