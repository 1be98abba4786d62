"""Connected components of an undirected graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.session import scratch_path

MAX_ROUNDS = 60


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage, and gives
    the next join two plain inputs whose skewed keys Spark can split."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = _stored(both.groupBy(F.col("v").alias("of")).agg(F.min("u").alias("m"))
                    .select("of", F.least("of", "m").alias("m")), "cc-large")
    return (both.join(least, F.col("v") == F.col("of")).where("u > v")
            .select(F.col("u").alias("v"), F.col("m").alias("u")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = _stored(edges.groupBy(F.col("v").alias("of")).agg(F.min("u").alias("m")), "cc-small")
    moved = edges.join(least, F.col("v") == F.col("of")).select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionByName(least.select(F.col("of").alias("v"), F.col("m").alias("u"))).where("v != u").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link to another node;
    ``component`` is the smallest node reachable. Self links and rows with a
    null end are ignored; repeated links count once; no links, no rows.

    Each round replaces every neighbourhood by a star around its smallest
    member (first upwards, then downwards) until nothing changes, which takes a
    number of rounds logarithmic in the component size. Only two scalars per
    round reach the driver. Every round is written to the shared folder.
    """
    cur = _stored(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct(), "cc-edges")
    state = _state(cur)
    for _ in range(MAX_ROUNDS if state[0] else 0):
        cur = _stored(_small_star(_stored(_large_star(cur), "cc-half")), "cc-round")
        new = _state(cur)
        if new == state:
            break
        state = new
    else:
        if state[0]:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (cur.select(F.col("v").alias("node"), F.col("u").alias("component"))
            .unionByName(cur.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()))
