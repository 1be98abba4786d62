"""Approximate nearest neighbours by inner product: multi-index hashing.

``fit`` learns a rotation (principal axes, then iterative quantisation) from a
bounded sample; the signs of a rotated vector are its 64-bit code. Vectors get
one more component that gives all of them the same length, so that the largest
inner product is the smallest angle.

A code is cut into four substrings, each indexed in a table of its own. Codes
within Hamming distance r agree within t_i bits in at least one substring when
the (t_i + 1) add up to r + 1, so probing every table within its t_i retrieves
*every* code within r. A pair found by several tables counts in the first of
them. Retrieved rows are ranked by the inner product of the original vectors.

Tables are dealt by the leading bits of the substring (cells); a query goes to the
cells whose leading bits are near enough. Cells of more rows or queries than a
task should hold are split in a grid, so no bucket is capped and no copy dropped.
Cells are probed in rounds, nearest first; a round returns no row below the k-th
score that its query has already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.llm.tasks import map_arrow, ship
from clickspark.session import scratch_path

TOP_K = 20
BITS, TABLES = 64, 4
WIDTH = BITS // TABLES
#: The fitted sample: rows, and values at most (the driver holds it).
FIT_ROWS, FIT_VALUES = 20_000, 1 << 21
#: Queries of the sample that set the radius, and the share of their true
#: neighbours in the sample that must lie within it. Neighbours among all rows
#: are nearer than those in a sample, so the share found is rather higher.
RADIUS_QUERIES, TARGET = 500, 0.96
ROUNDS = 40
#: Rows and queries that a task holds at once; leading bits of a cell at most.
CELL_ROWS, QUERY_BLOCK, MAX_PREFIX = 4096, 8192, 12
#: Code pairs compared at once.
PAIRS = 1 << 20
#: A round probes up to so many times the cells probed before it.
GROWTH = 8


@dataclass(frozen=True)
class Coder:
    """Learned codes of vectors with ``dim`` components."""
    dim: int
    scale: float                # largest absolute component of any vector
    length: float               # largest length of any scaled vector
    mean: np.ndarray            # dim + 1
    rotation: np.ndarray        # (dim + 1) x BITS
    radius: int

    def lift(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Vectors of equal length in one more dimension whose order by distance
        is the order by inner product."""
        x = vectors.astype(float) / self.scale
        norm = np.sqrt((x * x).sum(1))
        if query:
            return np.column_stack([x * (self.length / np.maximum(norm, 1e-300))[:, None], np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(self.length ** 2 - norm ** 2, 0))])

    def codes(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        bits = (self.lift(vectors, query) - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel() if len(bits) else np.zeros(0, np.uint64)


def thresholds(radius: int) -> list[int]:
    """Largest substring distances t_i that cover the radius: the t_i + 1 add up to radius + 1."""
    base, more = divmod(radius + 1, TABLES)
    return [base + (i < more) - 1 for i in range(TABLES)]


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, all components finite numbers."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _rotation(lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and as many quantising rotations of the principal axes as give BITS columns."""
    mean = lifted.mean(0)
    centred = lifted - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :BITS]
    flat = centred @ axes
    parts, rng = [], np.random.default_rng(0)
    while sum(p.shape[1] for p in parts) < BITS:
        turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(ROUNDS):
            u, _, vt = np.linalg.svd(flat.T @ np.where(flat @ turn > 0, 1.0, -1.0))
            turn = u @ vt
        parts.append(axes @ turn)
    return mean, np.column_stack(parts)[:, :BITS]


def fit(vectors: DataFrame, vector_col: str = "embedding", k: int = TOP_K) -> Coder | None:
    """Coder of the usable vectors (None if there are none): rotation and radius
    come from a sample of FIT_ROWS rows at most, lengths from all rows. The
    dimension is the most frequent one, the larger of equals."""
    v = F.col(vector_col)
    good = vectors.select(v.alias("v")).where(usable(F.col("v")))
    sizes = good.groupBy(F.size("v").alias("dim")).agg(
        F.count("*").alias("n"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).cast("double").alias("scale"))
    most = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return None
    good = good.where(F.size("v") == most.dim)
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x.cast("double") / most.scale) * (x.cast("double") / most.scale))
    length = float(np.sqrt(good.agg(F.max(squares)).first()[0]))
    rows = max(2000, min(FIT_ROWS, FIT_VALUES // most.dim))
    share = min(1.0, rows / most.n)
    sample = _matrix(good.sample(share, seed=7).limit(2 * rows).toArrow()["v"], most.dim)
    if not len(sample):
        sample = _matrix(good.limit(rows).toArrow()["v"], most.dim)
    coder = Coder(most.dim, most.scale, length, np.zeros(most.dim + 1), np.zeros((most.dim + 1, BITS)), BITS)
    mean, rotation = _rotation(coder.lift(sample, False))
    coder = Coder(most.dim, most.scale, length, mean, rotation, BITS)
    asked = np.linspace(0, len(sample) - 1, min(RADIUS_QUERIES, len(sample))).astype(int)
    scores = sample[asked].astype(float) @ sample.T.astype(float)
    scores[np.arange(len(asked)), asked] = -np.inf
    if len(sample) <= k + 1:
        return coder                        # too few to learn from: search everything
    near = np.argpartition(-scores, k, axis=1)[:, :k]
    codes, of = coder.codes(sample, False), coder.codes(sample[asked], True)
    far = np.sort(np.bitwise_count(of[:, None] ^ codes[near]), axis=None)
    return Coder(most.dim, most.scale, length, mean, rotation, int(far[min(len(far) - 1, int(TARGET * len(far)))]))


def encode(vectors: DataFrame, coder: Coder, query: bool, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code, v, n) of every usable row with an id; n numbers the rows. A narrow map."""
    v = F.col(vector_col)
    src = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.monotonically_increasing_id().alias("n"))
    src = src.where(F.col("id").isNotNull() & usable(F.col("v")) & (F.size("v") == coder.dim))
    shared = vectors.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = shared.value.codes(_matrix(b.column("v"), shared.value.dim), query)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(codes.view(np.int64)), b.column("v"), b.column("n")],
                                             names=["id", "code", "v", "n"])

    kind = src.schema["v"].dataType.simpleString()
    return map_arrow(src, run, f"id long, code long, v {kind}, n long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, so that it is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cells(code: Column, prefix: int) -> Column:
    """One (table, leading bits of its substring) number per table."""
    return F.array(*[F.lit(t << WIDTH) + F.shiftrightunsigned(F.shiftrightunsigned(code, t * WIDTH).bitwiseAND((1 << WIDTH) - 1), WIDTH - prefix)
                     for t in range(TABLES)])


def _rounds(prefix: int, limits: list[int]) -> list[list[list[int]]]:
    """Masks of leading bits to probe, per round and table: the own cell first, then
    cells at growing distance, each round up to GROWTH times the cells before it."""
    out: list[list[list[int]]] = []
    size = before = 0
    for distance in range(min(prefix, max(limits)) + 1):
        masks = [m for m in range(1 << prefix) if m.bit_count() == distance]
        if distance < 2 or size + len(masks) > GROWTH * before:
            out.append([[] for _ in limits])
            before = size
        size += len(masks)
        for t, limit in enumerate(limits):
            if distance <= limit:
                out[-1][t] += masks
    return out


def _retrieve(rows: DataFrame, asked: DataFrame, n_rows: int, radius: int, k: int, dim: int) -> DataFrame:
    """(q, qn, id, score): for every query the k best rows with a code within the
    radius. Later rounds return only rows that may still enter a query's k best, so
    what a query sends to the shuffle does not grow with the number of cells."""
    limits = thresholds(radius)
    if limits[0] >= WIDTH:
        limits[1:] = [-1] * (TABLES - 1)            # the first table finds everything
    prefix = min(MAX_PREFIX, max(0, int(np.ceil(np.log2(max(1, n_rows / CELL_ROWS))))))
    in_use = [t for t in range(TABLES) if limits[t] >= 0]
    indexed = rows.select("id", "code", "v", "n", F.explode(F.filter(
        _cells(F.col("code"), prefix), lambda c: F.shiftright(c, WIDTH).isin(in_use))).alias("cell"))
    cells = _stored(indexed.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).alias("salts")).coalesce(1), "ann-cells")
    found = None
    for masks in _rounds(prefix, limits):
        if found is None:
            waiting = asked.withColumn("floor", F.lit(float("-inf")))
        else:
            floors = (found.groupBy(F.col("q").alias("id"), F.col("qn").alias("n"))
                      .agg(F.when(F.count("*") >= k, F.min("score")).alias("floor")))
            waiting = (asked.join(floors, ["id", "n"], "left").select("id", "code", "v", "n", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")))
        new = _probe(indexed, waiting, cells, masks, limits, prefix, radius, k, dim)
        found = _stored(_best(new if found is None else found.unionByName(new), k).drop("rank"), "ann-found")
    return found


def _probe(indexed: DataFrame, waiting: DataFrame, cells: DataFrame, masks: list[list[int]], limits: list[int], prefix: int,
           radius: int, k: int, dim: int) -> DataFrame:
    """What one round's cells hold for the queries: at most k rows per query and task,
    none below the query's floor."""
    own = _cells(F.col("code"), prefix)
    own_and = lambda t: lambda mask: own[t].bitwiseXOR(mask)
    near = F.flatten(F.array(*[F.transform(F.array(*[F.lit(m).cast("long") for m in part]), own_and(t)) for t, part in enumerate(masks) if part]))
    probes = waiting.select("id", "code", "v", "n", "floor", F.explode(near).alias("cell"))
    # at most TABLES * 2^MAX_PREFIX rows: the grid of every cell
    grid = F.broadcast(_stored(cells.join(
        probes.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks")), "cell").coalesce(1), "ann-grid"))
    part = lambda n, of: F.pmod(F.xxhash64(n), F.col(of))
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    left = indexed.join(grid, "cell").select("cell", part("n", "salts").alias("salt"), every("blocks").alias("block"), "id", "code", "v")
    right = probes.join(grid, "cell").select(
        F.col("cell").alias("to_cell"), every("salts").alias("to_salt"), part("n", "blocks").alias("to_block"),
        *[F.col(c).alias(f"q_{c}") for c in ("id", "code", "v", "n", "floor")])

    def run(key: tuple, held: pa.Table, asking: pa.Table) -> pa.Table:
        table = key[0].as_py() >> WIDTH
        out: list[list[np.ndarray]] = []
        if held.num_rows and asking.num_rows:
            cut = lambda codes, t: (codes >> np.uint64(t * WIDTH)) & np.uint64((1 << WIDTH) - 1)
            codes = held["code"].to_numpy().view(np.uint64)
            order = np.argsort(cut(codes, table), kind="stable")
            codes, ids, vectors = codes[order], held["id"].to_numpy()[order], _matrix(held["v"], dim)[order]
            values, start = np.unique(cut(codes, table), return_index=True)     # the buckets
            size = np.diff(np.append(start, len(codes)))
            q_ids, q_codes, q_n, q_vectors = asking["q_id"].to_numpy(), asking["q_code"].to_numpy().view(np.uint64), asking["q_n"].to_numpy(), _matrix(asking["q_v"], dim)
            floor = asking["q_floor"].to_numpy()
            step = max(1, PAIRS // len(codes))
            for at in range(0, len(q_ids), step):
                some = slice(at, at + step)
                q, bucket = np.nonzero(np.bitwise_count(cut(q_codes[some], table)[:, None] ^ values) <= limits[table])
                n = size[bucket]
                r = np.repeat(start[bucket] - np.concatenate(([0], n.cumsum()[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
                q = np.repeat(q, n) + at
                differ = q_codes[q] ^ codes[r]
                keep = (np.bitwise_count(differ) <= radius) & (q_ids[q] != ids[r])
                for earlier in range(table):
                    keep &= np.bitwise_count(cut(differ, earlier)).astype(int) > limits[earlier]
                q, r = q[keep], r[keep]
                score = np.empty(len(q))
                for a in range(0, len(q), 1 << 16):     # equal vectors add up in equal order: equal scores
                    b = slice(a, a + (1 << 16))
                    score[b] = (q_vectors[q[b]].astype(float) * vectors[r[b]]).sum(1)
                keep = score >= floor[q]
                q, r, score = q[keep], r[keep], score[keep]
                order = np.lexsort((ids[r], -score, q))
                q, r, score = q[order], r[order], score[order]
                first = np.searchsorted(q, q)           # q is sorted: position within its query
                best = np.arange(len(q)) - first < k
                out.append([q_ids[q[best]], q_n[q[best]], ids[r[best]], score[best]])
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table(dict(zip(("q", "qn", "id", "score"), cols, strict=True)))

    ship(indexed.sparkSession)
    return left.groupBy("cell", "salt", "block").cogroup(right.groupBy("to_cell", "to_salt", "to_block")).applyInArrow(
        run, "q long, qn long, id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query."""
    order = Window.partitionBy("q", "qn").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = TOP_K, coder: Coder | None = None, id_col: str = "vec_id",
            vector_col: str = "embedding", query_id: str = "query_id") -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows found for every query.

    ``queries`` has the columns ``query_id`` and ``vector_col``; a row with the
    query's own id is no candidate. Nearest is the largest inner product, in
    double precision; ties go to the smaller id. Vectors that are null, empty, zero,
    of another dimension than most, or hold null or non-finite components take no
    part, nor do rows with a null id; an empty table gives no rows. Every repeated
    row is a candidate; a repeated query row (same id and vector) is answered once,
    and two vectors under one query id are answered one after the other.

    Every code within the learned radius is retrieved. A query with fewer than k
    rows within it is asked again against all rows, so it gets all candidates where
    there are fewer than k. Rows and queries are written once, with their codes, to
    the shared folder.
    """
    spark = vectors.sparkSession
    result = f"{query_id} long, rank int, {id_col} long, score double"
    coder = coder or fit(vectors, vector_col, k)
    if coder is None:
        return spark.createDataFrame([], result)

    rows = _stored(encode(vectors, coder, False, id_col, vector_col), "ann-rows")
    asked = encode(queries, coder, True, query_id, vector_col).dropDuplicates(["id", "v"])
    asked = _stored(asked, "ann-queries")
    n_rows = rows.count()
    found = _retrieve(rows, asked, n_rows, coder.radius, k, coder.dim)
    enough = found.groupBy("q", "qn").count().where(F.col("count") >= k).select(F.col("q").alias("id"), F.col("qn").alias("n"))
    short = asked.join(enough, ["id", "n"], "left_anti").select("id", "code", "v", "n")
    if coder.radius < BITS and not short.isEmpty():
        short = _stored(short, "ann-short")
        wide = _retrieve(rows, short, n_rows, BITS, k, coder.dim)
        found = found.join(enough.select(F.col("id").alias("q"), F.col("n").alias("qn")), ["q", "qn"], "left_semi").unionByName(wide)
    order = Window.partitionBy("q", "qn").orderBy(F.desc("score"), "id")
    return found.select(F.col("q").alias(query_id), F.row_number().over(order).alias("rank"), F.col("id").alias(id_col), "score")
