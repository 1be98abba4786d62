"""Category indexing, assembly, scaling, class weights and one-hot encoding.

Category index (frequency rank, 0 = most frequent, ties alphabetical):

* ``index_category``: counts are a partial aggregate, ranks come from the
  range-partitioned prefix operator.
* ``apply_category_index``: indexes whose measured bytes fit together under
  ``max_broadcast_bytes`` are joined by broadcast. All other columns go together,
  whatever their number: each combination of their values is looked up once, in a
  long form, and the rows meet their combination in one shuffle. Hot values and
  combinations are salted.
* ``CategoryIndexModel``: the same index, stored as a table, as a pipeline stage. A
  saved model carries its index inside its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import MaxAbsScaler, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.operators.prefix import global_rank
from clickspark.operators.profile import melt
from clickspark.session import scratch_path
from clickspark.spec import FeatureSpec

#: Bytes of all indexes that one call may broadcast, as text plus LABEL_BYTES a label;
#: the result is the same above it.
MAX_BROADCAST_BYTES, LABEL_BYTES = 64 << 20, 64
#: A value that holds more than one part in HOT of its column's rows is salted; there
#: are fewer than HOT such values a column.
HOT = 200
#: Rows with the same values in all wide columns that one task receives.
SALT_ROWS = 100_000


# --- category index -----------------------------------------------------------

def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over non-null values."""
    return (melt(df, columns).where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def index_category(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(column, value, n, idx): idx = rank by count descending then value, from 0."""
    counts = category_counts(df, columns)
    ranked = global_rank(counts, [F.col("n").desc(), F.col("value").asc()], group=["feature"],
                         name="idx", partitions=partitions)
    return ranked.select("feature", "value", "n", F.col("idx").cast("double").alias("idx"))


def label_sizes(index: DataFrame) -> dict[str, int]:
    """Number of labels per column: one row per column reaches the driver."""
    return {r["feature"]: r["n_labels"] for r in
            index.groupBy("feature").agg(F.count(F.lit(1)).alias("n_labels")).collect()}


def _index_bytes(index: DataFrame) -> dict[str, tuple[int, int]]:
    """(labels, bytes) per column: one row per column reaches the driver."""
    size = F.sum(F.octet_length("value") + LABEL_BYTES)
    return {r["feature"]: (r["n"], r["size"]) for r in
            index.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), size.alias("size")).collect()}


def apply_category_index(df: DataFrame, index: DataFrame, columns: Sequence[str], suffix: str = "_idx",
                         max_broadcast_bytes: int = MAX_BROADCAST_BYTES, drop_source: bool = False) -> DataFrame:
    """Add ``<c><suffix>`` (double) per column; null and unseen values get the label count
    (``handleInvalid='keep'`` semantics). The new columns are marked as nominal, with
    one value more than there are labels."""
    sizes = _index_bytes(index)
    small, room = [], max_broadcast_bytes
    for c in sorted(columns, key=lambda c: (sizes.get(c, (0, 0))[1], c)):
        room -= sizes.get(c, (0, 0))[1]
        if room >= 0:
            small.append(c)
    wide = [c for c in columns if c not in small]
    out = _apply_wide(df, index, wide, suffix) if wide else df
    for c in small:
        side = F.broadcast(index.where(F.col("feature") == c)       # bytes measured just above
                           .select(F.col("value").alias(f"_v_{c}"), F.col("idx").alias(f"{c}{suffix}")))
        out = out.join(side, out[c] == side[f"_v_{c}"], "left").drop(f"_v_{c}")
    kept = [F.col(f"`{c}`") for c in df.columns if not (drop_source and c in columns)]
    return out.select(*kept, *[_nominal(c + suffix, sizes.get(c, (0, 0))[0]) for c in columns])


def _nominal(name: str, labels: int) -> Column:
    known = F.coalesce(F.col(f"`{name}`"), F.lit(float(labels)))
    return known.alias(name, metadata={"ml_attr": {"type": "nominal", "name": name, "num_vals": labels + 1}})


def row_digest(df: DataFrame) -> Column:
    """MD5 of a whole row. Every value is written with its length, so no two rows
    read alike; nested values as JSON."""
    def written(f: T.StructField) -> Column:
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.UserDefinedType))
        c = F.col(f"`{f.name}`")
        text = F.to_json(F.struct(c)) if nested else F.base64(c) if isinstance(f.dataType, T.BinaryType) else c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.md5(F.concat(*[written(f) for f in df.schema.fields]))


def _apply_wide(df: DataFrame, index: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    """Index of any number of columns in one shuffle of the rows.

    Rows that agree in all ``columns`` have the same index values, so each such
    combination is looked up once: it becomes one long row per column with a value,
    these meet the index by (column, value, salt) and are folded back by the digest of
    the combination. The rows then meet their combination by digest and salt."""
    index = index.where(F.col("feature").isin(list(columns)))
    total = index.groupBy("feature").agg(F.sum("n").alias("total"))
    hot = (index.join(F.broadcast(total), "feature").where(F.col("n") * HOT > F.col("total"))
           .select("feature", "value", F.ceil(F.col("n") * HOT / F.col("total")).alias("salts")))
    hot = F.broadcast(hot)                  # fewer than HOT rows a column
    salted = index.join(hot, ["feature", "value"], "left").select(
        "feature", "value", "idx", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))

    names = [f"_v{i}" for i in range(len(columns))]
    digest = F.unhex(row_digest(df.select(*[F.col(f"`{c}`") for c in columns])))
    values = df.select(*[F.col(f"`{c}`").cast("string").alias(v) for c, v in zip(columns, names)], digest.alias("_of"))
    found = values.groupBy("_of").agg(F.count(F.lit(1)).alias("_n"), *[F.first(v).alias(v) for v in names])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(v).alias("value")) for c, v in zip(columns, names)]
    long = found.select("_of", "_n", F.explode(F.array(*cells)).alias("c")).select("_of", "_n", "c.*")
    long = (long.join(hot, ["feature", "value"], "left")
            .withColumn("salt", F.pmod(F.xxhash64("_of"), F.coalesce("salts", F.lit(1)))).drop("salts"))
    met = long.join(salted, ["feature", "value", "salt"], "left")
    folded = met.groupBy("_of").agg(
        F.first("_n").alias("_n"), *[F.max(F.when(F.col("feature") == c, F.col("idx"))).alias(f"_i{i}") for i, c in enumerate(columns)])

    # rows of a frequent combination go to many tasks; there are rows / SALT_ROWS such combinations at most
    parts = F.ceil(F.col("_n") / SALT_ROWS)
    often = F.broadcast(found.where(F.col("_n") > SALT_ROWS).select("_of", parts.alias("_parts")))
    spread = folded.select("_of", *[f"_i{i}" for i in range(len(columns))],
                           F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_part_of"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(row.alias("row"), digest.alias("digest"), row_digest(df).alias("_whole"))
    rows = rows.join(often, F.col("digest") == F.col("_of"), "left").select("row", "digest", F.when(
        F.col("_parts") > 1, F.pmod(F.xxhash64("_whole"), F.col("_parts"))).otherwise(F.lit(0).cast("long")).alias("_part"))
    out = rows.join(spread, (F.col("digest") == F.col("_of")) & (F.col("_part") == F.col("_part_of")), "left")
    return out.select("row.*", *[F.col(f"_i{i}").alias(c + suffix) for i, c in enumerate(columns)])


def store_index(index: DataFrame, path: str) -> str:
    """Write a category index with one folder per column, so that each column's
    join reads its own entries only."""
    index.write.partitionBy("feature").parquet(path)
    return path


def load_index(spark, path: str) -> DataFrame:
    return spark.read.schema("value string, n bigint, idx double, feature string").parquet(path)


class _IndexWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        index = load_index(self.sparkSession, self.instance.getOrDefault("indexPath"))
        store_index(index, f"{path}/index")


class _IndexReader(DefaultParamsReader):
    def load(self, path: str) -> CategoryIndexModel:
        model = super().load(path)
        return model._set(indexPath=f"{path}/index")


class CategoryIndexModel(Transformer, MLReadable, MLWritable):
    """Pipeline stage that applies a stored category index, at any number of
    labels: the labels stay in a table and never pass through the driver. Null
    and unseen values get the label count.

    Saving copies the index into the model's folder, and a loaded model reads it
    there: it needs neither the scratch folder nor the session it was fitted in,
    and its folder may be moved."""

    inputCols = Param(Params._dummy(), "inputCols", "indexed columns", TypeConverters.toListString)
    indexPath = Param(Params._dummy(), "indexPath", "folder of the stored index", TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "suffix of the output columns", TypeConverters.toString)
    leastRows = Param(Params._dummy(), "leastRows", "labels of fewer fitted rows count as unseen", TypeConverters.toInt)

    def __init__(self, columns: Sequence[str] = (), path: str = "", suffix: str = "_idx", least_rows: int = 0):
        super().__init__()
        self._setDefault(leastRows=0)
        self._set(inputCols=list(columns), indexPath=path, suffix=suffix, leastRows=least_rows)

    def of_least(self, rows: int) -> CategoryIndexModel:
        """The same index, whose labels of fewer fitted rows count as unseen."""
        return CategoryIndexModel(self.getOrDefault("inputCols"), self.getOrDefault("indexPath"), self.getOrDefault("suffix"), rows)

    def applied_index(self, spark) -> DataFrame:
        """The labels that the stage tells apart: as ranks go by rows, the first of every column."""
        index = load_index(spark, self.getOrDefault("indexPath"))
        least = self.getOrDefault("leastRows")
        return index.where(F.col("n") >= least) if least else index

    def _transform(self, dataset: DataFrame) -> DataFrame:
        index = self.applied_index(dataset.sparkSession)
        return apply_category_index(dataset, index, self.getOrDefault("inputCols"), self.getOrDefault("suffix"))

    def write(self) -> _IndexWriter:
        return _IndexWriter(self)

    @classmethod
    def read(cls) -> _IndexReader:
        return _IndexReader(cls)


def fit_category_index(df: DataFrame, columns: Sequence[str], suffix: str = "_idx") -> CategoryIndexModel:
    path = store_index(index_category(df, columns), scratch_path(df.sparkSession, "category-index"))
    return CategoryIndexModel(columns, path, suffix)


def index_label(df: DataFrame, spec: FeatureSpec, out: str = "label_idx") -> DataFrame:
    """The label as double: 1.0 always means click, whichever class is larger or
    absent; a null label stays null."""
    return df.withColumn(out, F.col(spec.label).cast("double"))


# --- vectors and scaling -----------------------------------------------------------

def assemble(df: DataFrame, columns: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=handle_invalid).transform(df)


def vector_columns(df: DataFrame, vec: str, names: Sequence[str], prefix: str = "") -> DataFrame:
    """Expose a vector as named double columns (SQL-friendly)."""
    arr = vector_to_array(F.col(vec))
    return df.withColumns({prefix + n: arr[i] for i, n in enumerate(names)}).drop(vec)


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                   prefix: str = "scaled_") -> DataFrame:
    """x / sample stddev (withMean=False); a zero-variance column maps to 0.0.
    ``fit_on`` (e.g. the train split) supplies the statistics."""
    vec = assemble(df, columns, "_vec")
    fit_src = assemble(fit_on, columns, "_vec") if fit_on is not None else vec
    model = StandardScaler(inputCol="_vec", outputCol="_scaled", withStd=True, withMean=False).fit(fit_src)
    return vector_columns(model.transform(vec).drop("_vec"), "_scaled", columns, prefix)


def max_abs_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                  prefix: str = "scaled_") -> DataFrame:
    """x / max |x| per column."""
    vec = assemble(df, columns, "_vec")
    fit_src = assemble(fit_on, columns, "_vec") if fit_on is not None else vec
    model = MaxAbsScaler(inputCol="_vec", outputCol="_scaled").fit(fit_src)
    return vector_columns(model.transform(vec).drop("_vec"), "_scaled", columns, prefix)


# --- class weights -------------------------------------------------------------------

def balancing_ratio(df: DataFrame, spec: FeatureSpec) -> float:
    """negatives / total, from one aggregate (one number to the driver)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(spec.label) == 1).alias("p")).first()
    return (row["n"] - row["p"]) / row["n"] if row["n"] else 0.5


def class_weights(df: DataFrame, spec: FeatureSpec, fit_on: DataFrame | None = None,
                  col: str = "class_weight", ratio: float | None = None) -> DataFrame:
    """Positive rows weigh ``ratio``, negative rows ``1 - ratio`` (ratio = share of
    negatives in ``fit_on``, the training rows), so both classes carry equal total weight.
    A ``ratio`` computed elsewhere (e.g. in a combined aggregate) skips that pass."""
    if ratio is None:
        ratio = balancing_ratio(fit_on if fit_on is not None else df, spec)
    return df.withColumn(col, F.when(F.col(spec.label) == 1, F.lit(ratio)).otherwise(F.lit(1.0 - ratio)))


# --- one-hot ---------------------------------------------------------------------------

def one_hot_encoder(columns: Sequence[str], suffix: str = "_idx", out: str = "_vec") -> OneHotEncoder:
    """Sparse one-hot vectors of indexed columns (``<c><suffix>`` to ``<c><out>``): a
    slot per label, none for null and unseen values. The widths are those that
    ``apply_category_index`` marked, so fitting reads no data."""
    return OneHotEncoder(inputCols=[c + suffix for c in columns], outputCols=[c + out for c in columns], dropLast=True, handleInvalid="error")


def one_hot_long(indexed: DataFrame, key: Sequence[str], columns: Sequence[str], sizes: dict[str, int],
                 suffix: str = "_idx", drop_last: bool = True) -> DataFrame:
    """Sparse one-hot as rows (key..., column, slot): the set entries of
    ``OneHotEncoder(dropLast=True, handleInvalid='keep')`` vectors, where the
    vector of column c has sizes[c] + 1 slots (the extra one for null/unseen).

    The long form never materialises a dense vector, so width does not matter.
    """
    structs = [F.struct(F.lit(c).alias("feature"), F.col(c + suffix).cast("int").alias("slot"),
                        F.lit(sizes[c] + 1 - (1 if drop_last else 0)).alias("_width"))
               for c in columns]
    long = indexed.select(*key, F.explode(F.array(*structs)).alias("_o")).select(*key, "_o.*")
    return long.where(F.col("slot") < F.col("_width")).drop("_width")
