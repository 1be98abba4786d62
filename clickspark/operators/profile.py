"""Profiling: counts, class balance, CTR, describe, nulls, categories, histograms,
correlations and shape statistics.

Scale notes
-----------
* Every statistic over many columns is computed in ONE scan: the aggregate is
  built wide (one expression per column and statistic), Spark computes it with
  partial (map-side) aggregation, and the single result row is exploded into
  long form. Nothing per row reaches the driver.
* Per-value statistics (category frequency, CTR per value, distinct counts)
  unpivot the columns and group by (column, value). A hot value that holds a
  third of all rows is collapsed map-side by the partial aggregate before the
  shuffle, so no reducer receives its raw rows.
* Histograms need each column's range first: that is one aggregate whose result
  is two numbers per column (a proven bound), read back as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.operators.prefix import prefix_sums
from clickspark.spec import FeatureSpec


def _explode_stats(wide: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn a one-row wide aggregate into one row per struct in ``rows``."""
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def melt(df: DataFrame, columns: Sequence[str], value_type: str = "string",
         keep: Sequence[str] = (), name: str = "feature", value: str = "value") -> DataFrame:
    """Long form (keep..., column, value); values cast to one type. Nulls are kept."""
    if not columns:
        raise ValueError("melt needs at least one column")
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).cast(value_type).alias(value)) for c in columns]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("_m")).select(*keep, f"_m.{name}", f"_m.{value}")


# --- counts, balance, CTR ---------------------------------------------------

def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def label_counts(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return df.groupBy(F.col(spec.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Positives, negatives and percentage of positives in one aggregate pass."""
    y = F.col(spec.label)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(y == 1).alias("n_pos"),
        F.count_if(y != 1).alias("n_neg"),
        (F.avg((y == 1).cast("double")) * 100.0).alias("pct_pos"),
    )


def ctr_overall(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    y = F.col(spec.label)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(y).cast("bigint").alias("n_clicks"),
                  F.avg(y.cast("double")).alias("ctr"))


def ctr_by_category(df: DataFrame, spec: FeatureSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n, clicks, ctr) for every value of every categorical column."""
    cols = list(columns or spec.categorical)
    long = melt(df, cols, keep=[spec.label])
    return (long.groupBy("feature", "value")
                .agg(F.count(F.lit(1)).alias("n"),
                     F.sum(spec.label).cast("bigint").alias("clicks"),
                     F.avg(F.col(spec.label).cast("double")).alias("ctr")))


# --- describe ---------------------------------------------------------------

def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n (non-null count), mean, sample stddev, min, max per numeric column (one scan)."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("n"), F.col(f"m{i}").alias("mean"),
                     F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min_value"),
                     F.col(f"hi{i}").alias("max_value"))
            for i, c in enumerate(columns)]
    return _explode_stats(wide, rows)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_null, pct_null) for every column, one scan."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c).isNull()).alias(f"z{i}")
                                              for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"), F.col("_n").alias("n_rows"), F.col(f"z{i}").alias("n_null"),
                     F.try_divide(F.col(f"z{i}") * 100.0, F.col("_n")).alias("pct_null"))
            for i, c in enumerate(cols)]
    return _explode_stats(wide, rows)


def _is_integral(t) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType))


def describe_all_fields(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, dtype, n_non_null, n_null, mean, stddev, min_value, max_value, min_str, max_str)
    for every field, one scan and one wide aggregate.

    Numeric fields have mean, sample stddev and numeric min/max; string fields
    have min/max as text; what does not apply is null. An empty table gives zero
    counts and nulls. Exact distinct counts are ``distinct_all_fields``."""
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, c in enumerate(cols):
        t, x = types[c], F.col(c)
        number = isinstance(t, T.NumericType)
        text = isinstance(t, T.StringType)
        aggs.append(F.count(x).alias(f"c{i}"))
        if number:
            d = x.cast("double")
            aggs += [F.avg(d).alias(f"m{i}"), F.stddev_samp(d).alias(f"s{i}"), F.min(d).alias(f"lo{i}"), F.max(d).alias(f"hi{i}")]
        elif text:
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        num = lambda k, on=number, i=i: (F.col(f"{k}{i}") if on else F.lit(None)).cast("double")
        txt = lambda k, on=text, i=i: (F.col(f"{k}{i}") if on else F.lit(None)).cast("string")
        rows.append(F.struct(
            F.lit(c).alias("feature"), F.lit(t.simpleString()).alias("dtype"), F.col(f"c{i}").alias("n_non_null"),
            (F.col("_n") - F.col(f"c{i}")).alias("n_null"), num("m").alias("mean"), num("s").alias("stddev"),
            num("lo").alias("min_value"), num("hi").alias("max_value"), txt("lo").alias("min_str"), txt("hi").alias("max_str")))
    return _explode_stats(df.agg(*aggs), rows)


def distinct_all_fields(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, n_distinct): exact distinct non-null values of every field.

    Every field is unpivoted into a typed slot (integral, floating or text, so
    -0.0 equals 0.0 and decimals stay exact) and grouped by (feature, value),
    map-side combined, so a hot value is one row per task. It shuffles the values
    of near-unique fields; ``category_cardinality(approx=True)`` does not."""
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def slot(c):
        integral = _is_integral(types[c])
        floating = isinstance(types[c], (T.FloatType, T.DoubleType))      # decimals stay exact, as text
        return F.struct(
            F.lit(c).alias("feature"),
            (F.col(c).cast("bigint") if integral else F.lit(None).cast("bigint")).alias("v_int"),
            (F.col(c).cast("double") if floating else F.lit(None).cast("double")).alias("v_dbl"),
            (F.col(c).cast("string") if not (integral or floating) else F.lit(None).cast("string")).alias("v_str"),
            F.col(c).isNull().alias("is_null"))

    long = df.select(F.explode(F.array(*[slot(c) for c in cols])).alias("_m")).select("_m.*")
    return (long.groupBy("feature", "v_int", "v_dbl", "v_str", "is_null").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("feature").agg(F.count_if(~F.col("is_null")).alias("n_distinct")))


# --- categories -------------------------------------------------------------

def category_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over ALL rows (the reference looked at 1000)."""
    return melt(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def category_cardinality(df: DataFrame, columns: Sequence[str], approx: bool = False,
                         rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column: exact (two-level grouping) or HyperLogLog++."""
    long = melt(df, columns).where(F.col("value").isNotNull())
    if approx:
        return long.groupBy("feature").agg(F.approx_count_distinct("value", rsd).cast("bigint").alias("n_distinct"))
    return (long.groupBy("feature", "value").agg(F.lit(1).alias("_one"))
                .groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct")))


# --- histograms -------------------------------------------------------------

def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """min and max per column: one aggregate, 2 numbers per column to the driver."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(F.col(c).cast("double")).alias(f"lo{i}"), F.max(F.col(c).cast("double")).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}


def bin_expr(c: str, lo: float | None, hi: float | None, bins: int) -> Column:
    """Equal-width bin in [0, bins-1]; the maximum falls in the last bin; a
    constant column puts everything in bin 0."""
    x = F.col(c).cast("double")
    if lo is None or hi is None:
        return F.lit(None).cast("bigint")
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(0).cast("bigint"))
    width = F.lit(float(hi)) - F.lit(float(lo))
    return F.least(F.lit(bins - 1).cast("bigint"), F.floor((x - F.lit(float(lo))) / width * F.lit(float(bins))))


def histogram_numeric(df: DataFrame, columns: Sequence[str], bins: int = 50,
                      by: str | None = None, ranges=None) -> DataFrame:
    """(column, [by,] bin, n) equal-width histogram over all rows; null values are skipped."""
    ranges = ranges or column_ranges(df, columns)
    pairs = [F.struct(F.lit(c).alias("feature"), bin_expr(c, *ranges[c], bins).alias("bin")) for c in columns]
    keep = [by] if by else []
    long = df.select(*keep, F.explode(F.array(*pairs)).alias("_h")).select(*keep, "_h.feature", "_h.bin")
    return (long.where(F.col("bin").isNotNull())
                .groupBy("feature", *keep, "bin").agg(F.count(F.lit(1)).alias("n")))


def histogram_by_label(df: DataFrame, spec: FeatureSpec, columns: Sequence[str] | None = None,
                       bins: int = 25) -> DataFrame:
    """Class-conditional histograms: same bins for both labels."""
    return histogram_numeric(df, list(columns or spec.numeric), bins, by=spec.label)


# --- correlation and density --------------------------------------------------

def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair (a < b) in one aggregate pass, over
    the rows where both have values; null if one of them is constant there."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")

    def corr(a: str, b: str) -> Column:     # F.corr divides by zero on a constant column
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    wide = df.agg(*[corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)]
    return _explode_stats(wide, rows)


def correlated_pairs(df: DataFrame, columns: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Column pairs whose |corr| exceeds ``threshold``: candidates to drop one of."""
    return correlation_matrix(df, columns).where(F.abs("corr") > threshold)


def pair_density(df: DataFrame, pairs: Sequence[tuple[str, str]], bins: int = 10) -> DataFrame:
    """2-D binned counts for each column pair: the data behind a scatter matrix."""
    cols = sorted({c for p in pairs for c in p})
    ranges = column_ranges(df, cols)
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                        bin_expr(a, *ranges[a], bins).alias("bin_a"), bin_expr(b, *ranges[b], bins).alias("bin_b"))
               for a, b in pairs]
    long = df.select(F.explode(F.array(*structs)).alias("_p")).select("_p.*")
    return (long.where(F.col("bin_a").isNotNull() & F.col("bin_b").isNotNull())
                .groupBy("col_a", "col_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("n")))


# --- shape --------------------------------------------------------------------

def skew_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """mean, population stddev, population skewness and excess kurtosis per column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"),
                 F.skewness(x).alias(f"g{i}"), F.kurtosis(x).alias(f"k{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev_pop"),
                     F.col(f"g{i}").alias("skewness"), F.col(f"k{i}").alias("kurtosis"))
            for i, c in enumerate(columns)]
    return _explode_stats(wide, rows)


def quantile_profile(df: DataFrame, columns: Sequence[str], probs=(0.25, 0.5, 0.75),
                     accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles (Greenwald-Khanna sketches, bounded memory per column)."""
    wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"q{i}")
                    for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(p).alias("prob"), F.col(f"q{i}")[j].alias("value"))
            for i, c in enumerate(columns) for j, p in enumerate(probs)]
    return _explode_stats(wide, rows)


def quantile_exact(df: DataFrame, columns: Sequence[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(feature, prob, value): the smallest value that at least ``prob`` of the
    non-null values do not exceed (a column without values has no rows).

    One row per distinct value with its count, then the distributed running sum
    over the value order: no column is ever sorted in one task."""
    counts = (melt(df, columns, value_type="double").where(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count(F.lit(1)).cast("double").alias("n")))
    run = prefix_sums(counts, [F.col("value").asc()], ["n"], ["feature"])
    at = run.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    rank = F.greatest(F.ceil(F.col("prob") * F.col("total_n")), F.lit(1))
    return (at.where((F.col("cum_n") >= rank) & (F.col("cum_n") - F.col("n") < rank))
            .select("feature", "prob", "value"))
