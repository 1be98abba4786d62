"""Best split of numeric features: every cut point of every feature, scored by the
information gain of the label.

Rows are first counted by (feature, value); running counts over each feature's
value order then give both sides of every cut. The order is spread over ranges, so
no feature is sorted or summed in one task, and a hot value is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.functions import entropy_term
from clickspark.operators.prefix import prefix_sums
from clickspark.operators.profile import melt
from clickspark.spec import FeatureSpec


def _entropy(positives, n):
    p = positives / n
    return entropy_term(p) + entropy_term(F.lit(1.0) - p)


def threshold_gains(df: DataFrame, spec: FeatureSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, threshold, n_left, pos_left, n_right, pos_right, parent_entropy,
    gain) of every cut: values up to the threshold go left. Rows without a label or
    a value of the feature (null or NaN) are left out of that feature; its largest
    value is no cut, so a feature with fewer than two values has none. Natural log."""
    y = F.col("_y")
    long = melt(df.withColumn("_y", F.col(spec.label)), list(columns or spec.numeric), value_type="double", keep=["_y"])
    counts = (long.where(y.isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value")
              .agg(F.count(F.lit(1)).cast("double").alias("n"), F.count_if(y == 1).cast("double").alias("pos")))
    run = prefix_sums(counts, [F.col("value").asc()], ["n", "pos"], ["feature"]).where(F.col("cum_n") < F.col("total_n"))
    n_right, pos_right = F.col("total_n") - F.col("cum_n"), F.col("total_pos") - F.col("cum_pos")
    parent = _entropy(F.col("total_pos"), F.col("total_n"))
    after = (F.col("cum_n") * _entropy(F.col("cum_pos"), F.col("cum_n")) + n_right * _entropy(pos_right, n_right)) / F.col("total_n")
    return run.select("feature", F.col("value").alias("threshold"), F.col("cum_n").cast("long").alias("n_left"),
                      F.col("cum_pos").cast("long").alias("pos_left"), n_right.cast("long").alias("n_right"),
                      pos_right.cast("long").alias("pos_right"), parent.alias("parent_entropy"), (parent - after).alias("gain"))


def best_threshold(df: DataFrame, spec: FeatureSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """The row of ``threshold_gains`` with the largest gain of every feature (to 12
    digits), the smallest threshold of equals. One partial aggregate, one row a feature."""
    gains = threshold_gains(df, spec, columns)
    best = F.max_by(F.struct(*gains.columns), F.struct(F.round("gain", 12), -F.col("threshold")))
    return gains.groupBy("feature").agg(best.alias("b")).select("b.*")
