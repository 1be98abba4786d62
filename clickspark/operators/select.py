"""Chi-square feature statistics and selection.

``chi_square_stat`` is a pure query of two aggregates: counts of both labels per
(feature, value), then sums per feature, by the identity
chi2 = N * (sum n_ij^2 / (r_i c_j) - 1), which needs only the observed cells.
Selection ranks the p-values of those statistics, so it has no limit on distinct
values; a continuous feature should be binned first for the test to mean anything.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.operators.profile import bin_expr, column_ranges, melt
from clickspark.spec import FeatureSpec


def chi_square_stat(df: DataFrame, spec: FeatureSpec, columns: Sequence[str]) -> DataFrame:
    """(feature, statistic, dof) of the independence test of each feature with the label."""
    y = F.col(spec.label)
    rows = (melt(df, columns, keep=[spec.label]).where(y.isNotNull()).groupBy("feature", "value")
            .agg(F.count_if(y == 1).alias("n1"), F.count_if(y != 1).alias("n0")))
    total = rows.groupBy("feature").agg(
        F.sum("n1").alias("c1"), F.sum("n0").alias("c0"), F.count(F.lit(1)).alias("n_values"),
        F.sum(F.col("n1") * F.col("n1") / (F.col("n1") + F.col("n0"))).alias("s1"),
        F.sum(F.col("n0") * F.col("n0") / (F.col("n1") + F.col("n0"))).alias("s0"))
    part = lambda s, c: F.coalesce(F.try_divide(F.col(s), F.col(c)), F.lit(0.0))  # noqa: E731  an absent class adds nothing
    n_labels = (F.col("c1") > 0).cast("int") + (F.col("c0") > 0).cast("int")
    return total.select(
        "feature", ((F.col("c1") + F.col("c0")) * (part("s1", "c1") + part("s0", "c0") - 1.0)).alias("statistic"),
        ((F.col("n_values") - 1) * (n_labels - 1)).cast("bigint").alias("dof"))


def bin_numeric(df: DataFrame, columns: Sequence[str], bins: int = 50, suffix: str = "_bin") -> DataFrame:
    """Equal-width bins (as in the histograms), so that a chi-square test of a
    continuous feature counts several rows per value."""
    ranges = column_ranges(df, columns)
    return df.withColumns({c + suffix: bin_expr(c, *ranges[c], bins).cast("double") for c in columns})


def chi_square_sf(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable: the regularised upper incomplete gamma
    function Q(dof / 2, x / 2), as a power series below its mean and a continued
    fraction above. No degrees of freedom: 1."""
    if dof <= 0 or x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    scale = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= z / n
            total += term
        return max(0.0, 1.0 - scale * total)
    # b0 + a1 / (b1 + a2 / (b2 + ...)) by the ratios of successive convergents
    b = z + 1 - a
    up, down = math.inf, 1.0 / b
    value, i, ratio = down, 0, 0.0
    while abs(ratio - 1.0) > 1e-15:
        i += 1
        num = i * (a - i)
        b += 2
        down = 1.0 / ((num * down + b) or 1e-300)
        up = (b + num / up) or 1e-300
        ratio = up * down
        value *= ratio
    return min(1.0, scale * value)


def univariate_select(df: DataFrame, spec: FeatureSpec, columns: Sequence[str], mode: str = "fpr",
                      threshold: float = 0.05) -> DataFrame:
    """(feature, statistic, dof, p_value, selected), with an explicit mode:

    * ``fpr``             p-value below the threshold
    * ``fwe``             p-value below the threshold divided by the number of features
    * ``fdr``             Benjamini-Hochberg at the threshold
    * ``numTopFeatures``  the given number of smallest p-values (ties by name)
    * ``percentile``      the given share of the features, smallest p-values first

    The statistic is ``chi_square_stat``, so a feature may have any number of
    distinct values. What reaches the driver is one row per feature. Fit on train
    rows, then apply the same selection to test: never a second fit on test. An
    empty table has p-value 1 everywhere.
    """
    if mode not in ("fpr", "fwe", "fdr", "numTopFeatures", "percentile"):
        raise ValueError(f"unknown selection mode {mode!r}")
    found = {r["feature"]: (r["statistic"], r["dof"]) for r in chi_square_stat(df, spec, columns).collect()}
    tested = {c: (*found.get(c, (0.0, 0)), chi_square_sf(*found.get(c, (0.0, 0)))) for c in columns}
    order = sorted(columns, key=lambda c: (tested[c][2], c))
    if mode in ("numTopFeatures", "percentile"):
        chosen = order[:int(threshold if mode == "numTopFeatures" else len(order) * threshold)]
    elif mode == "fdr":
        below = [i for i, c in enumerate(order, 1) if tested[c][2] <= threshold * i / len(order)]
        chosen = order[:max(below, default=0)]
    else:
        limit = threshold / len(order) if mode == "fwe" else threshold
        chosen = [c for c in order if tested[c][2] < limit]
    return df.sparkSession.createDataFrame([(c, *map(float, tested[c][:1]), int(tested[c][1]), tested[c][2], c in chosen)
                                            for c in columns],
                                           "feature string, statistic double, dof long, p_value double, selected boolean")


def select_features(train: DataFrame, spec: FeatureSpec, mode: str = "fpr", threshold: float = 0.05,
                    bins: int = 50) -> FeatureSpec:
    """The spec narrowed to the features that the chi-square test selects on the
    train rows; numeric features are tested in equal-width bins. Raises when no
    feature passes."""
    binned = bin_numeric(train, spec.numeric, bins) if spec.numeric else train
    names = {c + "_bin": c for c in spec.numeric} | {c: c for c in spec.categorical}
    rows = univariate_select(binned, spec, list(names), mode, threshold).where("selected").collect()
    chosen = {names[r["feature"]] for r in rows}
    if not chosen:
        raise ValueError(f"no feature is selected by {mode} at {threshold}")
    return replace(spec, numeric=tuple(c for c in spec.numeric if c in chosen),
                   categorical=tuple(c for c in spec.categorical if c in chosen))
