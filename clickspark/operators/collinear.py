"""Collinear numeric columns: which to drop, and how far each is explained by the rest.

The data is read once, for one aggregate of all pairwise correlations (columns
squared / 2 numbers reach the driver). The choice is then made on that small graph.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.operators.profile import correlation_matrix
from clickspark.spec import FeatureSpec

#: Correlations are compared after rounding to so many digits, so that the last bits
#: of a sum do not decide between equals.
DIGITS = 9


def _correlations(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], float | None]:
    out: dict[tuple[str, str], float | None] = {}
    for r in correlation_matrix(df, list(columns)).collect():
        value = None if r["corr"] is None or np.isnan(r["corr"]) else round(r["corr"], DIGITS)
        out[r["col_a"], r["col_b"]] = out[r["col_b"], r["col_a"]] = value
    return out


def drop_correlated(df: DataFrame, spec: FeatureSpec, threshold: float = 0.5,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, label_corr, rank, kept, rival, rival_corr) of the numeric columns.

    Columns are taken by descending absolute correlation with the label, ties by
    name, those without one (constant or empty columns) last. A column is dropped if
    its absolute correlation with a kept one exceeds the threshold; ``rival`` is the
    first such column. Pairs count the rows where both have values. So no two kept
    columns are correlated, and every dropped one has a kept rival that tells more
    about the label.
    """
    columns = list(spec.numeric if columns is None else columns)
    corr = _correlations(df.select(F.col(spec.label).cast("double").alias("_label"), *columns), ["_label", *columns])
    of_label = {c: corr.get(("_label", c)) for c in columns}
    ranked = sorted(columns, key=lambda c: (of_label[c] is None, -abs(of_label[c] or 0.0), c))
    kept, rows = [], []
    for rank, c in enumerate(ranked):
        rival = next((k for k in kept if abs(corr[c, k] or 0.0) > threshold), None)
        if rival is None:
            kept.append(c)
        rows.append((c, of_label[c], rank, rival is None, rival, corr[c, rival] if rival else None))
    return df.sparkSession.createDataFrame(rows, "feature string, label_corr double, rank int, kept boolean, rival string, rival_corr double")


def without_correlated(df: DataFrame, spec: FeatureSpec, threshold: float = 0.5) -> FeatureSpec:
    """The spec without the numeric columns that ``drop_correlated`` drops, in its
    own order: ``prepare(df, without_correlated(train, spec))`` trains on the rest."""
    kept = {r["feature"] for r in drop_correlated(df, spec, threshold).where("kept").collect()}
    return replace(spec, numeric=tuple(c for c in spec.numeric if c in kept))


def variance_inflation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, vif): 1 / (1 - R^2) of the column on all others, which is the
    diagonal of the inverse correlation matrix. Over rows with a value in every
    column. A column that others explain exactly has infinity, a constant one null."""
    columns = list(columns)
    corr = _correlations(df.dropna(subset=columns), columns)
    known = [c for c in columns if len(columns) == 1 or any(corr[c, k] is not None for k in columns if k != c)]
    gram = np.array([[1.0 if a == b else corr[a, b] for b in known] for a in known])
    vif: dict[str, float | None] = dict.fromkeys(columns)
    if len(known):
        values, axes = np.linalg.eigh(gram)
        flat = values < 1e-8                                # directions in which the columns add up to a constant
        solid = (axes[:, ~flat] ** 2 / values[~flat]).sum(1)
        vif |= {c: float("inf") if (axes[i, flat] ** 2 > 1e-8).any() else float(solid[i]) for i, c in enumerate(known)}
    return df.sparkSession.createDataFrame([(c, vif[c]) for c in columns], "feature string, vif double")
