"""Permutation importance: how much AUC is lost when one feature's values are
exchanged between rows. Works for any scorer, linear, tree or fixed.

Values move along a rank: rows are put in the order of a hash of their key, and
feature j of a row is replaced by that of the row j + 1 places on, cyclically. Every
value is used exactly once, and the exchange depends on the keys alone. One ranking
and one shuffle of donated values serve all features; the variants are scored as
one table and ranked as groups of one AUC.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.functions import key_string
from clickspark.operators.clean import fill_numeric_zero
from clickspark.operators.evaluate import auc_exact
from clickspark.operators.models import score_column
from clickspark.operators.prefix import prefix_sums
from clickspark.spec import FeatureSpec

BASE = ""                                   # the variant without an exchange


def exchanged(df: DataFrame, spec: FeatureSpec, features: Sequence[str] | None = None, seed: int = 0) -> DataFrame:
    """Key, label, all features and ``variant``: every row once as it is (variant
    BASE) and once per feature with that feature exchanged. Rows that share a key
    are told apart by a hash of their values."""
    features = list(features or spec.features)
    rows = df.select(*spec.columns)
    order = [F.col("_order"), *[F.col(k) for k in spec.key], F.col("_tie")]
    rows = rows.withColumn("_order", F.md5(F.concat(key_string(spec.key), F.lit(f"-permute-{seed}")))).withColumn(
        "_tie", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in spec.columns]))
    ranked = prefix_sums(rows, order).select(*spec.columns, "seq", "total_rows")
    gift = [F.struct(F.pmod(F.col("seq") - (j + 1), F.col("total_rows")).alias("to"),
                     *[(F.col(g) if g == f else F.lit(None).cast(df.schema[g].dataType)).alias(f"_new_{g}") for g in features])
            for j, f in enumerate(features)]
    given = (ranked.select(F.explode(F.array(*gift)).alias("g")).select("g.*")
             .groupBy("to").agg(*[F.max(f"_new_{f}").alias(f"_new_{f}") for f in features]))
    both = ranked.join(given, F.col("seq") == F.col("to"))
    variants = both.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in (BASE, *features)])))
    shown = {f: F.when(F.col("variant") == f, F.col(f"_new_{f}")).otherwise(F.col(f)).alias(f) for f in features}
    return variants.select("variant", *[shown.get(c, F.col(c)) for c in spec.columns])


def permutation_importance(df: DataFrame, spec: FeatureSpec, score: Callable[[DataFrame], DataFrame],
                           features: Sequence[str] | None = None, seed: int = 0) -> DataFrame:
    """(feature, auc, auc_exchanged, importance), importance = auc - auc_exchanged.

    ``score`` takes rows like those of ``df`` and adds ``score``; it must keep the
    columns ``variant`` and the label. Rows without a score are not ranked."""
    scored = score(exchanged(df, spec, features, seed))
    auc = auc_exact(scored.select("variant", F.col(spec.label).alias("_y"), "score"), "_y", "score", group=["variant"])
    base = auc.where(F.col("variant") == BASE).select(F.col("auc").alias("base"))
    return (auc.where(F.col("variant") != BASE).join(F.broadcast(base))       # one row
            .select(F.col("variant").alias("feature"), F.col("base").alias("auc"), F.col("auc").alias("auc_exchanged"),
                    (F.col("base") - F.col("auc")).alias("importance")))


def model_scorer(pipeline: PipelineModel, model: Transformer, spec: FeatureSpec) -> Callable[[DataFrame], DataFrame]:
    """Scorer of a fitted classifier and its feature pipeline, for raw rows."""
    def score(rows: DataFrame) -> DataFrame:
        filled = fill_numeric_zero(rows, list(spec.numeric))
        return model.transform(pipeline.transform(filled)).withColumn("score", score_column(""))
    return score
