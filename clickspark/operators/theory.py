"""The worked examples of the model theory, as distributed queries.

* ``fixed_lr_scores``   sigmoid(b + w . x) for given weights
* ``log_loss``          mean of -y ln p - (1 - y) ln(1 - p)
* ``gradient_step``     one batch gradient-descent step on the log-loss
* ``label_entropy``     -sum p ln p of the label distribution
* ``information_gain``  parent entropy minus the size-weighted entropy of the
                        label within each value of a feature
* ``majority_vote``     most common vote per key (ties -> smallest vote)

All of them are aggregates (map-side combined) or per-row expressions; the
per-value tables are joined, never windowed over a whole feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.functions import entropy_term, sigmoid
from clickspark.operators.profile import melt
from clickspark.spec import FeatureSpec


def fixed_lr_scores(df: DataFrame, spec: FeatureSpec, weights: dict[str, float], intercept: float = 0.0,
                    threshold: float = 0.5) -> DataFrame:
    """(key..., label, z, probability, prediction) for a linear scorer with given weights."""
    z = F.lit(float(intercept))
    for c, w in weights.items():
        z = z + F.lit(float(w)) * F.col(c).cast("double")
    return df.select(*spec.key, F.col(spec.label).alias("label"), z.alias("z"),
                     sigmoid(z).alias("probability")).withColumn(
        "prediction", (F.col("probability") > F.lit(threshold)).cast("int"))


def log_loss(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """(n, log_loss). A certain and wrong score costs infinity, a certain and right
    one nothing; rows without a label or a score are counted but not averaged."""
    y, p = F.col(label), F.col(probability)
    right = F.when(y == 1, p).otherwise(F.lit(1.0) - p)     # probability given to the true class
    term = F.when(y.isNull() | p.isNull(), F.lit(None).cast("double")).when(right > 0, -F.log(right)).otherwise(F.lit(float("inf")))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(term).alias("log_loss"))


def gradient_step(df: DataFrame, spec: FeatureSpec, weights: dict[str, float], intercept: float = 0.0,
                  alpha: float = 0.25) -> DataFrame:
    """(feature, weight, gradient, new_weight) for one step of batch gradient
    descent: gradient_j = mean((p - y) x_j), new = w - alpha * gradient.
    The intercept is the feature '__intercept__' with x = 1."""
    z = F.lit(float(intercept))
    for c, w in weights.items():
        z = z + F.lit(float(w)) * F.col(c).cast("double")
    resid = sigmoid(z) - F.col(spec.label).cast("double")
    feats = [("__intercept__", intercept, F.lit(1.0))] + [(c, w, F.col(c).cast("double")) for c, w in weights.items()]
    wide = df.agg(*[F.avg(resid * x).alias(f"g{i}") for i, (_, _, x) in enumerate(feats)])
    rows = [F.struct(F.lit(name).alias("feature"), F.lit(float(w)).alias("weight"), F.col(f"g{i}").alias("gradient"),
                     (F.lit(float(w)) - F.lit(float(alpha)) * F.col(f"g{i}")).alias("new_weight"))
            for i, (name, w, _) in enumerate(feats)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def label_entropy(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(n, n_pos, entropy) of the label, natural log."""
    y = F.col(spec.label)
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_pos"))
    p = F.try_divide(F.col("n_pos"), F.col("n"))
    return agg.select("n", "n_pos", (entropy_term(p) + entropy_term(F.lit(1.0) - p)).alias("entropy"))


def information_gain(df: DataFrame, spec: FeatureSpec, columns: Sequence[str]) -> DataFrame:
    """(feature, parent_entropy, conditional_entropy, information_gain) per feature."""
    long = melt(df, columns, keep=[spec.label])
    cells = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n_v"),
                                                 F.count_if(F.col(spec.label) == 1).alias("pos_v"))
    p = F.col("pos_v") / F.col("n_v")
    per_value = cells.withColumn("h_v", entropy_term(p) + entropy_term(F.lit(1.0) - p))
    cond = per_value.groupBy("feature").agg(F.sum("n_v").alias("N"), F.sum("pos_v").alias("P"),
                                            F.sum(F.col("n_v") * F.col("h_v")).alias("_wh"))
    pp = F.col("P") / F.col("N")
    return cond.select("feature",
                       (entropy_term(pp) + entropy_term(F.lit(1.0) - pp)).alias("parent_entropy"),
                       (F.col("_wh") / F.col("N")).alias("conditional_entropy")).withColumn(
        "information_gain", F.col("parent_entropy") - F.col("conditional_entropy"))


def majority_vote(votes: DataFrame, key: Sequence[str], vote: str = "vote") -> DataFrame:
    """(key..., vote, n_voters): the most frequent vote per key, ties to the smaller vote.

    One grouped aggregate; ``mode`` keeps a count per distinct vote, so its
    buffer is bounded by the number of classes, not the number of voters.
    """
    return votes.groupBy(*key).agg(F.mode(vote, True).alias(vote), F.count(F.lit(1)).alias("n_voters"))
