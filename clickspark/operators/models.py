"""Classifiers: one path for logistic regression, random forest, gradient-boosted
trees and linear SVM.

Shape of a run (the reference's single-job layout, with its traps removed):

1. numeric nulls -> 0, label -> double
2. deterministic hash split 70/30 on the row key
3. feature pipeline (stored category index -> VectorAssembler -> StandardScaler)
   fitted on the TRAIN rows only, then applied to both parts
4. class weights from the train rows
5. the featurized train/test tables are repartitioned and sorted by key (the
   number of partitions follows the rows alone) and persisted once (every later fit and metric reads them instead of
   recomputing the joins and the scans); optionally written to the shared
   folder instead
6. fit, score both parts, exact AUC and weighted metrics as DataFrames

The solvers are MLlib's: each iteration is one distributed aggregate, and
gradient boosting checkpoints its residuals every 10 trees into the shared
checkpoint folder, so a long boosting run keeps a short lineage.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.operators.clean import fill_numeric_zero
from clickspark.operators.collinear import without_correlated
from clickspark.operators.encode import class_weights, fit_category_index, label_sizes, one_hot_encoder
from clickspark.operators.evaluate import auc_exact, weighted_metrics
from clickspark.operators.sample import hash_split
from clickspark.operators.select import select_features
from clickspark.session import discard, ensure_checkpoint_dir, scratch_path, store
from clickspark.spec import FeatureSpec

LABEL, FEATURES, WEIGHT = "label_d", "scaled_features", "class_weight"

# fixed values: the reference's classifier settings for the full-data run
REFERENCE_PARAMS = {
    "lr": {"elasticNetParam": 0.5, "regParam": 0.01},
    "rf": {},
    "gbt": {},
    "lsvc": {"regParam": 0.01},
}


# fixed values: the reference's classifier settings for the sample runs
SAMPLE_PARAMS = {
    "lr": {"maxIter": 10},
    "rf": {"numTrees": 10},
    "gbt": {"maxIter": 10},
    "lsvc": {"maxIter": 10, "regParam": 0.1},
}


def make_classifier(kind: str, weighted: bool | None = None, seed: int = 2019, **params):
    """``weighted``: train with the class weights; by default only logistic
    regression does, as in the reference configuration."""
    weighted = kind == "lr" if weighted is None else weighted
    common = dict(featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction")
    if kind == "lr":
        est = LogisticRegression(**common, **({"weightCol": WEIGHT} if weighted else {}))
    elif kind == "rf":
        est = RandomForestClassifier(**common, seed=seed, checkpointInterval=10,
                                     **({"weightCol": WEIGHT} if weighted else {}))
    elif kind == "gbt":
        # checkpointInterval cuts the lineage of the boosting residuals every 10 trees
        est = GBTClassifier(**common, seed=seed, checkpointInterval=10,
                            **({"weightCol": WEIGHT} if weighted else {}))
    elif kind == "lsvc":
        est = LinearSVC(**common, **({"weightCol": WEIGHT} if weighted else {}))
    else:
        raise ValueError(f"unknown classifier {kind!r}")
    return est.setParams(**params) if params else est


def feature_names(spec: FeatureSpec) -> list[str]:
    return list(spec.numeric) + [c + "_idx" for c in spec.categorical]


#: Every task of every pass sends the driver some 6 KB and takes its time to start; a
#: fit makes hundreds of passes. So a table has few partitions, until they grow large.
ROWS_PER_ML_PARTITION = 150_000
MAX_SMALL_PARTITIONS = 24
MAX_ROWS_PER_ML_PARTITION = 2_000_000
#: Linear solvers make short passes, and the most of them; their sums do not hang on the layout.
LINEAR_PARTITIONS = 12
#: One-hot slots up to which every label goes to the solver: its vectors pass through the driver.
MAX_SLOTS = 200_000


def ml_partitions(n_rows: int) -> int:
    """Partitions for tables that MLlib scans once per iteration, from the row
    count alone: MLlib draws its bootstrap samples per partition, so a layout
    that followed the cores would give other trees on another cluster."""
    by_rows = min(MAX_SMALL_PARTITIONS, -(-n_rows // ROWS_PER_ML_PARTITION))
    return max(1, by_rows, -(-n_rows // MAX_ROWS_PER_ML_PARTITION))


def solver_rows(rows: DataFrame, kind: str) -> DataFrame:
    """All ``rows`` as the solver of ``kind`` scans them: for linear models, neighbouring
    partitions are read together."""
    if kind not in ("lr", "lsvc"):
        return rows
    parts = rows.rdd.getNumPartitions()
    return rows.coalesce(max(LINEAR_PARTITIONS, parts // 2)) if parts > LINEAR_PARTITIONS else rows


def least_label_rows(l1: float, rows: int, positives: int, weighted: bool) -> int:
    """Train rows that a label needs for its one-hot coefficient to leave zero under an
    L1 penalty ``l1`` on standardised features; 0 without a penalty.

    With p the label's share of the weight, its standardised, centred feature has a
    mean absolute value of at most 2 p (1 - p) / sqrt(p (1 - p)) <= 2 sqrt(p). No row's
    error exceeds 1, so this bounds the slope of the loss along the coefficient at
    every point. Up to ``l1`` the coefficient stays at zero in every step from a start
    at zero, and is zero in the optimum. p <= n * largest weight / total weight; with
    class weights that quotient is 2 * the smaller class's rows."""
    total = 2 * min(positives, rows - positives) if weighted else rows
    return math.floor(l1 * l1 * total / 4) + 1 if l1 > 0 else 0


def l1_penalty(kind: str, params: dict) -> float:
    """L1 penalty on standardised features; 0 where the solver has none."""
    if kind != "lr" or not params.get("standardization", True):
        return 0.0
    return params.get("regParam", 0.0) * params.get("elasticNetParam", 0.0)


def fit_feature_pipeline(train: DataFrame, spec: FeatureSpec, one_hot: bool = False, least_rows: int = 0) -> PipelineModel:
    """Category index -> assembler -> scaler, fitted on ``train``. One index for
    every categorical column, whatever its number of labels. With ``one_hot`` every
    label is a feature of its own: vectors stay sparse from the index to the solver,
    and the model holds one coefficient per label. Above ``MAX_SLOTS`` labels, those with
    fewer than ``least_rows`` rows, whose coefficient is known to be zero
    (``least_label_rows``), take no slot."""
    stages = [fit_category_index(train, spec.categorical)] if spec.categorical else []
    names = feature_names(spec)
    if one_hot and spec.categorical:
        labels = label_sizes(stages[0].applied_index(train.sparkSession))
        if least_rows and sum(labels.values()) > MAX_SLOTS:
            stages[0] = stages[0].of_least(least_rows)
            labels = label_sizes(stages[0].applied_index(train.sparkSession))
        wide = [c for c in spec.categorical if labels.get(c)]
        stages += [one_hot_encoder(wide)] if wide else []
        names = [*spec.numeric, *[c + "_vec" for c in wide]]
    stages += [VectorAssembler(inputCols=names, outputCol="features"),
               StandardScaler(inputCol="features", outputCol=FEATURES, withStd=True, withMean=False)]
    return Pipeline(stages=stages).fit(train)


@dataclass
class Prepared:
    spec: FeatureSpec
    pipeline: PipelineModel
    train: DataFrame
    test: DataFrame

    def unpersist(self):
        self.train.unpersist()
        self.test.unpersist()


def prepare(df: DataFrame, spec: FeatureSpec, train_fraction: float = 0.7, seed: int = 2019,
            persist: bool = True, materialize: str = "persist", fit_scope: str = "train",
            selection: tuple[str, float] | None = None, one_hot: bool = False, l1: float = 0.0,
            weighted: bool = True, uncorrelated: float | None = None) -> Prepared:
    """Steps 1-5 of the module docstring.

    The base table (joins, fill, split) is persisted while the feature pipeline
    and the weights are fitted -- three passes that would otherwise each
    recompute the joins -- and released once the featurised train/test tables
    are materialised.

    ``materialize="persist"`` keeps the featurised tables in executor memory and
    disk (a lost executor's blocks are recomputed through the lineage);
    ``"write"`` writes them as Parquet into the shared checkpoint folder and
    reads them back, cutting the lineage for long training jobs. ``"rows"`` is for a ``df`` of
    ``store``: the base table replaces its files, and the vectors are computed in every pass. Rows with
    their keys and vectors are neither shuffled nor kept, which takes several times the disk (tables of one
    partition are). For fits that make few passes over the table themselves, such as linear ones.

    ``fit_scope="all"`` fits the indexer and scaler on all rows before the
    split -- test rows leak into the features -- and exists only to measure
    that effect against the default ``"train"``.

    ``selection`` is a (mode, threshold) of ``select.univariate_select``: features
    are selected on the train rows, and both parts have the selected ones only.
    ``uncorrelated`` is a threshold of ``collinear.drop_correlated``: of the numeric features,
    those are left that it keeps on the train rows as they are before the fill.
    ``one_hot``: see ``fit_feature_pipeline``. ``l1``, ``weighted``: the penalty of the
    fit to come and whether it uses the class weights; labels whose one-hot coefficient
    is zero under it take no slot.
    """
    if materialize not in ("persist", "write", "rows"):
        raise ValueError("materialize must be 'persist', 'write' or 'rows'")
    if fit_scope not in ("train", "all"):
        raise ValueError("fit_scope must be 'train' or 'all'")
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    rows = hash_split(df, spec, train_fraction, seed)
    if persist and materialize == "rows":
        rows = store(rows, "base")
        discard(df)
    if uncorrelated is not None:
        spec = without_correlated(rows.where(F.col("split") == "train"), spec, uncorrelated)
    base = fill_numeric_zero(rows, list(spec.numeric)).withColumn(LABEL, F.col(spec.label).cast("double"))
    parts, ratio, least = None, None, 0
    if persist:
        if materialize != "rows":
            base = base.persist(StorageLevel.MEMORY_AND_DISK)
        # one pass over the kept base gives the row count (partition sizing)
        # and the class ratio of the train rows
        is_train = F.col("split") == "train"
        row = base.agg(F.count(F.lit(1)).alias("_n"), F.count_if(is_train).alias("_nt"),
                       F.count_if(is_train & (F.col(spec.label) == 1)).alias("_pt")).first()
        parts = ml_partitions(row["_n"])
        ratio = (row["_nt"] - row["_pt"]) / row["_nt"] if row["_nt"] else 0.5
        if one_hot and fit_scope == "train":
            least = least_label_rows(l1, row["_nt"], row["_pt"], weighted)
    train_raw = base.where(F.col("split") == "train")
    if selection:
        spec = select_features(train_raw, spec, *selection)
    pipe = fit_feature_pipeline(train_raw if fit_scope == "train" else base, spec, one_hot, least)
    keep = [*spec.key, spec.label, LABEL, FEATURES]
    train = class_weights(pipe.transform(train_raw).select(*keep), spec, fit_on=train_raw, col=WEIGHT,
                          ratio=ratio)
    test = pipe.transform(base.where(F.col("split") == "test")).select(*keep).withColumn(WEIGHT, F.lit(1.0))
    if persist and not (materialize == "rows" and parts > 1):
        # every fit makes many passes: spread the rows (AQE may have coalesced the
        # join output to a few partitions); hashing and sorting by the key keeps
        # the layout identical on any cluster and when a lost partition is recomputed
        train = train.repartition(parts, *spec.key).sortWithinPartitions(*spec.key)
        test = test.repartition(parts, *spec.key).sortWithinPartitions(*spec.key)
        if materialize == "write":          # the written tables are the one copy
            train = _write_back(train, "train")
            test = _write_back(test, "test")
        else:
            train = train.persist(StorageLevel.MEMORY_AND_DISK)
            test = test.persist(StorageLevel.MEMORY_AND_DISK)
            train.count()
            test.count()
        base.unpersist()
    return Prepared(spec, pipe, train, test)


def _write_back(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back (vectors round-trip in Parquet)."""
    path = scratch_path(df.sparkSession, f"features-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def score_column(kind: str):
    """Score of class 1: rawPrediction[1] orders rows like the evaluator does."""
    return vector_to_array(F.col("rawPrediction"))[1]


@dataclass
class TrainResult:
    kind: str
    model: object
    seconds: float
    pred_train: DataFrame
    pred_test: DataFrame


def train(prep: Prepared, kind: str, weighted: bool | None = None, **params) -> TrainResult:
    est = make_classifier(kind, weighted=weighted, **params)
    t0 = time.time()
    model = est.fit(solver_rows(prep.train, kind))
    secs = time.time() - t0
    return TrainResult(kind, model, secs, model.transform(prep.train), model.transform(prep.test))


def evaluate(result: TrainResult, spec: FeatureSpec) -> DataFrame:
    """(model, metric, value) rows: exact train/test AUC, weighted metrics of both parts."""
    spark = result.pred_test.sparkSession
    rows = []
    for part, pred in (("train", result.pred_train), ("test", result.pred_test)):
        a = auc_exact(pred, LABEL, score_column(result.kind)).first()
        rows += [(f"auc_{part}", a["auc"]), (f"n_{part}", float(a["n_pos"] + a["n_neg"]))]
        for r in weighted_metrics(pred, LABEL, "prediction").collect():
            rows.append((f"{r['metric']}_{part}", r["value"]))
    if result.kind in ("lr", "lsvc") and result.model.hasSummary:
        summary = result.model.summary if result.kind == "lr" else result.model.summary()
        rows.append(("iterations_train", float(summary.totalIterations)))
        if result.kind == "lr":
            rows.append(("summary_auc_train", float(summary.areaUnderROC)))
    return spark.createDataFrame([(result.kind, m, float(v) if v is not None else None) for m, v in rows],
                                 "model string, metric string, value double")


def train_report(df: DataFrame, spec: FeatureSpec, kind: str, params: dict | None = None,
                 weighted: bool | None = None, selection: tuple[str, float] | None = None, one_hot: bool = False,
                 uncorrelated: float | None = None, materialize: str = "persist") -> DataFrame:
    """The rows of ``evaluate``; with a ``selection``, also one row per selected feature.
    ``uncorrelated`` and ``materialize``: see ``prepare``."""
    params = params if params is not None else REFERENCE_PARAMS[kind]
    prep = prepare(df, spec, selection=selection, one_hot=one_hot, l1=l1_penalty(kind, params),
                   weighted=kind == "lr" if weighted is None else weighted, uncorrelated=uncorrelated, materialize=materialize)
    res = train(prep, kind, weighted=weighted, **params)
    try:
        report = evaluate(res, prep.spec)
        if not selection:
            return report
        chosen = df.sparkSession.createDataFrame([(kind, f"selected_{c}", 1.0) for c in prep.spec.features], report.schema)
        return report.unionByName(chosen)
    finally:
        prep.unpersist()


def prediction_preview(pred: DataFrame, spec: FeatureSpec, n: int = 10, negatives_first: bool = False) -> DataFrame:
    """(key..., label, raw_prediction, probability, prediction) of ``n`` rows of a
    fitted model's predictions, vectors as arrays: the first by key, or the rows
    predicted negative with the highest class-0 probability. A top-n per partition
    and one merge; only those rows reach the driver."""
    out = pred.select(*spec.key, spec.label, vector_to_array("rawPrediction").alias("raw_prediction"),
                      vector_to_array("probability").alias("probability"), "prediction")
    order = [F.col(k).asc() for k in spec.key]
    if negatives_first:
        out, order = out.where(F.col("prediction") == 0), [F.col("probability")[0].desc(), *order]
    return pred.sparkSession.createDataFrame(out.orderBy(*order).limit(n).collect(), out.schema)


def full_model(prep: Prepared, result: TrainResult) -> PipelineModel:
    """Feature pipeline + classifier as one ``PipelineModel``: persistable with
    ``.write().save(path)`` and usable on raw rows (numerics filled first)."""
    return PipelineModel(stages=[*prep.pipeline.stages, result.model])


def score(model: PipelineModel, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(key..., prediction, score) for raw rows with a saved or fitted full model."""
    out = model.transform(fill_numeric_zero(df, list(spec.numeric)))
    return out.select(*spec.key, "prediction", score_column("").alias("score"))


def lr_coefficients(model, names: Sequence[str]) -> DataFrame:
    """(feature, coefficient, abs_coefficient, rank) sorted by |coefficient| descending."""
    spark = _session()
    coefs = model.coefficients.toArray().tolist()
    rows = sorted(zip(names, coefs), key=lambda t: (-abs(t[1]), t[0]))
    return spark.createDataFrame([(n, float(c), abs(float(c)), i) for i, (n, c) in enumerate(rows)],
                                 "feature string, coefficient double, abs_coefficient double, rank int")


def feature_importance(model, names: Sequence[str]) -> DataFrame:
    """(feature, importance, rank) for tree ensembles."""
    spark = _session()
    imp = model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(n, float(v), i) for i, (n, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def _session():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def compare_classifiers(df: DataFrame, spec: FeatureSpec, kinds: Sequence[str] = ("lr", "rf", "gbt", "lsvc"),
                        params: dict | None = None) -> DataFrame:
    """(model, auc_train, auc_test): one prepared table, four fits."""
    prep = prepare(df, spec)
    rows = []
    try:
        for kind in kinds:
            p = (params or {}).get(kind, REFERENCE_PARAMS[kind])
            res = train(prep, kind, **p)
            a_tr = auc_exact(res.pred_train, LABEL, score_column(kind)).first()["auc"]
            a_te = auc_exact(res.pred_test, LABEL, score_column(kind)).first()["auc"]
            rows.append((kind, a_tr, a_te))
    finally:
        prep.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, auc_train double, auc_test double")
