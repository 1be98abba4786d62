"""Grid search with k-fold cross-validation on the AUC.

Folds come from the row key (``kfold_assign``), so fold membership does not depend
on partitioning and survives recomputation. The train table is persisted once, one
fold's two parts at a time, and grid points are fitted ``parallelism`` at a time.
"""

from __future__ import annotations

import hashlib
import statistics
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.operators.evaluate import auc_exact
from clickspark.operators.models import FEATURES, LABEL, WEIGHT, make_classifier, prepare, score_column, solver_rows
from clickspark.operators.sample import kfold_assign
from clickspark.spec import FeatureSpec

# fixed values: the reference's search grids
REFERENCE_GRIDS = {
    "lr": {"aggregationDepth": [2, 10], "elasticNetParam": [0.0, 0.5], "maxIter": [10, 100],
           "regParam": [0.0, 0.01, 0.5]},
    "rf": {"numTrees": [10, 20], "maxDepth": [5, 10]},
    "gbt": {"maxIter": [10, 20], "maxDepth": [5, 10]},
    "lsvc": {"maxIter": [10, 100], "regParam": [0.0, 0.01, 0.5], "aggregationDepth": [2, 5]},
}


def build_grid(est, grid: dict):
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), values)
    return b.build()


def shared_fits(kind: str, points: list[dict]) -> list[tuple[int, dict[int, int | None]]]:
    """Points whose models one fit gives exactly: (the point to fit, {point: its trees, or
    None for the whole model}).

    ``aggregationDepth`` only says in how many steps the executors' sums are added up.
    Boosting is sequential: the first n trees of a longer run are the run of n trees,
    so the longest run of a group holds the others."""
    groups: dict = {}
    for i, point in enumerate(points):
        named = {p.name: v for p, v in point.items()}
        trees = named.pop("maxIter", None) if kind == "gbt" else None
        named.pop("aggregationDepth", None)
        groups.setdefault(tuple(sorted(named.items())), []).append((trees, i))
    out = []
    for members in groups.values():
        most = max((t for t, _ in members if t is not None), default=None)
        lead = next(i for t, i in members if t == most)
        out.append((lead, {i: None if t == most else t for t, i in members}))
    return out


def _first_trees(model, rows: DataFrame, n: int) -> DataFrame:
    """``rows`` with the raw prediction of the first ``n`` trees of a boosted model."""
    margin = F.lit(0.0)
    for i, (tree, weight) in enumerate(zip(model.trees[:n], model.treeWeights)):
        rows = tree.setFeaturesCol(FEATURES).setPredictionCol(f"_tree{i}").transform(rows)
        margin = margin + F.lit(float(weight)) * F.col(f"_tree{i}")
    return rows.select(LABEL, margin.alias("rawPrediction"))


def tune(df: DataFrame, spec: FeatureSpec, kind: str, grid: dict | None = None, folds: int = 3,
         parallelism: int = 4, seed: int = 2019) -> DataFrame:
    """Rows (model, kind, name, value):
    one 'cv_auc' row per grid point (name = the point's parameters), the best
    point's parameters as 'best_param' rows, and its exact test AUC.

    Every point is scored on every fold; points of one fit (``shared_fits``) are
    scored from it."""
    grid = grid or REFERENCE_GRIDS[kind]
    spark = df.sparkSession
    prep = prepare(df, spec, seed=seed)
    try:
        train = kfold_assign(prep.train, spec, k=folds, seed=seed).select(LABEL, FEATURES, WEIGHT, "fold")
        est = make_classifier(kind, seed=seed)
        points = build_grid(est, grid)
        ev = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction",
                                           metricName="areaUnderROC", numBins=0)
        total = [0.0] * len(points)
        for fold in range(folds):
            used = solver_rows(train.where(F.col("fold") != fold), kind).persist(StorageLevel.MEMORY_AND_DISK)
            held = train.where(F.col("fold") == fold).persist(StorageLevel.MEMORY_AND_DISK)

            def fit(job):
                lead, members = job
                model = est.copy(points[lead]).fit(used)
                known = {n: ev.evaluate(_first_trees(model, held, n) if n else model.transform(held))
                         for n in set(members.values())}
                return {i: known[n] for i, n in members.items()}

            try:
                with ThreadPoolExecutor(max(1, parallelism)) as pool:
                    for scored in pool.map(inheritable_thread_target(spark)(fit), shared_fits(kind, points)):
                        for i, auc in scored.items():
                            total[i] += auc
            finally:
                used.unpersist()
                held.unpersist()
        mean = [t / folds for t in total]
        rows = [(kind, "cv_auc", _point_name(p), float(m)) for p, m in zip(points, mean)]
        best = points[max(range(len(points)), key=lambda i: mean[i])]       # the first of equals
        model = est.copy(best).fit(solver_rows(prep.train, kind))
        rows += [(kind, "best_param", p.name, float(v)) for p, v in sorted(best.items(), key=lambda kv: kv[0].name)]
        test_auc = auc_exact(model.transform(prep.test), LABEL, score_column(kind)).first()["auc"]
        rows.append((kind, "metric", "auc_test", float(test_auc)))
        return spark.createDataFrame(rows, "model string, kind string, name string, value double")
    finally:
        prep.unpersist()


RESULT = "search string, point string, fold int, auc double"


def _point_name(point: dict) -> str:
    return ",".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name))


def _finished(spark, path: str, search: str) -> dict[tuple[str, int], float]:
    """AUC of the fits that this search has stored: points x folds rows at most."""
    try:
        rows = spark.read.schema(f"{RESULT}, fit string").parquet(path).where(F.col("search") == search).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    return {(r["point"], r["fold"]): r["auc"] for r in rows}


def resumable_search(df: DataFrame, spec: FeatureSpec, kind: str, path: str, grid: dict | None = None, folds: int = 3,
                     parallelism: int = 4, seed: int = 2019) -> DataFrame:
    """The rows of ``tune`` and, per grid point, 'cv_spread': the standard deviation
    of its AUC over the folds.

    Every fit adds its (search, point, fold, AUC) to the table at ``path`` as it
    ends. A search that starts again with the same settings reads them and makes only
    the fits that are missing; folds hang on the row keys, so they are the same.
    Other settings at the same path do not meet them. The data must be the same.
    """
    grid = grid or REFERENCE_GRIDS[kind]
    spark = df.sparkSession
    search = hashlib.md5(repr((kind, folds, seed, spec)).encode()).hexdigest()
    est = make_classifier(kind, seed=seed)
    points = {_point_name(p): p for p in build_grid(est, grid)}
    prep = prepare(df, spec, seed=seed)
    try:
        train = kfold_assign(prep.train, spec, k=folds, seed=seed)
        done = _finished(spark, path, search)

        def fit(job: tuple[str, int]) -> None:
            point, fold = job
            model = est.copy(points[point]).fit(solver_rows(train.where(F.col("fold") != fold), kind))
            auc = auc_exact(model.transform(train.where(F.col("fold") == fold)), LABEL, score_column(kind)).first()
            row = [(search, point, fold, auc["auc"] if auc else None)]
            # a folder a fit: writers that end together do not meet
            spark.createDataFrame(row, RESULT).coalesce(1).write.mode("overwrite").parquet(f"{path}/fit={hashlib.md5(repr((search, job)).encode()).hexdigest()}")

        missing = [(p, f) for p in points for f in range(folds) if (p, f) not in done]
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            for ended in [pool.submit(inheritable_thread_target(spark)(fit), job) for job in missing]:
                ended.result()
        done = _finished(spark, path, search)

        rows, mean = [], {}
        for p in points:
            aucs = [done[p, f] for f in range(folds) if done[p, f] is not None]
            mean[p] = sum(aucs) / len(aucs) if aucs else float("nan")
            rows.append((kind, "cv_auc", p, mean[p]))
            rows.append((kind, "cv_spread", p, statistics.pstdev(aucs) if aucs else None))
        best = points[max(points, key=lambda p: (mean[p] == mean[p], mean[p]))]      # the first of equals
        model = est.copy(best).fit(solver_rows(prep.train, kind))
        rows += [(kind, "best_param", p.name, float(v)) for p, v in sorted(best.items(), key=lambda kv: kv[0].name)]
        test = auc_exact(model.transform(prep.test), LABEL, score_column(kind)).first()["auc"]
        rows.append((kind, "metric", "auc_test", test))
        return spark.createDataFrame(rows, "model string, kind string, name string, value double")
    finally:
        prep.unpersist()


def explain_params(est) -> DataFrame:
    """(param, value, doc) rows for an estimator (``explainParams`` as a table)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    rows = []
    for p in sorted(est.params, key=lambda p: p.name):
        val = est.getOrDefault(p) if est.isDefined(p) else None
        rows.append((p.name, None if val is None else str(val), p.doc))
    return spark.createDataFrame(rows, "param string, value string, doc string")
