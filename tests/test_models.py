"""Model mechanics on the driver tables and skill on a planted signal (FIXTURES F10)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickspark.operators import models, tuning
from clickspark.plans.featuresets import events_clicks
from clickspark.spec import FeatureSpec
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(42)
    n = 2000
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    c = rng.choice(["a", "b", "c"], size=n)
    logit = 2 * x1 - x2 + (c == "a") - 1.6
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(float)
    rows = [(int(i), float(y[i]), float(x1[i]), float(x2[i]), str(c[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, label double, x1 double, x2 double, c string")
    return df, FeatureSpec(("key",), "label", ("x1", "x2"), ("c",))


@pytest.mark.parametrize("kind", ["lr", "rf", "gbt", "lsvc"])
def test_planted_signal_is_learned(planted, kind):
    df, spec = planted
    prep = models.prepare(df, spec)
    try:
        res = models.train(prep, kind, **({"maxIter": 20} if kind in ("gbt", "lsvc") else {}))
        m = {r["metric"]: r["value"] for r in models.evaluate(res, spec).collect()}
        assert m["auc_test"] > 0.7
        shuffled = df.withColumn("label", F.when(F.rand(3) < 0.27, 1.0).otherwise(0.0))
        prep2 = models.prepare(shuffled, spec)
        res2 = models.train(prep2, kind, **({"maxIter": 20} if kind in ("gbt", "lsvc") else {}))
        m2 = {r["metric"]: r["value"] for r in models.evaluate(res2, spec).collect()}
        assert m["auc_test"] > m2["auc_test"]
        prep2.unpersist()
    finally:
        prep.unpersist()


def test_report_shape_on_events(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    rep = models.train_report(df, spec, "lr")
    names = {r["metric"] for r in rep.collect()}
    assert {"auc_train", "auc_test", "accuracy_test", "weighted_fpr_test", "summary_auc_train"} <= names


def test_tune_small_grid(planted):
    df, spec = planted
    out = tuning.tune(df, spec, "lr", grid={"regParam": [0.0, 0.5]}, folds=2, parallelism=2).collect()
    kinds = [r["kind"] for r in out]
    assert kinds.count("cv_auc") == 2 and kinds.count("best_param") == 1
    assert [r for r in out if r["name"] == "auc_test"][0]["value"] > 0.7


def test_coefficients_and_importance(planted):
    df, spec = planted
    prep = models.prepare(df, spec)
    try:
        lr = models.train(prep, "lr", weighted=False)
        coefs = models.lr_coefficients(lr.model, models.feature_names(spec)).collect()
        assert coefs[0]["feature"] == "x1"
        rf = models.train(prep, "rf", weighted=False)
        imp = models.feature_importance(rf.model, models.feature_names(spec)).collect()
        assert imp[0]["feature"] == "x1" and sum(r["importance"] for r in imp) == pytest.approx(1.0)
    finally:
        prep.unpersist()


def test_explain_params(spark):
    from pyspark.ml.classification import GBTClassifier
    rows = tuning.explain_params(GBTClassifier()).collect()
    assert {"maxIter", "maxDepth"} <= {r["param"] for r in rows}


def test_category_index_does_not_depend_on_the_join(spark, tmp_path):
    from clickspark.operators import encode
    df, spec = events_clicks(spark, SF_SMALL)
    df = df.withColumn("uid", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("uid")))
    stage = encode.fit_category_index(df.where("event_id % 3 != 0"), spec.categorical)
    path = str(tmp_path / "stage")
    stage.save(path)
    a = encode.CategoryIndexModel.load(path).transform(df)
    index = encode.load_index(spark, stage.getOrDefault("indexPath"))
    b = encode.apply_category_index(df, index, spec.categorical, max_broadcast_bytes=0)
    assert a.select(b.columns).exceptAll(b).count() == 0 and a.count() == df.count()
    nulls = a.where("uid is null").select("uid_idx").distinct().collect()
    assert [r.uid_idx for r in nulls] == [index.where("feature = 'uid'").count()]


def test_forest_does_not_depend_on_the_input_partitioning(spark, monkeypatch):
    df, spec = events_clicks(spark, SF_SMALL)
    monkeypatch.setattr(models, "ROWS_PER_ML_PARTITION", 200)
    found = []
    for n in (1, 7):
        prep = models.prepare(df.repartition(n), spec)
        try:
            assert prep.train.rdd.getNumPartitions() == models.ml_partitions(df.count()) > 1
            found.append(models.train(prep, "rf", numTrees=5).model.featureImportances.toArray())
        finally:
            prep.unpersist()
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_only_logistic_regression_is_weighted_by_default():
    weights = {k: models.make_classifier(k).isSet("weightCol") for k in ("lr", "rf", "gbt", "lsvc")}
    assert weights == {"lr": True, "rf": False, "gbt": False, "lsvc": False}


def test_prepare_write_back_matches_persist(planted):
    df, spec = planted
    a = models.prepare(df, spec)
    b = models.prepare(df, spec, materialize="write")
    try:
        key = list(spec.key)
        ra = sorted((r[0], r[1]) for r in a.train.select(*key, models.WEIGHT).collect())
        rb = sorted((r[0], r[1]) for r in b.train.select(*key, models.WEIGHT).collect())
        assert ra == rb and b.test.count() == a.test.count()
        m = models.evaluate(models.train(b, "lr"), spec).collect()
        assert {r["metric"]: r["value"] for r in m}["auc_test"] > 0.7
    finally:
        a.unpersist()
        b.unpersist()


def test_full_model_saves_and_scores_identically(spark, planted):
    from pyspark.ml import PipelineModel
    from clickspark.session import scratch_path
    df, spec = planted
    prep = models.prepare(df, spec)
    try:
        res = models.train(prep, "gbt", maxIter=5)
        full = models.full_model(prep, res)
        path = scratch_path(spark, "model")
        full.write().save(path)
        loaded = PipelineModel.load(path)
        a = {r["key"]: (r["prediction"], r["score"]) for r in models.score(full, df, spec).collect()}
        b = {r["key"]: (r["prediction"], r["score"]) for r in models.score(loaded, df, spec).collect()}
        assert a == b and len(a) == df.count()
    finally:
        prep.unpersist()


def test_tables_of_any_size_have_few_partitions():
    """Task results go to the driver: hundreds of passes must not mean thousands of tasks each."""
    assert [models.ml_partitions(n) for n in (0, 1, 150_001, 6_000_000, 36_000_000)] == [1, 1, 2, 24, 24]
    assert models.ml_partitions(1_000_000_000) == 500               # and none grows without bound


def test_linear_solvers_read_all_rows_in_fewer_tasks(spark):
    rows = spark.range(0, 1000, 1, 30)
    assert models.solver_rows(rows, "gbt").rdd.getNumPartitions() == 30
    for kind in ("lr", "lsvc"):
        read = models.solver_rows(rows, kind)
        assert read.rdd.getNumPartitions() == 15 and read.count() == 1000


def test_first_trees_of_a_long_boosting_run_are_the_short_run(planted):
    df, spec = planted
    grid = {"maxIter": [2, 5], "maxDepth": [2, 3]}
    points = tuning.build_grid(models.make_classifier("gbt"), grid)
    assert sorted(len(members) for _, members in tuning.shared_fits("gbt", points)) == [2, 2]
    together = {r["name"]: r["value"] for r in tuning.tune(df, spec, "gbt", grid, folds=2).collect() if r["kind"] == "cv_auc"}
    assert len(together) == 4
    for iters in (2, 5):
        for depth in (2, 3):
            alone = tuning.tune(df, spec, "gbt", {"maxIter": [iters], "maxDepth": [depth]}, folds=2).where("kind = 'cv_auc'").first()
            assert together[alone["name"]] == pytest.approx(alone["value"], abs=1e-9)


def test_points_that_only_differ_in_aggregation_depth_share_a_fit(planted):
    points = tuning.build_grid(models.make_classifier("lsvc"), tuning.REFERENCE_GRIDS["lsvc"])
    jobs = tuning.shared_fits("lsvc", points)
    assert len(points) == 12 and len(jobs) == 6 and sorted(i for _, m in jobs for i in m) == list(range(12))
    df, spec = planted
    out = tuning.tune(df, spec, "lr", {"aggregationDepth": [2, 5], "regParam": [0.0, 0.1]}, folds=2).where("kind = 'cv_auc'").collect()
    assert len(out) == 4
    for r in out:
        named = {k: float(v) for k, v in (p.split("=") for p in r["name"].split(","))}
        alone = tuning.tune(df, spec, "lr", {"aggregationDepth": [int(named["aggregationDepth"])], "regParam": [named["regParam"]]}, folds=2)
        assert r["value"] == pytest.approx(alone.where("kind = 'cv_auc'").first()["value"], abs=1e-6)


def test_labels_that_the_penalty_holds_at_zero_take_no_slot(spark, monkeypatch):
    """The same model with a slot for every label has zeros for them, and the same predictions."""
    monkeypatch.setattr(models, "MAX_SLOTS", 100)
    df = spark.range(4000).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(10)) < F.when(F.col("id") % 3 == 0, 7).otherwise(2)).cast("int").alias("label"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 10).alias("x"), (F.col("id") % 3).cast("string").alias("few"),
        F.floor(F.col("id") / 3).cast("string").alias("many"))
    spec = FeatureSpec(("id",), "label", ("x",), ("few", "many"))
    params = {"regParam": 0.2, "elasticNetParam": 0.5}
    l1 = models.l1_penalty("lr", params)
    slim, full = models.prepare(df, spec, one_hot=True, l1=l1), models.prepare(df, spec, one_hot=True)
    try:
        a, b = models.train(slim, "lr", **params), models.train(full, "lr", **params)
        assert a.model.numFeatures == 1 + 3 and b.model.numFeatures > 1000
        kept, every = a.model.coefficients.toArray(), b.model.coefficients.toArray()
        assert abs(kept).max() > 0.01 and kept == pytest.approx(every[:4], abs=1e-5) and not every[4:].any()
        pa, pb = (dict(r.pred_test.select("id", models.score_column("lr")).collect()) for r in (a, b))
        assert pa == pytest.approx(pb, abs=1e-5) and len(pa) > 1000
    finally:
        slim.unpersist()
        full.unpersist()


def test_no_label_is_left_out_without_an_l1_penalty():
    assert models.l1_penalty("lr", {"regParam": 0.1}) == models.l1_penalty("lr", {"elasticNetParam": 0.5}) == 0
    assert models.l1_penalty("lr", {"regParam": 0.1, "elasticNetParam": 0.5, "standardization": False}) == 0
    assert models.l1_penalty("lsvc", {"regParam": 0.1}) == 0
    assert models.least_label_rows(0.0, 10**9, 10**8, True) == 0
    assert models.least_label_rows(0.005, 36_000_000, 9_000_000, True) == 113
    assert models.least_label_rows(0.005, 36_000_000, 0, True) == 1        # every label of the table
