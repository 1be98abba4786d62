"""Invariants of splits, weights, metrics, curves and distributed ranks."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from clickspark.operators import encode, evaluate, prefix, sample, select
from clickspark.plans.featuresets import events_clicks, lineitem_returns
from conftest import SF_MID, SF_SMALL


def test_split_disjoint_complete_and_partition_independent(spark):
    df, spec = events_clicks(spark, SF_MID)
    a = sample.hash_split(df, spec).select("event_id", "split")
    b = sample.hash_split(df.repartition(7), spec).select("event_id", "split")
    assert a.count() == df.count()
    assert a.subtract(b).count() == 0
    tr, te = sample.train_test(df, spec)
    assert tr.count() + te.count() == df.count()
    assert tr.join(te, "event_id").count() == 0
    assert 0.66 < tr.count() / df.count() < 0.74


def test_folds_cover_train(spark):
    df, spec = events_clicks(spark, SF_MID)
    folds = sample.kfold_assign(df, spec, 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2]
    assert sum(r["count"] for r in folds) == df.count()


def test_weights_balance_classes(spark):
    df, spec = events_clicks(spark, SF_MID)
    w = encode.class_weights(df, spec)
    agg = w.agg(F.sum("class_weight").alias("s"), F.count("*").alias("n"),
                F.count_if(F.col("label") == 1).alias("p")).first()
    pos, neg = agg["p"], agg["n"] - agg["p"]
    assert agg["s"] == pytest.approx(2 * pos * neg / agg["n"])
    by = {r["label"]: r["w"] for r in w.groupBy("label").agg(F.sum("class_weight").alias("w")).collect()}
    assert by[0] == pytest.approx(by[1])


def test_auc_matches_evaluator_and_symmetry(spark):
    df, spec = lineitem_returns(spark, SF_MID)
    pred = df.select(F.col("label").cast("double").alias("label"), F.col("l_quantity").alias("s"))
    ours = evaluate.auc_exact(pred, "label", "s").first()["auc"]
    vec = pred.withColumn("raw", F.array(-F.col("s"), F.col("s")))
    from pyspark.ml.functions import array_to_vector
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rv", numBins=0)
    theirs = ev.evaluate(vec.withColumn("rv", array_to_vector("raw")))
    assert ours == pytest.approx(theirs, abs=1e-12)
    neg = evaluate.auc_exact(pred.withColumn("s", -F.col("s")), "label", "s").first()["auc"]
    assert ours + neg == pytest.approx(1.0)
    assert 0.0 <= ours <= 1.0


def test_roc_endpoints_and_monotone(spark):
    df, _ = events_clicks(spark, SF_SMALL)
    roc = evaluate.roc_curve(df, "label", "value").toPandas()
    pts = roc.sort_values(["fpr", "tpr"]).to_numpy()[:, 1:]
    assert tuple(pts[0]) == (0.0, 0.0) and tuple(pts[-1]) == pytest.approx((1.0, 1.0))
    assert (np.diff(roc.dropna().sort_values("threshold", ascending=False)["tpr"].to_numpy()) >= 0).all()


def test_weighted_recall_equals_accuracy(spark):
    df, _ = events_clicks(spark, SF_SMALL)
    pred = df.withColumn("prediction", (F.col("value") > 50).cast("int"))
    m = {r["metric"]: r["value"] for r in evaluate.weighted_metrics(pred, "label").collect()}
    assert m["weighted_recall"] == pytest.approx(m["accuracy"])


def test_prefix_sums_match_pandas(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3).alias("g"), (F.rand(7) * 300).cast("int").alias("s"),
                                      F.col("id"), (F.col("id") % 2).alias("p"))
    got = prefix.prefix_sums(df, [F.col("s").desc(), F.col("id")], ["p"], ["g"], partitions=5).toPandas()
    src = df.toPandas().sort_values(["g", "s", "id"], ascending=[True, False, True])
    src["seq"] = src.groupby("g").cumcount()
    src["cum_p"] = src.groupby("g")["p"].cumsum()
    m = src.merge(got, on=["g", "s", "id", "p"], suffixes=("", "_r"))
    assert len(m) == 20000
    assert (m["seq"] == m["seq_r"]).all() and (m["cum_p"] == m["cum_p_r"]).all()


def test_prefix_sums_default_ranges_with_aqe(spark):
    # no explicit range count: AQE may merge adjacent ranges; sums must stay exact
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        df = spark.range(0, 30000).select((F.rand(11) * 1000).cast("int").alias("s"), F.col("id"),
                                          (F.col("id") % 5 == 0).cast("int").alias("p"))
        got = prefix.prefix_sums(df, [F.col("s").asc(), F.col("id").asc()], ["p"]).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    src = df.toPandas().sort_values(["s", "id"])
    src["seq"] = np.arange(len(src))
    src["cum_p"] = src["p"].cumsum()
    m = src.merge(got, on=["s", "id", "p"], suffixes=("", "_r"))
    assert len(m) == 30000 and (m["seq"] == m["seq_r"]).all() and (m["cum_p"] == m["cum_p_r"]).all()


def test_index_category_matches_string_indexer(spark):
    df, spec = lineitem_returns(spark, SF_MID)
    ours = {(r["feature"], r["value"]): r["idx"] for r in encode.index_category(df, spec.categorical).collect()}
    model = StringIndexer(inputCols=list(spec.categorical), outputCols=[c + "_i" for c in spec.categorical],
                          stringOrderType="frequencyDesc").fit(df)
    for c, labels in zip(spec.categorical, model.labelsArray):
        for i, v in enumerate(labels):
            assert ours[(c, v)] == float(i)


def test_standard_scale_matches_sql_formula(spark):
    df, spec = lineitem_returns(spark, SF_SMALL)
    cols = ["l_quantity", "l_extendedprice"]
    out = encode.standard_scale(df.select("l_orderkey", "l_linenumber", *cols), cols).toPandas()
    pdf = df.select(*cols).toPandas()
    for c in cols:
        expect = np.sort(pdf[c].to_numpy() / pdf[c].std(ddof=1))
        assert np.allclose(np.sort(out[f"scaled_{c}"].to_numpy()), expect)


def test_chi_square_matches_mllib(spark):
    df, spec = lineitem_returns(spark, SF_SMALL)
    enc = encode.apply_category_index(df, encode.index_category(df, spec.categorical), spec.categorical)
    cols = [c + "_idx" for c in spec.categorical]
    ours = {r["feature"]: (r["statistic"], r["dof"]) for r in select.chi_square_stat(
        enc.select("label", *[F.col(c + "_idx").alias(c) for c in spec.categorical]), spec, spec.categorical).collect()}
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(enc).withColumn("y", F.col("label").cast("double"))
    r = ChiSquareTest.test(vec, "v", "y").first()
    for i, c in enumerate(spec.categorical):
        assert ours[c][0] == pytest.approx(float(r["statistics"][i]), rel=1e-9)
        assert ours[c][1] == r["degreesOfFreedom"][i]


def test_feature_steps_keep_row_count(spark):
    df, spec = lineitem_returns(spark, SF_SMALL)
    n = df.count()
    from clickspark.operators import clean
    assert clean.fill_numeric_zero(df).count() == n
    assert clean.clean_blanks(df, spec).count() == n
    enc = encode.apply_category_index(df, encode.index_category(df, spec.categorical), spec.categorical)
    assert enc.count() == n


def test_results_independent_of_partitioning(spark):
    df, spec = lineitem_returns(spark, SF_SMALL)
    df = df.persist()
    other = df.repartition(7, "l_partkey")

    def rows(d):
        return sorted(tuple(r) for r in d.collect())
    assert rows(encode.index_category(df, spec.categorical)) == rows(encode.index_category(other, spec.categorical))
    a = evaluate.auc_exact(df, "label", "l_quantity").first()["auc"]
    b = evaluate.auc_exact(other, "label", "l_quantity").first()["auc"]
    assert a == pytest.approx(b, abs=1e-15)
    from clickspark.operators import rowid
    assert rows(rowid.stable_row_id(df.select(*spec.key), spec)) == rows(rowid.stable_row_id(other.select(*spec.key), spec))
    from clickspark.operators import profile
    assert rows(profile.ctr_by_category(df, spec)) == rows(profile.ctr_by_category(other, spec))
    df.unpersist()


def test_degenerate_inputs_do_not_fail_under_ansi(spark):
    one_class = spark.createDataFrame([(0, 0.1), (0, 0.5)], "label int, s double")
    roc = evaluate.roc_curve(one_class, "label", "s").collect()
    assert all(r["tpr"] is None for r in roc if r["threshold"] is not None)
    assert evaluate.auc_exact(one_class, "label", "s").first()["auc"] is None
    assert len(evaluate.pr_curve(one_class, "label", "s").collect()) == 2
    empty = one_class.where("false")
    from clickspark.operators import profile, theory
    from clickspark.spec import FeatureSpec
    assert profile.null_profile(empty).collect()[0]["pct_null"] is None
    assert theory.label_entropy(empty, FeatureSpec(("s",), "label")).first()["n"] == 0


def test_auc_is_the_same_over_any_ranges_and_stores_nothing(spark, monkeypatch):
    from clickspark.operators import prefix
    df, _ = events_clicks(spark, SF_SMALL)
    monkeypatch.setattr(prefix, "checkpoint", None)      # a call would fail
    found = {round(evaluate.auc_exact(df, "label", "value", partitions=n).first()["auc"], 12) for n in (1, 3, 40)}
    assert len(found) == 1


def test_weighted_metrics_with_row_weights(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    pred = encode.class_weights(df.withColumn("prediction", (F.col("value") > 50).cast("int")), spec)
    plain = {r["metric"]: r["value"] for r in evaluate.weighted_metrics(pred, "label").collect()}
    ones = {r["metric"]: r["value"] for r in
            evaluate.weighted_metrics(pred.withColumn("w1", F.lit(1.0)), "label", weight="w1").collect()}
    assert plain == pytest.approx(ones)
    wtd = {r["metric"]: r["value"] for r in evaluate.weighted_metrics(pred, "label", weight="class_weight").collect()}
    assert wtd["weighted_recall"] == pytest.approx(wtd["accuracy"])
    assert wtd["accuracy"] != pytest.approx(plain["accuracy"])


def test_fit_scope_all_differs_only_in_pipeline_fit(spark):
    from clickspark.operators import models
    df, spec = events_clicks(spark, SF_SMALL)
    a = models.prepare(df, spec)
    b = models.prepare(df, spec, fit_scope="all")
    try:
        assert a.train.count() == b.train.count()
        sa = a.pipeline.stages[-1].std.toArray()
        sb = b.pipeline.stages[-1].std.toArray()
        assert not np.allclose(sa, sb)
    finally:
        a.unpersist()
        b.unpersist()
