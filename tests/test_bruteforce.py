"""Queries without a SQL twin, checked against brute force on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickspark.operators import encode, models, profile, sample, select
from clickspark.plans.featuresets import events_clicks, lineitem_returns
from conftest import SF_MID, SF_SMALL


def test_quantile_profile_within_sketch_error(spark):
    df, spec = events_clicks(spark, SF_MID)
    got = {(r["feature"], r["prob"]): r["value"] for r in profile.quantile_profile(df, spec.numeric).collect()}
    pdf = df.select(*spec.numeric).toPandas()
    n = len(pdf)
    for c in spec.numeric:
        xs = np.sort(pdf[c].to_numpy(dtype=float))
        for p in (0.25, 0.5, 0.75):
            v = got[(c, p)]
            # rank of the returned value must be within accuracy's error (1/10000 of n), plus ties
            lo, hi = np.searchsorted(xs, v, "left"), np.searchsorted(xs, v, "right")
            target = p * n
            assert lo - n / 10000 - 1 <= target <= hi + n / 10000 + 1


def test_selection_matches_the_ml_library(spark):
    from pyspark.ml.feature import UnivariateFeatureSelector
    from pyspark.ml.stat import ChiSquareTest
    df, spec = lineitem_returns(spark, SF_SMALL)
    enc = encode.apply_category_index(df, encode.index_category(df, spec.categorical), spec.categorical)
    enc = enc.withColumn("by_label", (F.col("label") * 3 + F.col("l_linenumber") % 3).cast("double"))
    cols = [*[c + "_idx" for c in spec.categorical], "by_label"]
    vec = encode.assemble(enc, cols, "features").withColumn("y", F.col("label").cast("double"))
    test = ChiSquareTest.test(vec, "features", "y").first()
    ours = {r["feature"]: r for r in select.univariate_select(enc, spec, cols, "fpr", 0.05).collect()}
    for i, c in enumerate(cols):
        assert ours[c]["statistic"] == pytest.approx(test.statistics[i], rel=1e-9)
        assert ours[c]["dof"] == test.degreesOfFreedom[i]
        assert ours[c]["p_value"] == pytest.approx(test.pValues[i], abs=1e-10)
    for mode, limit in (("fpr", 0.5), ("numTopFeatures", 3), ("percentile", 0.5), ("fdr", 0.6), ("fwe", 0.9)):
        theirs = UnivariateFeatureSelector(featuresCol="features", labelCol="y", outputCol="out", selectionMode=mode)
        theirs = theirs.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(limit).fit(vec)
        mine = select.univariate_select(enc, spec, cols, mode, limit).where("selected").collect()
        assert {r["feature"] for r in mine} == {cols[i] for i in theirs.selectedFeatures}, mode


def test_chi_square_tail():
    # closed forms: exp(-x/2) for two degrees of freedom, with a polynomial factor for more even ones
    from math import exp
    for x in (0.1, 1.0, 3.0, 20.0, 200.0):
        assert select.chi_square_sf(x, 2) == pytest.approx(exp(-x / 2), rel=1e-11)
        assert select.chi_square_sf(x, 6) == pytest.approx(exp(-x / 2) * (1 + x / 2 + x * x / 8), rel=1e-11)
    assert select.chi_square_sf(5.0, 0) == 1.0 and select.chi_square_sf(0.0, 3) == 1.0
    assert 0.4 < select.chi_square_sf(1e6, 10 ** 6) < 0.6


def test_selection_is_fitted_on_train_and_applied_to_both_parts(spark):
    from clickspark.spec import FeatureSpec
    from clickspark.operators.sample import hash_split
    df = spark.createDataFrame([(i, i % 2, float(i % 2 + i % 5), float(i % 7), "ab"[i % 2], "xyz"[i % 3]) for i in range(600)],
                               "key long, label int, x double, noise double, c string, d string")
    spec = FeatureSpec(("key",), "label", ("x", "noise"), ("c", "d"))
    # in the test rows alone, d gives the label away: the selection must not see it
    split = hash_split(df, spec, 0.7, 2019)
    leak = split.withColumn("d", F.when(F.col("split") == "test", F.col("label").cast("string")).otherwise(F.col("d"))).drop("split")
    prep = models.prepare(leak, spec, selection=("fpr", 1e-6))
    try:
        assert prep.spec.features == ("x", "c")
        assert {len(r[0]) for p in (prep.train, prep.test) for r in p.select(models.FEATURES).collect()} == {2}
    finally:
        prep.unpersist()
    names = {r["metric"] for r in models.train_report(leak, spec, "lr", selection=("fpr", 1e-6)).collect()}
    assert {"selected_x", "selected_c", "accuracy_train", "auc_test"} <= names


def test_exact_quantiles(spark):
    rows = [(1.0, 5), (2.0, None), (2.0, 7), (2.0, 7), (9.0, 8), (None, 1)]
    df = spark.createDataFrame(rows, "a double, b int")
    got = {(r["feature"], r["prob"]): r["value"] for r in profile.quantile_exact(df, ["a", "b"], (0.0, 0.2, 0.5, 0.8, 1.0)).collect()}
    assert [got["a", p] for p in (0.0, 0.2, 0.5, 0.8, 1.0)] == [1.0, 1.0, 2.0, 2.0, 9.0]
    assert [got["b", p] for p in (0.0, 0.2, 0.5, 0.8, 1.0)] == [1.0, 1.0, 7.0, 7.0, 8.0]
    assert profile.quantile_exact(df.where("false"), ["a"]).count() == 0


def test_describe_all_fields(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(1, "b", True, Decimal("1.50")), (3, None, False, None), (None, "a", True, Decimal("2.50"))],
                               "i int, s string, f boolean, d decimal(10,2)")
    got = {r["feature"]: r for r in profile.describe_all_fields(df).collect()}
    assert (got["i"]["mean"], got["i"]["n_null"], got["i"]["min_value"], got["i"]["max_value"]) == (2.0, 1, 1.0, 3.0)
    assert (got["s"]["min_str"], got["s"]["max_str"], got["s"]["mean"]) == ("a", "b", None)
    assert got["f"]["n_non_null"] == 3 and got["f"]["mean"] is None
    assert got["d"]["mean"] == 2.0
    assert profile.describe_all_fields(df.where("false")).where("n_non_null = 0 and mean is null").count() == 4


def test_previews_of_a_fitted_model(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    prep = models.prepare(df, spec)
    try:
        pred = models.train(prep, "rf", numTrees=3).pred_test
        first = models.prediction_preview(pred, spec, 5).collect()
        assert [r["event_id"] for r in first] == sorted(r["event_id"] for r in pred.select("event_id").collect())[:5]
        top = models.prediction_preview(pred, spec, 5, negatives_first=True).collect()
        best = sorted((-float(r["probability"][0]) for r in pred.where("prediction = 0").select("probability").collect()))[:5]
        assert [-r["probability"][0] for r in top] == best and all(len(r["raw_prediction"]) == 2 for r in top)
    finally:
        prep.unpersist()


def test_stream_scoring_equals_batch_scoring(spark):
    from clickspark.plans.featuresets import events_to_clicks
    from clickspark.operators import clean
    from clickspark.session import scratch_path
    from clickspark.sources import read_table
    from clickspark.streaming import file_stream, score_stream
    df, spec = events_clicks(spark, SF_SMALL)
    prep = models.prepare(df, spec)
    try:
        res = models.train(prep, "lr")
        path = f"{SF_SMALL}/events.parquet"
        feats = clean.fill_numeric_zero(events_to_clicks(file_stream(spark, path)), list(spec.numeric))
        sink = scratch_path(spark, "scored-test")
        score_stream(feats, prep.pipeline, res.model, spec.key, sink, scratch_path(spark, "scored-test-ckpt"))
        streamed = {r["event_id"]: (r["prediction"], r["score"]) for r in spark.read.parquet(sink).collect()}
        batch_in = clean.fill_numeric_zero(events_to_clicks(read_table(spark, SF_SMALL, "events")), list(spec.numeric))
        batch = res.model.transform(prep.pipeline.transform(batch_in)).select(
            "event_id", "prediction", models.score_column("lr").alias("score")).collect()
        assert len(streamed) == len(batch)
        for r in batch:
            p, s = streamed[r["event_id"]]
            assert p == r["prediction"] and s == pytest.approx(r["score"], abs=1e-12)
    finally:
        prep.unpersist()


@pytest.mark.parametrize("n", [1, 7, 500, 5000, 20000])
def test_limit_extract_matches_plain_top_n(spark, n):
    from clickspark.spec import FeatureSpec
    # skewed keys: a third of the rows share one key value, a few nulls, negative values
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(10**9)).when(F.col("id") % 997 == 1, F.lit(None))
         .otherwise(F.col("id") * 7919 % 100003 - 5000).cast("bigint").alias("k"),
        F.col("id").alias("k2"))
    spec = FeatureSpec(("k", "k2"), "label")
    got = [tuple(r) for r in sample.limit_extract(df, spec, n, bins=16).collect()]
    want = [tuple(r) for r in df.orderBy("k", "k2").limit(n).collect()]
    assert got == want


@pytest.mark.parametrize("n", [100, 9000, 10500])
def test_limit_extract_hot_key_at_the_boundary(spark, n):
    from clickspark.spec import FeatureSpec
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-(10**9))).otherwise(F.col("id")).cast("bigint").alias("k"),
        F.col("id").alias("k2"))
    spec = FeatureSpec(("k", "k2"), "label")
    got = [tuple(r) for r in sample.limit_extract(df, spec, n, bins=16, slack=1).collect()]
    assert got == [tuple(r) for r in df.orderBy("k", "k2").limit(n).collect()]
