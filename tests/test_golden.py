"""Worked examples (FIXTURES F7, F8) with independently recomputed values."""

import math

import pytest

from clickspark.operators import encode, theory
from clickspark.spec import FeatureSpec

ADS = [("firstad.png", 1, 20, 1), ("secondad.png", 1, 10, 5), ("firstad.png", 1, 15, 4),
       ("thirdad.png", 0, 12, 2), ("firstad.png", 0, 30, 1)]


@pytest.fixture
def ads(spark):
    return spark.createDataFrame([(i,) + r for i, r in enumerate(ADS)],
                                 "key long, name string, click int, feature1 int, feature2 int")


def test_index_of_name(ads):
    idx = {r["value"]: r["idx"] for r in encode.index_category(ads, ["name"]).collect()}
    assert idx == {"firstad.png": 0.0, "secondad.png": 1.0, "thirdad.png": 2.0}


def test_max_scaling(ads):
    out = encode.max_abs_scale(ads, ["feature1", "feature2"]).orderBy("key").collect()
    assert [r["scaled_feature1"] for r in out] == pytest.approx([20 / 30, 10 / 30, 15 / 30, 12 / 30, 1.0])
    assert [r["scaled_feature2"] for r in out] == pytest.approx([1 / 5, 1.0, 4 / 5, 2 / 5, 1 / 5])


def _scaled(ads):
    return encode.max_abs_scale(ads, ["feature1", "feature2"], prefix="s_")


SPEC = FeatureSpec(key=("key",), label="click", numeric=("s_feature1", "s_feature2"))


def test_sigmoid_and_log_loss(ads):
    sc = theory.fixed_lr_scores(_scaled(ads), SPEC, {"s_feature1": 1.0, "s_feature2": 1.0})
    probs = [r["probability"] for r in sc.orderBy("key").collect()]
    assert probs == pytest.approx([0.7040516276171624, 0.791391472673955, 0.7858349830425586,
                                   0.6899744811276125, 0.7685247834990175], abs=1e-12)
    ll = theory.log_loss(sc).first()["log_loss"]
    assert ll == pytest.approx(0.6920515406051662, abs=1e-12)


def test_gradient_step(ads):
    g = {r["feature"]: r for r in theory.gradient_step(_scaled(ads), SPEC, {"s_feature1": 1.0, "s_feature2": 1.0},
                                                        intercept=0.0, alpha=0.25).collect()}
    assert g["s_feature1"]["new_weight"] == pytest.approx(0.9664701511612949, abs=1e-12)
    assert g["s_feature2"]["new_weight"] == pytest.approx(1.0004717733108859, abs=1e-12)
    nxt = theory.fixed_lr_scores(_scaled(ads), SPEC, {"s_feature1": g["s_feature1"]["new_weight"],
                                                      "s_feature2": g["s_feature2"]["new_weight"]})
    assert theory.log_loss(nxt).first()["log_loss"] == pytest.approx(0.6875941843066289, abs=1e-12)


def test_conditional_entropy(spark):
    # F8: scaled table, entropy = -sum p ln p
    rows = [(1, "2/3", "2/5", 1), (2, "1/3", "1", 1), (3, "1/2", "2/5", 1), (4, "4/10", "4/5", 0), (5, "1/2", "1/5", 0)]
    df = spark.createDataFrame(rows, "key long, f1 string, f2 string, click int")
    spec = FeatureSpec(("key",), "click", (), ("f1", "f2"))

    def cond(sub):
        return {r["feature"]: r["conditional_entropy"] for r in theory.information_gain(sub, spec, ["f1", "f2"]).collect()}
    a = cond(df.where("key <= 4"))
    assert a["f1"] == pytest.approx(0.0) and a["f2"] == pytest.approx(0.0)
    b = cond(df.where("key >= 2"))
    assert b["f1"] == pytest.approx(0.34657359, abs=1e-8) and b["f2"] == pytest.approx(0.0)
    assert -(0.5 * math.log(0.5)) * 2 == pytest.approx(0.6931471805599453)


def test_majority_vote(spark):
    votes = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (2, 1), (3, 0)], "key long, vote int")
    out = {r["key"]: (r["vote"], r["n_voters"]) for r in theory.majority_vote(votes, ["key"]).collect()}
    assert out == {1: (1, 3), 2: (0, 2), 3: (0, 1)}
