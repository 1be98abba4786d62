"""Collinear columns, split search, permutation importance, exact stratified sample."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from clickspark.operators import collinear, importance, models, sample, splits
from clickspark.plans.featuresets import events_clicks, lineitem_returns
from clickspark.session import discard, store
from clickspark.spec import FeatureSpec
from conftest import SF_SMALL
from pyspark.sql import functions as F

SPEC = FeatureSpec(("id",), "y", ("a", "b", "c", "d"))


@pytest.fixture(scope="module")
def planted(spark):
    """b follows a, d follows b more loosely, c is alone, e is constant."""
    rng = np.random.default_rng(0)
    a, c, noise = rng.normal(size=(3, 600))
    y = (a + 0.2 * rng.normal(size=600) > 0).astype(int)
    cols = [a, 2 * a + 0.1 * noise, c, a + 0.9 * rng.normal(size=600)]
    rows = [(i, int(y[i]), *[float(x[i]) for x in cols], 1.0) for i in range(600)]
    return spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double, e double")


def test_planted_collinear_column_goes(spark, planted):
    rows = {r.feature: r for r in collinear.drop_correlated(planted, SPEC, 0.8).collect()}
    assert {f for f, r in rows.items() if r.kept} == {"a", "c", "d"} and rows["b"].rival == "a" and rows["b"].rival_corr > 0.9
    assert rows["a"].rank == 0                              # tells most about the label
    spec = collinear.without_correlated(planted, SPEC, 0.8)
    assert spec.numeric == ("a", "c", "d")
    assert {r.feature: r.kept for r in collinear.drop_correlated(planted, SPEC, 0.5).collect()} == {"a": True, "b": False, "c": True, "d": False}
    prep = models.prepare(planted, spec)
    try:
        report = models.evaluate(models.train(prep, "lr"), spec)
        assert report.where("metric = 'auc_test'").first()["value"] > 0.9
    finally:
        prep.unpersist()


def test_kept_columns_are_not_correlated_and_dropped_ones_have_a_rival(spark):
    rng = np.random.default_rng(4)
    for seed in range(3):
        x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 7)) + 0.3 * rng.normal(size=(200, 7))
        df = spark.createDataFrame([(i, int(v[0] > 0), *map(float, v)) for i, v in enumerate(x)], "id long, y int, " + ", ".join(f"x{j} double" for j in range(7)))
        spec, corr = FeatureSpec(("id",), "y", tuple(f"x{j}" for j in range(7))), np.corrcoef(x.T)
        rows = {int(r.feature[1:]): r for r in collinear.drop_correlated(df, spec, 0.6).collect()}
        kept = [j for j, r in rows.items() if r.kept]
        assert all(abs(corr[i, j]) <= 0.6 for i in kept for j in kept if i != j)
        for j, r in rows.items():
            if not r.kept:
                k = int(r.rival[1:])
                assert k in kept and abs(corr[j, k]) > 0.6 and rows[k].rank < r.rank and abs(rows[k].label_corr) >= abs(r.label_corr)


def test_correlation_of_odd_columns(spark):
    df = spark.createDataFrame([(i, i % 2, 1.0, None, float(i), 2.0 * i) for i in range(20)], "id long, y int, a double, b double, c double, d double")
    rows = {r.feature: r for r in collinear.drop_correlated(df, SPEC, 0.5).collect()}
    assert {f for f, r in rows.items() if r.kept} == {"a", "b", "c"} and rows["a"].label_corr is None and rows["a"].rank == 2
    assert collinear.drop_correlated(df.limit(0), SPEC, 0.5).where("kept").count() == 4
    vif = {r.feature: r.vif for r in collinear.variance_inflation(df, ["a", "c", "d"]).collect()}
    assert vif == {"a": None, "c": math.inf, "d": math.inf}


def test_variance_inflation_is_that_of_the_regression(spark, planted):
    vif = {r.feature: r.vif for r in collinear.variance_inflation(planted, SPEC.numeric).collect()}
    x = np.array(planted.select(*SPEC.numeric).toPandas())
    for j, c in enumerate(SPEC.numeric):
        others = np.column_stack([np.ones(len(x)), np.delete(x, j, 1)])
        rest = x[:, j] - others @ np.linalg.lstsq(others, x[:, j], rcond=None)[0]
        assert vif[c] == pytest.approx(x[:, j].var() / rest.var(), rel=1e-5)


def _gains(pairs):
    """Every cut of one feature: (threshold, gain)."""
    def h(ys):
        p = sum(ys) / len(ys)
        return -sum(q * math.log(q) for q in (p, 1 - p) if q)
    out = []
    for t in sorted({x for x, _ in pairs})[:-1]:
        left, right = [y for x, y in pairs if x <= t], [y for x, y in pairs if x > t]
        out.append((t, h([y for _, y in pairs]) - (len(left) * h(left) + len(right) * h(right)) / len(pairs)))
    return out


def test_worked_example_of_the_split_search(spark):
    """First four rows of the worked example: the label's entropy is 0.5623, and both
    features split off as much of it, at 2/5."""
    rows = [(0, 1, 2 / 3, 2 / 5), (1, 1, 1 / 3, 1.0), (2, 1, 1 / 2, 2 / 5), (3, 0, 4 / 10, 4 / 5)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    best = {r.feature: r for r in splits.best_threshold(df, SPEC, ["a", "b"]).collect()}
    for f in ("a", "b"):
        assert best[f].threshold == 0.4 and best[f].parent_entropy == pytest.approx(0.5623351446188083)
        assert best[f].gain == pytest.approx(0.5623351446188083 - math.log(2) / 2)
        assert (best[f].n_left, best[f].n_right) == (2, 2)


def test_every_cut_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < 0.3), rng.choice([None, float("nan"), 1.0, 2.5, -3.0, float(rng.randrange(40))]), float(rng.randrange(300))) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    got = {}
    for r in splits.threshold_gains(df, SPEC, ["a", "b"]).collect():
        got.setdefault(r.feature, []).append((r.threshold, round(r.gain, 9)))
    best = {r.feature: (r.threshold, round(r.gain, 9)) for r in splits.best_threshold(df, SPEC, ["a", "b"]).collect()}
    for f, k in (("a", 2), ("b", 3)):
        cuts = [(t, round(g, 9)) for t, g in _gains([(r[k], r[1]) for r in rows if r[k] is not None and r[k] == r[k]])]
        assert sorted(got[f]) == cuts and best[f] == min(cuts, key=lambda c: (-c[1], c[0]))


def test_split_of_odd_features(spark):
    df = spark.createDataFrame([(1, 1, 5.0, None, 0.0), (2, 0, 5.0, None, 1.0), (3, None, 5.0, 2.0, 2.0)], "id long, y int, a double, b double, c double")
    assert [(r.feature, r.threshold, r.n_left, r.n_right) for r in splits.best_threshold(df, SPEC, ["a", "b", "c"]).collect()] == [("c", 0.0, 1, 1)]
    assert splits.best_threshold(df.limit(0), SPEC, ["a"]).count() == 0


def _rank(keys, salt):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}{salt}".encode()).hexdigest(), k))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 200])
def test_exchange_uses_every_value_once(spark, n):
    spec = FeatureSpec(("id",), "y", ("a", "b"), ("s",))
    rows = [(i, i % 2, float(i), None if i % 5 == 0 else -float(i), f"s{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, s string").repartition(3)
    got = importance.exchanged(df, spec, seed=9).collect()
    order, by_id = _rank(range(n), "-permute-9"), {r[0]: r for r in rows}
    want = []
    for i, r in by_id.items():
        want.append(("", *r))
        for j, c in enumerate((2, 3, 4)):
            new = list(r)
            new[c] = by_id[order[(order.index(i) + j + 1) % n]][c]
            want.append((("a", "b", "s")[j], *new))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_importance_finds_the_feature_that_matters(spark, planted):
    spec = FeatureSpec(("id",), "y", ("a", "c"))
    out = {r.feature: r for r in importance.permutation_importance(planted, spec, lambda d: d.withColumn("score", F.col("a") + 0.01 * F.col("c"))).collect()}
    assert out["a"].importance > 0.3 and abs(out["c"].importance) < 0.02
    prep = models.prepare(planted, spec)
    try:
        for kind in ("lr", "rf"):
            model = models.train(prep, kind).model
            out = {r.feature: r.importance for r in importance.permutation_importance(planted, spec, importance.model_scorer(prep.pipeline, model, spec)).collect()}
            assert out["a"] > 0.3 > 0.1 > abs(out["c"])
    finally:
        prep.unpersist()


@pytest.mark.parametrize("ordered", [100_000, 5])
def test_stratified_sample_is_exact(spark, monkeypatch, ordered):
    monkeypatch.setattr(sample, "MAX_ORDERED", ordered)
    monkeypatch.setattr(sample, "HEX_DIGITS", 1)
    df, spec = events_clicks(spark, SF_SMALL)
    rows = [(r[spec.key[0]], r[spec.label]) for r in df.select(*spec.key, spec.label).collect()]
    n = Counter(y for _, y in rows)
    for sizes in ({0: 17, 1: 33}, {0: 0.1, 1: 0.5}, {1: 10**9, 0: 0}, {1: 1}, {7: 5}):
        got = Counter()
        picked = [tuple(r) for r in sample.sample_exact_by_label(df.repartition(5), spec, sizes, seed=3).select(*spec.key, spec.label).collect()]
        got.update(y for _, y in picked)
        for y in n:
            size = sizes.get(y, 0)
            want = min(n[y], math.ceil(size * n[y]) if isinstance(size, float) else size)
            assert got[y] == want
            assert {k for k, l in picked if l == y} == set(_rank([k for k, l in rows if l == y], "-exact-3")[:want])
    assert sample.sample_exact_by_label(df.limit(0), spec, {0: 5, 1: 0.5}).count() == 0


def test_uncorrelated_features_are_chosen_on_the_train_rows_of_the_stored_table(spark, planted, monkeypatch):
    """One stored table serves the choice, the fit and the metrics; vectors are neither shuffled nor kept."""
    df = planted.withColumn("a", F.when(F.col("id") % 7 > 0, F.col("a")))       # correlated where both have values
    train = sample.train_test(df, SPEC)[0]
    want = models.train_report(df, collinear.without_correlated(train, SPEC, 0.8), "lr", {"maxIter": 5}).collect()
    got = models.train_report(store(df, "test"), SPEC, "lr", {"maxIter": 5}, uncorrelated=0.8, materialize="rows").collect()
    assert got == want                                      # one partition: the same rows in the same order
    monkeypatch.setattr(models, "ROWS_PER_ML_PARTITION", 100)
    source = store(df, "test")
    prep = models.prepare(source, SPEC, uncorrelated=0.8, materialize="rows")
    assert prep.spec == collinear.without_correlated(train, SPEC, 0.8)
    plan = prep.train._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan and "hashpartitioning" not in plan and "clickspark-base" in prep.train.inputFiles()[0]
    with pytest.raises(Exception):
        source.count()                                      # its files were scratch
    values = {r.metric: r.value for r in models.evaluate(models.train(prep, "lr", maxIter=5), prep.spec).collect()}
    assert values == pytest.approx({r.metric: r.value for r in want})
    with pytest.raises(ValueError):
        discard(spark.read.parquet(f"{SF_SMALL}/nation.parquet"))


def test_stored_rows_leave_no_shuffle_behind(spark):
    rows = store(spark.range(5000).repartition(7, "id").groupBy((F.col("id") % 50).alias("k")).count(), "test")
    assert rows.count() == 50 and rows.agg(F.sum("count")).first()[0] == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_stored_joins_of_lineitem_are_the_joins(spark):
    plain, stored = (lineitem_returns(spark, SF_SMALL, stored=s)[0] for s in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, stored.collect()))
    assert all("clickspark-joined" in f for f in stored.inputFiles())
