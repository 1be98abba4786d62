"""Stored sketches, and the search that resumes."""

import random
import statistics

import pytest
from clickspark.operators import models, sketches, tuning
from clickspark.plans.featuresets import events_clicks
from clickspark.spec import FeatureSpec
from conftest import SF_SMALL
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = [(i, f"d{i % 5}", rng.choice([None, float("nan"), -0.0, 0.0, rng.gauss(0, 1)]), float(i % 700), f"s{rng.randrange(3000)}" if i % 9 else None)
           for i in range(20_000)]
    return spark.createDataFrame(out, "id long, day string, a double, b double, s string")


def _exact(values):
    values = [v for v in values if v is not None and v == v]
    return len(values), len({v + 0.0 if isinstance(v, float) else v for v in values}), sorted(values)


def test_merged_states_equal_those_of_one_pass_within_their_bounds(spark, rows, tmp_path):
    path = str(tmp_path / "states")
    for days in (["d0", "d1"], ["d1", "d2", "d3"], ["d0", "d1", "d2", "d3", "d4"], ["d4"]):     # each part is sketched once
        states = sketches.update_states(rows.where(F.col("day").isin(days)), path, F.col("day"), ["a", "b"], ["s"])
    assert states.count() == 15
    parts = {r.feature: r for r in sketches.profile_states(sketches.merge_states(states), (0.1, 0.5, 0.9)).collect()}
    once = {r.feature: r for r in sketches.profile_states(sketches.merge_states(
        sketches.sketch_states(rows, F.lit("all"), ["a", "b"], ["s"])), (0.1, 0.5, 0.9)).collect()}
    data = rows.collect()
    for f in ("a", "b", "s"):
        n, distinct, ordered = _exact([r[f] for r in data])
        for p, k in ((parts[f], 5), (once[f], 1)):
            assert (p.parts, p.n, p.n_null) == (k, n, len(data) - n)
            assert abs(p.n_distinct - distinct) <= 0.065 * distinct + 1
            if f == "s":
                assert p.min_value is None and p.quantiles is None
                continue
            assert (p.min_value, p.max_value) == (ordered[0], ordered[-1])
            for prob, q in zip((0.1, 0.5, 0.9), p.quantiles):
                below, up_to = sum(x < q for x in ordered) / n, sum(x <= q for x in ordered) / n
                assert below - 0.02 <= prob <= up_to + 0.02


def test_any_order_of_merging_stays_within_the_bound(spark, rows):
    states = sketches.sketch_states(rows, F.col("day"), ["b"], ["s"])
    halves = states.groupBy("feature", (F.col("part") < "d3").alias("h")).agg(F.hll_union_agg("distinct_state").alias("distinct_state"))
    exact = {"b": 700, "s": rows.select("s").dropna().distinct().count()}
    for df in (states, halves):
        for r in df.groupBy("feature").agg(F.hll_sketch_estimate(F.hll_union_agg("distinct_state")).alias("e")).collect():
            assert abs(r.e - exact[r.feature]) <= 0.065 * exact[r.feature]


def test_states_of_odd_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, None, None), (None, float("nan"), "x"), ("d", 1.0, None)], "day string, a double, s string")
    got = {r.feature: r for r in sketches.profile_states(sketches.merge_states(
        sketches.update_states(df, str(tmp_path / "x"), F.col("day"), ["a"], ["s"]))).collect()}
    assert (got["a"].n, got["a"].n_null, got["a"].parts, got["a"].quantiles) == (1, 2, 2, [1.0, 1.0, 1.0])
    assert (got["s"].n, got["s"].n_null, got["s"].n_distinct) == (1, 2, 1)
    assert sketches.update_states(df.limit(0), str(tmp_path / "none"), F.col("day"), ["a"]).count() == 0
    alone = sketches.profile_states(sketches.merge_states(sketches.sketch_states(df.where("day is null"), F.col("day"), ["a"]))).first()
    assert (alone.n, alone.n_distinct, alone.min_value, alone.quantiles) == (0, 0, None, None)


@pytest.fixture(scope="module")
def small(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    return df, FeatureSpec(spec.key, spec.label, ("value", "hour"))


def test_an_interrupted_search_ends_with_the_same_result(spark, small, tmp_path, monkeypatch):
    df, spec = small
    grid = {"regParam": [0.0, 0.2], "maxIter": [3, 6]}
    whole = tuning.resumable_search(df, spec, "lr", str(tmp_path / "whole"), grid, folds=2).collect()
    fits, path = [], str(tmp_path / "cut")
    make = tuning.make_classifier

    def failing(kind, **more):
        est = make(kind, **more)
        copy = type(est).copy

        class Counted(type(est)):
            def copy(self, extra=None):
                out = copy(self, extra)
                if extra is not None and len(fits) >= limit:
                    raise RuntimeError("executor lost")
                fits.append(extra)
                return out
        est.__class__ = Counted
        return est

    monkeypatch.setattr(tuning, "make_classifier", failing)
    limit = 3
    with pytest.raises(RuntimeError):
        tuning.resumable_search(df, spec, "lr", path, grid, folds=2, parallelism=1)
    assert len(fits) == 3
    limit = 100
    again = tuning.resumable_search(df, spec, "lr", path, grid, folds=2, parallelism=1).collect()
    assert sorted(again) == sorted(whole)
    assert len(fits) == 8 + 1                               # every fold of every point once, and the best point
    tuning.resumable_search(df, spec, "lr", path, grid, folds=2)
    assert len(fits) == 8 + 2
    tuning.resumable_search(df, spec, "lr", path, {"regParam": [0.0], "maxIter": [3]}, folds=2, seed=1)
    assert len(fits) == 8 + 2 + 3                           # other settings, other fits


def test_search_reports_what_the_cross_validator_finds(spark, small, tmp_path):
    df, spec = small
    grid = {"regParam": [0.0, 0.3]}
    ours = {(r.kind, r.name): r.value for r in tuning.resumable_search(df, spec, "lr", str(tmp_path / "s"), grid).collect()}
    theirs = {(r.kind, r.name): r.value for r in tuning.tune(df, spec, "lr", grid).collect()}
    for k, v in theirs.items():
        assert ours[k] == pytest.approx(v, abs=1e-6)
    stored = spark.read.parquet(str(tmp_path / "s")).collect()
    for point in ("regParam=0.0", "regParam=0.3"):
        assert ours["cv_spread", point] == pytest.approx(statistics.pstdev(r.auc for r in stored if r.point == point))


@pytest.mark.parametrize("kind", ["lr", "lsvc"])
def test_reports_say_how_many_iterations_were_made(spark, small, kind):
    df, spec = small
    prep = models.prepare(df, spec)
    try:
        report = {r.metric: r.value for r in models.evaluate(models.train(prep, kind, maxIter=3), spec).collect()}
        assert 0 < report["iterations_train"] <= 3
    finally:
        prep.unpersist()
