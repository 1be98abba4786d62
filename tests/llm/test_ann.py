import math
from collections import defaultdict

import numpy as np
import pytest
from clickspark.llm import ann
from clickspark.llm.queries import QUERIES
from llm_data import SF_SMALL


def brute(rows, asked, k):
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in asked:
        if (q, v) in rows:
            scored = sorted((-float(np.dot(np.array(v, float), np.array(x, float))), i) for i, x in rows if i != q)
            out[q] = [(round(-s, 9), i) for s, i in scored[:k]]
    return {q: x for q, x in out.items() if x}


def run(vectors, queries, k, **more):
    out = defaultdict(list)
    for r in ann.nearest(vectors, queries, k, **more).orderBy("query_id", "rank").collect():
        out[r.query_id].append((round(r.score, 9), r.vec_id))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "'x' as id", "'x' as code", "1 as n", "'x' as v", "'x' as cell", "2 as score", "3 as rank") if extra else df


def asked_of(df, condition):
    return df.where(condition).withColumnRenamed("vec_id", "query_id")


def test_thresholds_cover_every_code_within_the_radius():
    for radius in range(65):
        assert sum(t + 1 for t in ann.thresholds(radius)) == radius + 1     # more differing bits than that fit nowhere


def test_rounds_probe_every_mask_within_the_limits_once():
    for prefix in (0, 1, 5, 12):
        for limits in ([-1, 0, 2, 16], [3, 3, 2, 2], [16, -1, -1, -1]):
            rounds = ann._rounds(prefix, limits)
            for t, limit in enumerate(limits):
                masks = [m for r in rounds for m in r[t]]
                assert sorted(masks) == [m for m in range(1 << prefix) if m.bit_count() <= limit]
            sizes = np.cumsum([max(map(len, r)) for r in rounds])
            assert rounds[0][limits.index(max(limits))] == [0] and all(b <= max(ann.GROWTH, prefix + 1) * a for a, b in zip(sizes, sizes[1:]))


@pytest.mark.parametrize("radius", [0, 3, 12, 24])
def test_probing_finds_every_code_within_the_radius_once(spark, monkeypatch, radius):
    monkeypatch.setattr(ann, "CELL_ROWS", 50)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.int64)
    codes = [int(c) ^ int(sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 20), replace=False))) for c in rng.choice(centres, 600)]
    rows = spark.createDataFrame([(i, c, [float(i)], i) for i, c in enumerate(codes)], "id long, code long, v array<double>, n long")
    got = ann._retrieve(rows, rows.where("id % 6 = 0"), len(codes), radius, 10_000, 1).select("q", "id").collect()
    want = {(q, i) for q in range(0, 600, 6) for i in range(600) if i != q and (codes[q] ^ codes[i]).bit_count() <= radius}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_recall_of_the_query(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = defaultdict(list)
    for r in QUERIES["op13_nearest_neighbours"](spark, SF_SMALL).collect():
        got[r.query_id].append((round(r.score, 9), r.vec_id))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [(i, v) for i, v in rows if i % 20 == 0], 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    scores = dict(rows)
    for q, found in got.items():
        assert all(abs(s - float(np.dot(np.array(scores[q], float), np.array(scores[i], float)))) < 1e-8 for s, i in found)
    assert np.mean([len(set(want[q]) & set(got[q])) / 20 for q in want]) >= 0.9


def test_lengths_matter_and_copies_stay(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 64)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(900, 24)) * rng.uniform(0.2, 4, size=(900, 1)) + 0.5
    rows = [(i, [float(np.float32(x)) for x in (base[i] if i % 3 else base[0])]) for i in range(900)]
    df = frame(spark, rows)
    got, want = run(df, asked_of(df, "vec_id % 30 = 0"), 20), brute(rows, [r for r in rows if r[0] % 30 == 0], 20)
    assert set(got) == set(want)
    assert np.mean([len(set(want[q]) & set(got[q])) / 20 for q in want]) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),
            (8, [1.0, 2.0]), (9, [-(2.0 ** 127), 2.0]), (10, [0.5, 0.5]), (None, [1.0, 1.0]), (11, [1.0, 2.0, 3.0])]
    df = frame(spark, rows)
    two = [r for r in rows if r[1] is None or len(r[1]) == 2]
    got = run(df, asked_of(df, "true"), 20)
    assert got == brute(two, two, 20)
    assert [i for _, i in got[10]] == [7, 7, 8, 9]          # ties to the smaller id, repeated rows each
    assert run(df.limit(0), asked_of(df, "true"), 20) == {} and run(df, asked_of(df, "false"), 20) == {}
    assert run(df.where("vec_id < 7"), asked_of(df, "true"), 20) == {}


def test_fewer_candidates_than_asked_for(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(15)]
    df = frame(spark, rows)
    assert run(df, asked_of(df, "vec_id < 3"), 20) == brute(rows, rows[:3], 20)
