"""The Voronoi join against brute force."""

import math

import numpy as np
import pytest

from airlake.llm import knn
from airlake.llm.common import materialize

SCHEMA = "vec_id long, embedding array<float>, label int, grp int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7) for i, v in rows], SCHEMA)


def brute(rows, k=knn.TOP):
    clean = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for i, q in {(i, tuple(v)) for i, v in clean if i % 20 == 0}:
        hits = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in clean if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(hits)]
    return sorted(out)


def run(spark, rows):
    out = knn.nearest_embeddings(frame(spark, rows).repartition(3))
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, out.collect()))


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[i % 6] + spread * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
@pytest.mark.parametrize("chunks", [(512, 8192), (3, 40)])
def test_equals_brute_force(spark, monkeypatch, spread, chunks):
    monkeypatch.setattr(knn, "pivot_count", lambda *a: 5)
    monkeypatch.setattr(knn, "QUERY_CHUNK", chunks[0])
    monkeypatch.setattr(knn, "DATA_CHUNK", chunks[1])
    rows = vectors(400, 8, 1, spread)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("pivots", [None, 4])
def test_nulls_ties_copies_and_odd_vectors(spark, monkeypatch, pivots):
    if pivots:
        monkeypatch.setattr(knn, "pivot_count", lambda *a: pivots)
    same = [0.5, -0.25, 1.0]
    rows = vectors(60, 3, 2) + [(i, same) for i in range(100, 240)]
    rows += [(300, None), (301, [1.0, None, 2.0]), (302, [math.inf, 0.0, 0.0]), (303, [math.nan, 0.0, 0.0]), (None, same)]
    rows += [(304, [2.0]), (320, []), (340, [1.0, 2.0]), (400, same), (400, same), (400, [0.0, 0.0, 0.0]), (-20, same), (401, [0.0] * 3)]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_floating_point_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * 2.0**24).astype(np.float32).tolist()) for i in range(60)]
    assert run(spark, rows) == brute(rows)
    assert knn.inner_products(np.array([[2**62, 1]]), np.array([[2**62, 0], [-(2**62), 0], [3, 5]])).tolist() == [
        [2**63 - 1, -(2**63), 3 * 2**62 + 5 if 3 * 2**62 + 5 < 2**63 else 2**63 - 1]
    ]


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(20, [1.0, 2.0])], [(20, None), (21, [1.0])]])
def test_too_few_rows(spark, rows):
    assert run(spark, rows) == []


def test_groups_get_only_rows_that_they_may_need(spark, monkeypatch):
    """Tight clusters: most rows are pruned by the bounds, none that count."""
    monkeypatch.setattr(knn, "pivot_count", lambda *a: 15)
    sent = []
    route = knn._route
    monkeypatch.setattr(knn, "_route", lambda *a: sent.append(route(*a)) or sent[-1])
    rows = vectors(1200, 6, 4, 0.02)
    assert run(spark, rows) == brute(rows)
    assert sent[0].count() < 0.5 * 15 * 1200


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, q = rng.integers(-90, 90, (200, 5)), rng.integers(-90, 90, (50, 5))
    pivots = q[:4].astype(float)
    group, distance = knn.nearest(q, pivots)
    radius = np.array([distance[group == g].max(initial=0) for g in range(4)])
    lower, upper = knn.group_bounds(x, pivots, radius)
    scores = knn.inner_products(q, x)
    for i, g in enumerate(group):
        assert (scores[i] >= lower[:, g]).all() and (scores[i] <= upper[:, g]).all()


def test_summary_bounds_hold_and_exclude():
    """Bounds of whole groups of data against all products; far groups are not needed."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-900, 900, (8, 6))
    x = centres[rng.integers(0, 8, 600)] + rng.integers(-4, 5, (600, 6))
    q, pivots = x[::5], centres.astype(float)
    (group, distance), (own, away) = knn.nearest(q, pivots), knn.nearest(x, pivots)
    radius = np.array([distance[group == g].max(initial=0) for g in range(8)])
    lower, upper = knn.summary_bounds(away, own, pivots, radius)
    scores = knn.inner_products(q, x)
    for i, g in enumerate(group):
        assert (scores[i] >= lower[:, g]).all() and (scores[i] <= upper[:, g]).all()
    tops = [knn.Highest(4) for _ in range(8)]
    for j in range(8):
        tops[j].add(-away[own == j], np.flatnonzero(own == j))
    reach = np.array([away[own == j].max(initial=-1) for j in range(8)])
    theta, needed = knn.group_plan(pivots, radius, reach, tops, 3)
    assert needed.sum() < 32
    for i, g in enumerate(group):
        third = np.sort(scores[i])[-4:]
        assert theta[g] <= third[0]
        assert set(own[np.argsort(scores[i])[-4:]]) <= set(np.flatnonzero(needed[:, g]))


def test_the_registered_path_groups_both_sides_and_routes_by_bounds(spark, monkeypatch):
    from airlake.llm import queries

    seen = []
    route = knn._route
    monkeypatch.setattr(knn, "_route", lambda *a: seen.append(a) or route(*a))
    queries.q_topk(spark, "/root/testdata/sf0.001").count()
    data, pivots, radius, theta, needed, _ = seen[0]
    assert len(pivots) >= knn.MIN_PIVOTS and needed.shape == (len(pivots), len(pivots))
    assert data.select("grp").distinct().count() > 1 and np.isfinite(theta).any()


def test_materialised_inputs_are_enough(spark):
    rows = materialize(knn.quantised(frame(spark, vectors(50, 4, 6))), "knn-test")
    got = knn.top_k(rows.where("vec_id = 7"), rows, 3).collect()
    assert [r.rank for r in sorted(got)] == [1, 2, 3]


def test_rows_that_repeat_the_querys_id_do_not_raise_the_threshold(spark, monkeypatch):
    """Forty rows of the query's own id outscore all others."""
    monkeypatch.setattr(knn, "pivot_count", lambda *a: 2)
    rows = [(20, [9.0, 0.0])] * 40 + [(40, [0.0, 9.0])] + [(100 + i, [0.01 * i, 0.0]) for i in range(1, 19)] + vectors(30, 2, 8, 0.1)
    assert run(spark, rows) == brute(rows)


def test_pivots_are_many_where_bounds_exclude_and_few_where_they_cannot():
    rng = np.random.default_rng(7)
    centres = rng.integers(-2000, 2000, (16, 8))
    tight = (centres[rng.integers(0, 16, 2000)] + rng.integers(-5, 6, (2000, 8))).astype(np.int64)
    loose = rng.integers(-64, 64, (2000, 32))
    assert knn.pivot_count(tight[:500], tight, 100_000, 10**6, 20) > 4
    assert knn.pivot_count(loose[:500], loose, 2000, 40_000, 20) == knn.MIN_PIVOTS
