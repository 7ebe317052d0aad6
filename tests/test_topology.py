"""Thinning with common borders: invariants on hand-made and sampled layers."""

import math
import random

import numpy as np
import pytest

from equisite.operators import topology as tp

SCHEMA = "shape_id int, parts array<array<array<array<double>>>>"


def _layer(spark, shapes):
    return spark.createDataFrame([(k, v) for k, v in shapes.items()], SCHEMA)


def _thin(spark, shapes, tolerance):
    return {r["shape_id"]: r["parts"] for r in tp.simplified(_layer(spark, shapes), tolerance).collect()}


def _edges(ring):
    return {frozenset((tuple(a), tuple(b))) for a, b in zip(ring, ring[1:])}


def _apart(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    n = dx * dx + dy * dy
    t = 0.0 if n == 0 else min(max(((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / n, 0.0), 1.0)
    return math.dist(p, (a[0] + t * dx, a[1] + t * dy))


def _wave(a, b, seed, steps=30):
    """A jagged line from a to b, the same for both sides of a border."""
    rng = random.Random(seed)
    points = [[a[0] + (b[0] - a[0]) * k / steps, a[1] + (b[1] - a[1]) * k / steps] for k in range(steps + 1)]
    return [p if k in (0, steps) else [p[0] + rng.uniform(-.01, .01), p[1] + rng.uniform(-.01, .01)] for k, p in enumerate(points)]


def _mosaic(n):
    def border(a, b):
        low, high = min(a, b), max(a, b)
        line = _wave(low, high, str((low, high)))
        return line if a == low else line[::-1]
    shapes = {}
    for i in range(n):
        for j in range(n):
            corners = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)]
            ring = [p for a, b in zip(corners, corners[1:]) for p in border(a, b)[:-1]]
            start = (7 * i + 3 * j) % len(ring)  # rings start anywhere
            ring = ring[start:] + ring[:start]
            shapes[i * n + j] = [[ring + ring[:1]]]
    return shapes


@pytest.mark.parametrize("tolerance", [0.0, 0.004, 0.05, 5.0])
def test_neighbours_keep_their_border(spark, tolerance):
    shapes = _mosaic(4)
    thin = _thin(spark, shapes, tolerance)
    uses = {}
    for parts in thin.values():
        for e in _edges(parts[0][0]):
            uses[e] = uses.get(e, 0) + 1
    assert max(uses.values()) == 2
    # what is used once is the outer border, and it closes: every vertex of it has two such edges
    ends = {}
    for e in (e for e, n in uses.items() if n == 1):
        for p in e:
            ends[p] = ends.get(p, 0) + 1
    assert set(ends.values()) == {2}
    assert all(min(p[0], p[1], 4 - p[0], 4 - p[1]) < 0.02 for p in ends)
    for k, parts in thin.items():
        ring, whole = parts[0][0], shapes[k][0][0]
        assert ring[0] == ring[-1] and len(ring) >= 4
        assert {tuple(p) for p in ring} <= {tuple(p) for p in whole}
        assert max(min(_apart(p, a, b) for a, b in zip(ring, ring[1:])) for p in whole) <= max(tolerance, 1e-12)
    if tolerance == 0.05:
        assert sum(len(p[0][0]) for p in thin.values()) < 0.2 * sum(len(p[0][0]) for p in shapes.values())


def test_an_island_fits_its_hole(spark):
    angles = np.linspace(0, 2 * math.pi, 60, endpoint=False)
    island = [[math.cos(a) * (1 + .01 * (k % 3)), math.sin(a)] for k, a in enumerate(angles)]
    hole = island[17:] + island[:17]
    hole = hole[::-1]  # another start, the other way round
    sea = [[-5., -5.], [5., -5.], [5., 5.], [-5., 5.], [-5., -5.]]
    thin = _thin(spark, {1: [[island + island[:1]]], 2: [[sea, hole + hole[:1]]]}, 0.1)
    assert _edges(thin[1][0][0]) == _edges(thin[2][0][1])
    assert 4 <= len(thin[1][0][0]) - 1 < 60
    assert len(thin[2][0][0]) == 5


def test_rings_that_cannot_be_thinned_stay(spark):
    triangle = [[0., 0.], [1., 0.], [0., 1.], [0., 0.]]
    line = [[0., 0.], [1., 1.], [2., 0.], [3., 3.]]
    gap = [[0., 0.], [1., 0.], [None, 1.], [0., 0.]]
    lens = [[0., 0.], [1., .001], [2., 0.], [1., -.001], [0., 0.]]
    shapes = {1: [[triangle]], 2: [[line]], 3: [[gap]], 4: [[[]], [triangle]], 5: [[lens]], 6: [[triangle]]}
    thin = _thin(spark, shapes, 10.0)
    assert sorted(thin) == [1, 2, 3, 4, 5, 6]
    assert thin[1] == thin[6] and len(thin[1][0][0]) == 4  # equal rings are thinned equally
    assert thin[2] == [[line]]
    assert thin[3] == [[gap]]
    assert thin[4][0] == [[]] and len(thin[4][1][0]) == 4
    assert len(thin[5][0][0]) == 5  # two arcs keep a vertex each


def test_empty_layer(spark):
    assert _thin(spark, {}, 1.0) == {}


def test_long_arc_within_seconds(spark):
    n = 200_000
    x = np.arange(n + 1, dtype=float)
    kept = tp.arc_kept(x, np.sin(x / 500), 0.01)
    assert kept[0] and kept[-1] and kept.sum() < n / 10


def test_junctions_are_found_by_numbers_alone(spark):
    """Extremes of single coordinates need no sort; crossed neighbours whose coordinates pair up otherwise still differ."""
    rows = [(1.0, 1.0, [0.0, 5.0], [2.0, 1.0]), (1.0, 1.0, [0.0, 1.0], [2.0, 5.0]), (3.0, 3.0, [0.0, 5.0], [2.0, 1.0]), (3.0, 3.0, [0.0, 5.0], [2.0, 1.0]),
            (4.0, 4.0, [0.0, 0.0], [0.0, 0.0]), (5.0, 5.0, [0.0, 5.0, 1.0], [2.0, 1.0, 1.0]), (5.0, 5.0, [0.0, 5.0, 2.0], [2.0, 1.0, 1.0])]
    found = tp.junctions(spark.createDataFrame(rows, "x double, y double, low array<double>, high array<double>"))
    assert sorted(r["x"] for r in found.collect()) == [1.0, 4.0, 5.0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_short_arcs_are_thinned_alike_by_numbers_and_arrays(monkeypatch):
    rng = np.random.default_rng(5)
    arcs = [rng.integers(-9, 9, (2, rng.integers(2, 40))).astype(float) for _ in range(400)] + [rng.normal(size=(2, 30)) for _ in range(200)]
    arcs += [np.concatenate([a, a[:, :1]], axis=1) for a in arcs[:200]]
    few = [tp.arc_kept(*a, t) for a in arcs for t in (0.1, 2.0)]
    monkeypatch.setattr(tp, "FEW", 0)
    assert all((a == b).all() for a, b in zip(few, [tp.arc_kept(*a, t) for a in arcs for t in (0.1, 2.0)], strict=True))
