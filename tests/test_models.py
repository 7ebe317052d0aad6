"""Index, sensitivity, geometry and the residual model: invariants and brute force."""

import itertools
import math
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from equisite.operators import geo
from equisite.operators import index as ix
from equisite.operators import residual as rs
from equisite.operators import sensitivity as sn
from fixtures import FEATURES, IDS, Residual, domain
from suite import residual_queries as rq
from suite import sensitivity_queries as sq


def test_renormalisation_over_present_indicators(spark):
    wide = spark.createDataFrame([(1, 900, 500, None), (2, 900, 500, 100)], "unit_id long, p1 long, p2 long, p3 long")
    w = spark.createDataFrame([("e", i, 1) for i in (1, 2, 3)], "scheme string, indicator_id int, w_ppm long")
    got = {r["unit_id"]: r for r in ix.need_by_vector(wide, ix.weights_wide(w, [1, 2, 3]), [1, 2, 3]).collect()}
    assert got[1]["need_e9"] == 700 and got[2]["need_e9"] == 500 and got[1]["indicators_present"] == 2


def test_zero_rural_population_has_need_but_no_score(spark):
    need = spark.createDataFrame([(1, "s", 7, 500), (2, "s", 7, 500), (3, "s", 4, 900)],
                                 "unit_id long, scheme string, indicators_present long, need_e9 long")
    units = spark.createDataFrame([(1, 0, 100), (2, 50, 100), (3, 50, 100)], "unit_id long, rural_population long, catchment_norm long")
    assert [r["unit_id"] for r in ix.district_score(need, units).collect()] == [2]


def test_percentiles_span_the_scale(spark, small):
    spans = domain(spark, small).percentile.groupBy("indicator_id").agg(F.min("pct_e9").alias("lo"), F.max("pct_e9").alias("hi")).collect()
    assert len(spans) == 7 and all(s["lo"] == 0 and s["hi"] <= 10 ** 9 for s in spans)


def test_supply_ratio_cancels(spark, small):
    score = domain(spark, small).score
    assert ix.supply_degeneracy(score).filter("NOT cancels OR ratio_bp < 9000").count() == 0
    wrong = score.withColumn("at_risk", F.col("at_risk") + 2)  # the stored people at risk decide
    assert ix.supply_degeneracy(wrong).filter("cancels").count() == 0


def test_rank_and_picks_of_a_draw(spark):
    rows = [(1, 100, "g", "z", 10, 10), (2, 900, "g", "z", 10, 10), (3, 500, "h", "z", 10, 10), (4, 500, "h", "z", 10, 10)]
    base = spark.createDataFrame(rows, "unit_id long, p1 long, grp string, zone string, catchment_norm long, rural_population long")
    draws = spark.createDataFrame([(0, 1_000_000)], "draw long, w1 long")
    dealt = sn.dealt_by_draw(base, draws, [1])
    assert {r["unit_id"]: r["rank"] for r in sn.ranked_by_draw(dealt).collect()} == {1: 4, 2: 1, 3: 2, 4: 3}
    assert {r["unit_id"] for r in sn.picked_by_draw(dealt, base, 2, 1, 1).collect()} == {2, 3}


def test_sensitivity_identities(spark, small):
    d = domain(spark, small)
    for r in sq.sensitivity(d, 41).groupBy("regime").agg(
            F.sum("times_in_top_n").alias("top"), F.max("draws").alias("draws"), F.sum("times_allocated").alias("alloc"),
            F.max("runs").alias("runs"), F.count_if((F.col("p05_need_e6") * 1000 > F.col("mean_need_e9") + 1000) | (F.col("mean_need_e9") > F.col("p95_need_e6") * 1000 + 1000)).alias("off")).collect():
        assert r["top"] == 25 * r["draws"] and r["alloc"] == 25 * r["runs"]


def test_gamma_draws_match_the_distribution(spark):
    alphas = [7.142857] * 6 + [7.142858]
    ids = spark.range(4000).withColumnRenamed("id", "draw")
    frac = sn.gamma_draws(ids, IDS, alphas, 1).toPandas()
    again = sn.gamma_draws(ids.repartition(3), IDS, alphas, 1).orderBy("draw").toPandas()
    assert frac.sort_values("draw").reset_index(drop=True).equals(again)
    share = frac[[f"w{i}" for i in IDS]].to_numpy() / 1e6
    assert np.allclose(share.mean(0), 1 / 7, atol=0.004)
    assert np.allclose(share.var(0), (1 / 7) * (6 / 7) / 51, rtol=0.12)


def test_gamma_draws_below_one(spark):
    """Parameters below 1 take the boosted path; Dirichlet means and variances."""
    alphas = [0.3, 0.6, 1.0, 1.4, 2.2, 5.5, 9.0]
    out = sn.gamma_draws(spark.range(6000).withColumnRenamed("id", "draw"), IDS, alphas, 3)
    assert "Python" not in out._jdf.queryExecution().toString()
    share = out.toPandas()[[f"w{i}" for i in IDS]].to_numpy() / 1e6
    mean = np.array(alphas) / sum(alphas)
    assert np.allclose(share.mean(0), mean, atol=0.006)
    assert np.allclose(share.var(0), mean * (1 - mean) / (sum(alphas) + 1), rtol=0.15)
    with pytest.raises(ValueError):
        sn.gamma_draws(spark.range(1).withColumnRenamed("id", "draw"), IDS, [0.0] * 7, 3)


def test_ridge_of_a_constant_feature_and_a_missing_fold(spark):
    rng = np.random.default_rng(2)
    x = rng.random((40, 2))
    rows = [(i, i % 4, float(x[i, 0] + 2 * x[i, 1]), *map(float, x[i]), 7.0) for i in range(40)]  # fold 4 has no row
    frame = spark.createDataFrame(rows, "unit_id long, fold int, y double, a double, b double, c double")
    models = {m["split"]: m for m in rs.ridge_models(frame, ["a", "b", "c"], penalties=[1e-6]).collect()}
    assert sorted(models) == [0, 1, 2, 3, 4]
    assert all(np.allclose(m["weights"], [1, 2, 0], atol=1e-4) for m in models.values())
    assert rs.ridge_predictions(frame, ["a", "b", "c"]).count() == 40


def test_infeasible_draws_are_not_runs(spark, small):
    d = domain(spark, small)
    b = sq.base(d)
    picks = sn.picked_by_draw(sn.dealt_by_draw(b, sq.draws(d, "uniform", 5), IDS), b, 40, 1, 1)
    assert {(r["runs"], r["times_allocated"], r["classification"]) for r in sn.alloc_stability(b, picks).collect()} == {(0, 0, "excluded")}


def test_sampled_draws_are_fixed(spark, small):
    draws = sq.draws(domain(spark, small), "uniform", 50)
    a, b = ({r["draw"] for r in sn.sample_draws(draws, 10, 3).collect()} for _ in range(2))
    assert a == b and len(a) == 10


L_SHAPE = [[0.0, 0.0], [2.0, 0.0], [2.0, 0.4], [0.4, 0.4], [0.4, 2.0], [0.0, 2.0], [0.0, 0.0]]
RING = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0], [1.0, 1.0]]
PARTS = "array<array<array<array<double>>>>"


def test_interior_points_lie_inside(spark):
    shapes = spark.createDataFrame([(1, [[L_SHAPE]]), (2, [[RING, HOLE]])], f"shape_id long, parts {PARTS}")
    points = geo.interior_point(shapes)
    assert {r[0] for r in points.select(geo.contains("edges", F.col("px"), F.col("py"))).collect()} == {True}


def test_point_in_polygon_first_match_and_hole(spark):
    polys = spark.createDataFrame([(1, "ring", [[RING, HOLE]]), (2, "whole", [[RING]])], f"ordinal int, name string, parts {PARTS}")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 9.0, 9.0)], "id long, px double, py double")
    got = {r["id"]: r["name"] for r in geo.spatial_join(pts, polys, "id", "name").collect()}
    assert got == {1: "ring", 2: "whole", 3: None}


def square(x, y, h):
    return [[x - h, y - h], [x + h, y - h], [x + h, y + h], [x - h, y + h], [x - h, y - h]]


def star(x, y, points, outer, inner, turn, closed=True):
    ring = [[x + (outer if k % 2 else inner) * math.cos(turn + math.pi * k / points), y + (outer if k % 2 else inner) * math.sin(turn + math.pi * k / points)]
            for k in range(2 * points)]
    return ring + ring[:1] if closed else ring


@pytest.mark.parametrize("rows", [200_000, 10])
def test_cells_decide_as_all_edges_do(spark, monkeypatch, rows):
    monkeypatch.setattr(geo, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(geo, "BUSY_POINTS", 50)
    rng = random.Random(2)
    shapes = [(1, [[star(0.0, 0.0, 200, 3.0, 1.0, 0.1), star(0.0, 0.0, 40, 0.8, 0.6, 0.0)]]), (2, [[star(1.0, 1.0, 5, 2.0, 0.3, 0.4, closed=False)]]),
              (3, [[star(-2.0, 1.5, 300, 0.9, 0.85, 0.0)], [star(2.0, -1.5, 3, 0.9, 0.4, 1.0)]]), (4, [[[[0.0, 0.0], [0.0, 0.0]]]]), (5, [[[]]]),
              (6, [[[[-4.0, -4.0], [4.0, -4.0], [4.0, 0.5], [-4.0, 0.5], [-4.0, -4.0]]]])]
    rings = {k: [r for part in parts for r in part] for k, parts in shapes}
    points = [(i, rng.uniform(-4, 4), rng.uniform(-4, 4)) for i in range(3000)]
    points += [(3000 + i, *p) for i, p in enumerate(rng.sample([p for r in rings.values() for x in r for p in x], 300))]
    points += [(4000 + i, rng.uniform(0.0, 0.2), 0.05) for i in range(1500)]  # a third of all in one cell
    points += [(6000 + i, x / 4, y / 4) for i, (x, y) in enumerate(itertools.product(range(-16, 17), range(-16, 17)))]

    def inside(x, y, own):
        return sum((a[1] <= y) != (b[1] <= y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for r in own for a, b in zip(r, r[1:])) % 2

    want = {i: next((k for k in sorted(rings) if inside(x, y, rings[k])), None) for i, x, y in points}
    polys = spark.createDataFrame([(k, k, parts) for k, parts in shapes], f"ordinal int, found int, parts {PARTS}")
    table = spark.createDataFrame(points, "id long, px double, py double").repartition(4)
    assert {r["id"]: r["found"] for r in geo.spatial_join(table, polys, "id", "found").collect()} == want
    cells = geo.polygon_cells(polys.select("ordinal", "parts")).filter("ordinal = 3")
    assert cells.filter("size(near) = 0 AND base = 1").count() > 0 and cells.agg(F.max(F.size("near"))).head()[0] < 100


def test_layer_of_very_different_sizes(spark):
    layer = [(1, "country", [[square(0.0, 0.0, 500.0)]])] + [(2 + i, f"house {i}", [[square(float(i), 0.25, 0.01)]]) for i in range(50)]
    polys = spark.createDataFrame(layer, f"ordinal int, name string, parts {PARTS}").withColumn("ordinal", -F.col("ordinal"))
    points = [(i, float(i), 0.25) for i in range(60)] + [(100, 900.0, 0.0), (101, None, None)]
    got = {r["id"]: r["name"] for r in geo.spatial_join(spark.createDataFrame(points, "id long, px double, py double"), polys, "id", "name").collect()}
    assert got == {i: f"house {i}" if i < 50 else "country" for i in range(60)} | {100: None, 101: None}


def test_parts_apart_and_collapsed_rings(spark):
    apart = [[square(0.0, 0.5, 0.5)], [square(5.0, 3.5, 0.5)]]
    dented = [[square(0.0, 0.0, 1.0), square(0.2, 0.2, 0.001), [[0.5, 0.5]]]]
    tiny = [[square(3.0, 3.0, 0.0001)]]
    shapes = spark.createDataFrame([(1, apart), (2, dented), (3, tiny)], f"shape_id long, parts {PARTS}")
    inside = geo.interior_point(shapes).select("shape_id", geo.contains("edges", F.col("px"), F.col("py")).alias("ok")).collect()
    assert {r["shape_id"]: r["ok"] for r in inside} == {1: True, 2: True, 3: True}
    rings = {r["shape_id"]: [[len(x) for x in part] for part in r["parts"]] for r in geo.thinned(shapes).collect()}
    assert rings == {1: [[5], [5]], 2: [[5]], 3: [[5]]}
    assert geo.interior_point(geo.thinned(shapes)).filter("px IS NULL").count() == 0


def test_shared_unit_stops(spark):
    with pytest.raises(ValueError):
        geo.require_one_to_one(spark.createDataFrame([(2,)], "shared_ids long"))


def _plain_ridge(x, y, penalty):
    mean, sd, my = x.mean(0), x.std(0), y.mean()
    z = (x - mean) / sd
    w = np.linalg.solve(z.T @ z + penalty * np.eye(x.shape[1]), z.T @ (y - my)) / sd
    return my - w @ mean, w


def test_ridge_equals_refitting_without_each_row(spark):
    rng = np.random.default_rng(5)
    x = rng.random((60, 3))
    y = x @ [0.5, -0.2, 0.0] + 0.05 * rng.standard_normal(60)
    rows = [(i, i % 5, float(y[i]), *map(float, x[i])) for i in range(60)]
    frame = spark.createDataFrame(rows, "unit_id long, fold int, y double, a double, b double, c double")
    penalties = [0.01, 1.0, 30.0]
    for m in rs.ridge_models(frame, ["a", "b", "c"], penalties=penalties).collect():
        train = np.arange(60) % 5 != m["split"]
        xt, yt = x[train], y[train]
        mean, sd = xt.mean(0), xt.std(0)
        errors = []
        for p in penalties:
            z, total = (xt - mean) / sd, 0.0
            for i in range(len(yt)):
                keep = np.arange(len(yt)) != i
                zm, ym = z[keep].mean(0), yt[keep].mean()
                w = np.linalg.solve((z[keep] - zm).T @ (z[keep] - zm) + p * np.eye(3), (z[keep] - zm).T @ (yt[keep] - ym))
                total += (yt[i] - ym - (z[i] - zm) @ w) ** 2
            errors.append(total)
        best = penalties[int(np.argmin(errors))]
        assert m["penalty"] == best
        intercept, w = _plain_ridge(xt, yt, best)
        assert np.allclose(m["weights"], w) and np.isclose(m["intercept"], intercept)


def test_residual_identities(spark, small):
    d = domain(spark, small)
    folded = Residual(d).folded
    sizes = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    pred = rs.ridge_predictions(folded, list(FEATURES)).drop("penalty")
    resid = rs.residuals(pred, d.default_score.limit(3)).persist()
    assert resid.count() == folded.count() and resid.filter("allocated").count() == 3
    z = resid.agg(F.avg("residual_z"), F.stddev_samp("residual_z")).head()
    assert abs(z[0]) < 1e-9 and abs(z[1] - 1) < 1e-9
    assert resid.filter(F.abs(F.col("y") - F.col("predicted") - F.col("residual")) > 1e-12).count() == 0


def test_folds_do_not_depend_on_the_partitions(spark, small):
    frame = Residual(domain(spark, small)).frame
    a = sorted(map(tuple, rs.assign_folds(frame, 42).select("unit_id", "fold").collect()))
    b = sorted(map(tuple, rs.assign_folds(frame.repartition(5), 42).select("unit_id", "fold").collect()))
    assert a == b


def test_missing_feature_column_fails(spark):
    with pytest.raises(KeyError):
        rs.share_features(spark.range(1), {"x": ("nope", "id")})


def test_forest_learns_a_target_it_was_not_shown(spark):
    """A curved target with noise of a quarter of its spread: a good forest explains most of it, not all."""
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, (400, 3))
    y = np.sin(6 * x[:, 0]) + (x[:, 1] > 0.5) + rng.normal(0, 0.4, 400)
    frame = spark.createDataFrame([(i, i % 3, float(t), *map(float, row)) for i, (t, row) in enumerate(zip(y, x))],
                                  "unit_id long, fold int, y double, a double, b double, c double").coalesce(1).persist()
    models = rs.forest_models(frame, ["a", "b", "c"], folds=3, trees=40)
    assert len(models.subModels) == 3 and models.bestModel.stages[-1].getNumTrees == 40
    out = rs.forest_predictions(frame, models)
    scores = [r["r2"] for r in rs.fold_metrics(out).collect()]
    assert out.count() == 400 and all(0.5 < r < 0.9 for r in scores)
    shares = {r["feature"]: r["importance"] for r in rs.feature_importance(frame, ["a", "b", "c"], models).collect()}
    assert shares["a"] > shares["b"] > shares["c"]


def test_sketched_bands_are_near_the_exact_ones(spark):
    rng = np.random.default_rng(4)
    values = {u: np.sort(rng.normal(5e8, 1e7 * (u + 1), 4000).astype("int64")) for u in range(5)}
    values[5] = np.full(300, 7)  # all draws the same
    rows = [(u, int(v)) for u, vs in values.items() for v in vs]
    need = spark.createDataFrame(rows, "unit_id int, need_e9 long").repartition(16)  # a unit's draws on many tasks
    out = {r["unit_id"]: r for r in sn.need_band_sketch(need).collect()}
    assert sorted(out) == list(range(6))
    for u, vs in values.items():
        assert out[u]["draws"] == len(vs) and out[u]["mean_need_e9"] == int(vs.sum()) // len(vs)
        for c, q in (("p05_need_e9", 0.05), ("p95_need_e9", 0.95)):
            under, upto = np.mean(vs < out[u][c]), np.mean(vs <= out[u][c])
            assert under <= q + sn.SKETCH_ERROR and upto >= q - sn.SKETCH_ERROR


def test_sketched_bands_of_many_units_spill_nothing(spark, monkeypatch):
    """Units beyond Spark's own bound of groups keep their sketches; units come once or twice, one has no number."""
    rows = [(u, int(u * 7919 % 1000) * 10 ** 6, int(u * 31 % 977) * 10 ** 6) for u in [*range(900), 3, 3, 5]] + [(None, 1, 2)]
    base = spark.createDataFrame(rows, "unit_id long, p1 long, p2 long")
    draws = spark.range(50).selectExpr("id AS draw", "1000 + id AS w1", "999 - id AS w2")
    monkeypatch.setattr(sn, "_tasks", lambda _: 1)
    seen = []
    monkeypatch.setattr(sn, "materialise", lambda df, label: seen.append(spark.conf.get(sn.FALLBACK_KEY)) or df)
    was = spark.conf.get(sn.FALLBACK_KEY)
    bands = sn.sketched_bands(base, draws, [1, 2])
    assert int(seen[0]) > 2 * sn.UNITS_OF_A_TASK and spark.conf.get(sn.FALLBACK_KEY) == was
    plan = bands._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # units are dealt, their rows under the draws are not
    got = {r["unit_id"]: (r["draws"], r["mean_need_e9"]) for r in bands.collect()}
    exact = {r["unit_id"]: (r["draws"], r["mean_need_e9"]) for r in sn.need_band(base, draws, [1, 2]).collect()}
    assert got == exact and got[3][0] == 150 and len(got) == 901


def test_spatial_join_by_rounds_is_the_first_polygon(spark, monkeypatch):
    """Squares on top of each other, ids that repeat or are missing, points in no square; found points leave."""
    rng = np.random.default_rng(8)
    spots, sizes = rng.normal(0, 1, (300, 2)), rng.uniform(0.05, 0.6, 300)
    numbers = [int(i) for i in rng.permutation(300) // 2]  # every ordinal twice

    def square(i):
        (x, y), h = map(float, spots[i]), float(sizes[i])
        return [[[[x - h, y - h], [x + h, y - h], [x + h, y + h], [x - h, y + h], [x - h, y - h]]]]
    polys = spark.createDataFrame([(numbers[i], numbers[i] * 10, square(i)) for i in range(300)] + [(None, 5, square(0))],
                                  "ordinal long, found long, parts array<array<array<array<double>>>>")
    places = [(int(i) if i % 50 else None, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1.2, (400, 2)))] + [(1, 0.0, 0.0), (401, None, 1.0)]
    points = spark.createDataFrame(places, "id long, px double, py double")
    want = {}
    for i, x, y in places:
        hits = [] if x is None or i is None else [numbers[k] * 10 for k in range(300) if abs(x - spots[k][0]) < sizes[k] and abs(y - spots[k][1]) < sizes[k]]
        inside = [h for h in hits if hits.count(h) == 1]  # squares of one ordinal are one shape: even-odd
        want[i] = min([*inside, *([want[i]] if want.get(i) is not None else [])], default=None)
    monkeypatch.setattr(geo, "FIRST_POLYGONS", 20)
    first, met = geo._first_found, []
    monkeypatch.setattr(geo, "_first_found", lambda left, *rest: met.append(left.count()) or first(left, *rest))
    got = {r["id"]: r["found"] for r in geo.spatial_join(points, polys, "id", "found").distinct().collect()}
    assert got == want and any(v is None for v in want.values())
    assert len(met) == 4 and met[0] == 402 and met[-1] < 402 / 2


def test_registered_forests_have_all_trees_of_the_method(monkeypatch):
    seen = {}
    monkeypatch.setattr(rq, "Residual", lambda d: SimpleNamespace(folded="folded"))
    monkeypatch.setattr(rs, "forest_models", lambda frame, names, **given: seen.update(given, names=names))
    rq.Fitted(None)
    assert seen["trees"] == 500 and seen["names"] == list(FEATURES) and "max_depth" not in seen
