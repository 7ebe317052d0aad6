"""The grown forest against plain counting, and that large nodes, copies and partitions do not change it."""

import numpy as np
import pytest

from equisite.functions import trees as tr
from equisite.operators import forest as fo
from equisite.operators import residual as rs

NAMES = ["a", "b", "c"]


def made(spark, n, seed=3, folds=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 1, (n, 3)), 2)
    y = np.sin(5 * x[:, 0]) + x[:, 1] + rng.normal(0, 0.2, n)
    rows = [(i, i % folds, float(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "unit_id long, fold int, y double, a double, b double, c double")


def told(df):
    return {r["unit_id"]: r["predicted"] for r in df.select("unit_id", "predicted").collect()}


def plain(x, y, cuts, least):
    """Mean by row, by trying every cut of every feature."""
    best = (1e-9, None)
    for j, own in enumerate(cuts):
        for c in own:
            left = x[:, j] <= c
            if least <= left.sum() <= len(y) - least:
                drop = np.var(y) * len(y) - np.var(y[left]) * left.sum() - np.var(y[~left]) * (~left).sum()
                if drop > best[0] * (1 + 1e-9):
                    best = (drop, left)
    if best[1] is None:
        return np.full(len(y), y.mean())
    out, left = np.empty(len(y)), best[1]
    for part in (left, ~left):
        out[part] = plain(x[part], y[part], cuts, least)
    return out


def test_grown_tree_is_that_of_plain_counting():
    rng = np.random.default_rng(5)
    x = np.round(rng.uniform(0, 1, (150, 3)), 1)
    y = x[:, 0] * x[:, 1] + rng.normal(0, 0.1, 150)
    w = rng.poisson(1, 150)
    cuts = [tr.cuts_of(*np.unique(v, return_counts=True)) for v in x.T]
    bins = tr.binned(x, cuts)
    tree = tr.grown(bins[:, w > 0], y[w > 0], w[w > 0], 0, 30, 3)
    rows = np.repeat(np.arange(150), w)
    assert np.allclose(tr.predicted(tree, bins[:, rows]), plain(x[rows], y[rows], cuts, 3))
    assert len(tree["feature"]) > 20 and tree["gains"][0] > 0


def test_cuts_part_rows_evenly_and_keep_rare_values():
    assert list(tr.cuts_of(np.array([0.0, 1.0, 5.0]), np.array([9000, 1, 1]))) == [0.5, 3.0]
    cuts = tr.cuts_of(np.arange(1000.0), np.ones(1000, int))
    assert len(cuts) == 31 and np.abs(np.diff(cuts) - 1000 / 32).max() < 2


def test_draws_of_copies_are_poisson():
    keys = np.random.default_rng(0).integers(-2 ** 63, 2 ** 63 - 1, 20_000)
    for c in (1, 7, 1000):
        w = tr.drawn(keys, np.full(len(keys), c), 42, 5)
        assert abs(w.mean() / c - 1) < 0.03 and abs(w.var() / c - 1) < 0.06
    assert (tr.drawn(keys, np.ones(len(keys), int), 42, 5) != tr.drawn(keys, np.ones(len(keys), int), 42, 6)).any()


def test_a_fit_takes_few_jobs_however_deep_its_trees(spark):
    """Spark's forest runs a job for every level, which sends every node's sums."""
    from pyspark.ml.regression import RandomForestRegressionModel
    frame = made(spark, 3000).persist()
    frame.count()
    sc = spark.sparkContext
    sc.setJobGroup("grown-forest", "one fit")
    model = rs._forest(NAMES, 3, 30, 42).fit(frame)
    jobs = len(sc.statusTracker().getJobIdsForGroup("grown-forest"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not isinstance(model.stages[-1], RandomForestRegressionModel) and jobs < 20


def test_large_nodes_are_split_as_small_ones_are(spark, monkeypatch):
    """Nodes of over 40 rows by summed bins, the others in a task: the same trees, importance and predictions."""
    frame = made(spark, 1500).persist()
    whole = rs._forest(NAMES, 3, 30, 42).fit(frame)
    monkeypatch.setattr(fo, "GROWN", 40)
    monkeypatch.setattr(fo, "PACK", 200)
    parts = rs._forest(NAMES, 3, 30, 42).fit(frame.repartition(5))
    assert whole.stages[-1].state.count() == 0 and parts.stages[-1].state.filter("feature >= 0").count() > 3 * 20
    assert whole.stages[-1].pieces.count() == 3 < parts.stages[-1].pieces.count()
    a, b = told(whole.transform(frame)), told(parts.transform(frame))
    assert len(a) == 1500 and max(abs(a[i] - b[i]) for i in a) < 1e-9
    assert np.allclose(whole.stages[-1].featureImportances.toArray(), parts.stages[-1].featureImportances.toArray())


def test_a_large_node_that_cannot_be_split_is_a_leaf(spark, monkeypatch):
    """Rows with the same features and other targets; rows that come twice are predicted twice."""
    frame = spark.range(900).selectExpr("id AS unit_id", "cast(id % 3 as int) AS fold", "cast(id as double) AS y",
                                        "cast(id div 300 as double) AS a", "0.5D AS b", "-0.0D AS c")
    twice = frame.unionByName(frame.filter("unit_id % 10 = 0"))
    monkeypatch.setattr(fo, "GROWN", 50)
    models = rs.forest_models(twice, NAMES, folds=3, trees=5)
    out = rs.forest_predictions(twice, models)
    assert out.count() == 990 and out.filter("predicted IS NULL").count() == 0
    means = {r["g"]: r["m"] for r in out.groupBy((out.unit_id / 300).cast("int").alias("g")).agg({"predicted": "avg"}).toDF("g", "m").collect()}
    assert all(abs(means[g] - (300 * g + 149.5)) < 15 for g in range(3))
    shares = {r["feature"]: r["importance"] for r in rs.feature_importance(twice, NAMES, models).collect()}
    assert shares == {"a": 1.0, "b": 0.0, "c": 0.0}


def test_predictions_do_not_depend_on_partitions_and_folds_are_checked(spark):
    frame = made(spark, 300).persist()
    a = told(rs.forest_predictions(frame, rs.forest_models(frame, NAMES, folds=4, trees=4)))
    again = frame.repartition(7, "y")
    b = told(rs.forest_predictions(again, rs.forest_models(again, NAMES, folds=4, trees=4)))
    assert len(a) == 300 and max(abs(a[i] - b[i]) for i in a) < 1e-9
    for wrong in ("fold + 1", "CAST(NULL AS INT)"):
        with pytest.raises(Exception, match="fold numbers"):
            rs.forest_models(frame.selectExpr("unit_id", f"{wrong} AS fold", "y", *NAMES), NAMES, folds=4, trees=1)


def test_trees_in_rounds_are_the_same_trees(spark, monkeypatch):
    """A bound on the rows that are sent at once changes neither trees nor predictions, with split nodes above the pieces too."""
    frame = made(spark, 600)
    whole = rs.forest_models(frame, NAMES, folds=4, trees=7)
    assert len(fo._rounds(500, 14_679)) == 1 and [len(x) for x in fo._rounds(500, 880_000)][:2] == [20, 20]
    assert sum(map(len, fo._rounds(47, 10 ** 9))) == 47
    wanted, shares = told(rs.forest_predictions(frame, whole)), whole.bestModel.stages[-1].featureImportances.toArray()
    monkeypatch.setattr(fo, "DEALT", 1)
    monkeypatch.setattr(fo, "TREES_OF_A_TASK", 3)
    monkeypatch.setattr(fo, "GROWN", 200)
    rounds = rs.forest_models(frame, NAMES, folds=4, trees=7)
    got = told(rs.forest_predictions(frame, rounds))
    assert len(fo._rounds(7, 450)) == 3 and got.keys() == wanted.keys()
    assert max(abs(got[k] - wanted[k]) for k in wanted) < 1e-9
    assert np.allclose(rounds.bestModel.stages[-1].featureImportances.toArray(), shares)
