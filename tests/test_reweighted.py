"""Packs of units under packs of draws against the same product spelled out as rows."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from equisite.functions import reweighted as rw
from equisite.operators import allocation as al
from equisite.operators import sensitivity as sn
from equisite.operators.index import need_by_vector

IDS = [1, 2, 3]


def made_up(spark):
    """Units with missing percentiles, ties, unit 7 three times, unit 8 with two vectors, a missing id, group and people."""
    rows = [(i, (i * 37) % 11 * 90_000_001, None if i % 4 == 0 else (i * 17) % 7 * 100_000_003, i % 5 * 200_000_000 if i % 9 else None,
             None if i % 30 == 0 else f"g{i % 6}", f"z{i % 2}", 40 + i % 3, None if i % 25 == 0 else 30 + i % 20) for i in range(1, 120)]
    rows += [rows[6], rows[6], (8, 5, 6, 7, "g2", "z0", 41, 33), (None, 7, 8, 9, "g1", "z1", 40, 31)]
    base = spark.createDataFrame(rows, "unit_id long, p1 long, p2 long, p3 long, grp string, zone string, catchment_norm long, rural_population long")
    draws = spark.createDataFrame([(k, 100_000 * (k % 4), 300_000 + 7 * k, 200_001) for k in range(45)] + [(45, 0, 1, 0)],
                                  "draw long, w1 long, w2 long, w3 long")
    return base, draws


@pytest.fixture
def small_packs(monkeypatch):
    for name, value in (("PACK", 16), ("DRAWS_OF_A_PACK", 7), ("DRAWS_OF_A_TASK", 9), ("BAND_PACK", 8)):
        monkeypatch.setattr(sn, name, value)


def same(a, b):
    rows = [sorted(map(tuple, x.select(*sorted(x.columns)).collect()), key=repr) for x in (a, b)]
    assert rows[0] == rows[1] and rows[0]


def test_bands(spark, small_packs):
    """Needs under a draw are missing where its only weight meets a missing percentile; quantiles leave them out."""
    base, draws = made_up(spark)
    need = need_by_vector(base, draws, IDS)
    q = F.percentile("need_e9", F.array(F.lit(0.05), F.lit(0.95)))
    rows = need.groupBy("unit_id").agg(F.count("*").alias("draws"), F.expr("sum(need_e9) div count(*)").alias("mean_need_e9"), q.alias("_q"))
    band = sn.need_band(base, draws, IDS)
    same(band, rows.select("unit_id", "draws", "mean_need_e9", F.round(F.col("_q")[0] / 1000).cast("long").alias("p05_need_e6"),
                           F.round(F.col("_q")[1] / 1000).cast("long").alias("p95_need_e6")))
    assert "BroadcastNestedLoopJoin" not in band._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in band._jdf.queryExecution().optimizedPlan().toString()  # a unit's draws are not gathered


@pytest.mark.parametrize("held", [4_000_000, 10])
def test_ranks(spark, small_packs, monkeypatch, held):
    monkeypatch.setattr(sn, "HELD", held)
    base, draws = made_up(spark)
    dealt = sn.dealt_by_draw(base, draws, IDS)
    ranked = sn.ranked_by_draw(dealt)
    rows = ranked.groupBy("unit_id").agg(F.count_if(F.col("rank") <= 5).alias("times_in_top_n"), F.expr("sum(rank) * 100 div count(*)").alias("mean_rank_centi"),
                                         F.min("rank").alias("best_rank"), F.max("rank").alias("worst_rank"))
    got = sn.rank_stability(dealt, 5)
    same(got, rows)
    assert ("Window" in got._jdf.queryExecution().optimizedPlan().toString()) == (held == 10)


@pytest.mark.parametrize("objective", ["gain_neutral", "gain_population"])
def test_picks_and_reports(spark, small_packs, objective):
    base, draws = made_up(spark)
    base = base.filter("unit_id <> 8").distinct()  # one row per unit: picks of equal rows have no order
    dealt = sn.dealt_by_draw(base, draws, IDS, objective)
    picks = sn.picked_by_draw(dealt, base, 9, 2, 3)
    same(picks, al.optimal(dealt.rows(), 9, 2, 3, keys=["draw"]))
    few = sn.best_of_groups(dealt, 2)
    assert few.count() < dealt.rows().count() and few.groupBy("draw", "unit_id").count().filter("count > 1").count() == 0
    place = F.row_number().over(Window.partitionBy("draw").orderBy(F.col("need_e9").desc(), "unit_id"))
    rows = dealt.rows().withColumn("rank", place).groupBy("draw").agg(
        F.count("*").alias("units"), F.min("need_e9").alias("least_need_e9"), F.max("need_e9").alias("most_need_e9"),
        F.expr("sum(need_e9) div count(*)").alias("mean_need_e9"),
        F.sum(F.when(F.col("rank") <= 5, F.col("unit_id") * F.col("rank")).otherwise(0)).alias("top_ids"))
    same(sn.per_draw(dealt, picks, 5).drop("picks", "gain", "picked_ids"), rows)


def test_unknown_objective_fails(spark):
    with pytest.raises(ValueError):
        sn.dealt_by_draw(*made_up(spark), IDS, "other")


def test_ranks_of_many_units_send_few_bytes(spark, small_packs, monkeypatch):
    """Six times 900,000 customers are held, and sent to a bounded number of tasks; a bound that is met changes no rank."""
    cores = spark.sparkContext.defaultParallelism
    each = 8 + 7 * 4 + 28
    assert sn.HELD > 5_400_000 and sn._blocks(spark, 1000, each, 10_000) == -(-10_000 // sn.DRAWS_OF_A_TASK)
    blocks = sn._blocks(spark, 5_400_000, each, 10_000)
    assert blocks % cores == 0 and blocks >= cores and (blocks == cores or blocks * 5_400_000 * each <= sn.SENT)
    base, draws = made_up(spark)
    dealt = sn.dealt_by_draw(base, draws, IDS)
    monkeypatch.setattr(sn, "PIECE", 10)
    many = sn.rank_stability(dealt, 5)
    monkeypatch.setattr(sn, "SENT", 1)
    monkeypatch.setattr(sn, "DRAWS_OF_A_TASK", 1)
    assert sn._blocks(spark, 119, each, 46) == cores
    same(many, sn.rank_stability(dealt, 5))
    large = base.withColumn("p1", F.col("p1") * 1000)  # percentiles beyond 32 bits
    ranked = sn.ranked_by_draw(sn.dealt_by_draw(large, draws, IDS)).groupBy("unit_id").agg(F.min("rank").alias("best_rank"), F.max("rank").alias("worst_rank"))
    same(sn.rank_stability(sn.dealt_by_draw(large, draws, IDS), 5).select("unit_id", "best_rank", "worst_rank"), ranked)


def test_keys_of_more_than_four_million_units(monkeypatch):
    need = np.array([[5, rw.NONE, 10 ** 9, 5, -3, 0]])
    for bits, first in ((22, 0), (23, 5_000_000), (30, 10 ** 9)):
        keys = np.sort(rw._keys(need, bits, first)[0])
        assert list((keys & ((1 << bits) - 1)) - first) == [2, 0, 3, 5, 4, 1]
    with pytest.raises(OverflowError):
        rw._keys(np.array([[1 << 39]]), 23)
    rng = np.random.default_rng(1)
    p, has, w = rng.integers(0, 9, (3, 50)) * 10 ** 8, rng.random((3, 50)) < 0.8, rng.integers(0, 5, (12, 3))
    p[~has] = 0
    monkeypatch.setattr(rw, "STRIP", 8)
    told = rw.rank_sums(rw.Units.of_rows(p.astype(np.int32), has), w, 4)
    needs = rw.Units(p.T, has.T).needs(w)
    ranks = np.array([np.argsort(np.lexsort([np.arange(50), -v])) + 1 for v in needs])
    for a, b in zip(told, ((ranks <= 4).sum(0), ranks.sum(0), ranks.min(0), ranks.max(0))):
        assert (a == b).all()
