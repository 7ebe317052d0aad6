"""The window optimum against enumeration, the greedy against its plain loop, and the constraints."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from equisite.operators import allocation as al
from fixtures import domain
from suite.allocation_queries import scenarios

ZONE_OF = {"g1": "A", "g2": "A", "g3": "B", "g4": "B", "g5": "C"}
SCHEMA = ("problem int, unit_id long, grp string, zone string, gain long, need_e9 long, scheme string, terrain string, "
          "rural_population long")


def instance(rng, problem, n):
    rows = []
    for i in range(n):
        grp = rng.choice(list(ZONE_OF))
        gain = rng.randrange(0, 6)
        rows.append((problem, i, grp, ZONE_OF[grp], gain, gain, "s", "plains", 1))
    return rows


def enumerate_best(rows, budget, cap, floor):
    best = None
    zones = {r[3] for r in rows}
    for pick in itertools.combinations(rows, budget):
        groups, per_zone = {}, dict.fromkeys(zones, 0)
        for r in pick:
            groups[r[2]] = groups.get(r[2], 0) + 1
            per_zone[r[3]] += 1
        if max(groups.values()) <= cap and min(per_zone.values()) >= floor:
            total = sum(r[4] for r in pick)
            best = total if best is None else max(best, total)
    return best


@pytest.mark.parametrize("budget,cap,floor", [(3, 1, 1), (4, 2, 1), (5, 2, 2), (3, 3, 0), (4, 1, 2), (6, 4, 1)])
def test_optimum_equals_enumeration(spark, budget, cap, floor):
    rng = random.Random(budget * 100 + cap * 10 + floor)
    problems = {p: instance(rng, p, rng.randrange(budget, 10)) for p in range(40)}
    df = spark.createDataFrame([r for rows in problems.values() for r in rows], SCHEMA)
    got = al.optimal(df, budget, cap, floor, keys=["problem"]).groupBy("problem").agg(F.sum("gain").alias("g"), F.count("*").alias("n"))
    totals = {r["problem"]: (r["g"], r["n"]) for r in got.collect()}
    states = {r["problem"]: r["status"] for r in al.status(df, budget, cap, floor, keys=["problem"]).collect()}
    for p, rows in problems.items():
        best = enumerate_best(rows, budget, cap, floor)
        assert states[p] == ("Infeasible" if best is None else "Optimal")
        assert totals.get(p) == (None if best is None else (best, budget))


def plain_greedy(rows, budget, cap, floor):
    """The walk and the repair, one step at a time, over a total order (gain desc, id)."""
    order = sorted(rows, key=lambda r: (-r[4], r[1]))
    by_id, picked, per_group = {r[1]: r for r in rows}, [], {}
    for r in order:
        if len(picked) < budget and per_group.get(r[2], 0) < cap:
            picked.append(r[1])
            per_group[r[2]] = per_group.get(r[2], 0) + 1
    zones = sorted({r[3] for r in rows})

    def count(zone):
        return sum(by_id[d][3] == zone for d in picked)
    for zone in zones:
        while count(zone) < floor:
            drop = [d for d in picked if count(by_id[d][3]) > floor]
            if not drop:
                break
            worst = min(drop, key=lambda d: (by_id[d][4], -d))
            add = next((r for r in order if r[3] == zone and r[1] not in picked
                        and sum(by_id[d][2] == r[2] for d in picked if d != worst) < cap), None)
            if add is None:
                break
            picked[picked.index(worst)] = add[1]
    return {d: i + 1 for i, d in enumerate(picked)}


@pytest.mark.parametrize("budget,cap,floor", [(3, 1, 1), (4, 2, 1), (6, 3, 2), (5, 2, 2)])
def test_greedy_equals_the_loop(spark, budget, cap, floor):
    rng = random.Random(budget + cap + floor)
    problems = {p: instance(rng, p, rng.randrange(4, 16)) for p in range(40)}
    df = spark.createDataFrame([r for rows in problems.values() for r in rows], SCHEMA)
    got = {}
    for r in al.greedy(df, budget, cap, floor, keys=["problem"]).collect():
        got.setdefault(r["problem"], {})[r["unit_id"]] = r["pick_rank"]
    for p, rows in problems.items():
        assert got.get(p, {}) == plain_greedy(rows, budget, cap, floor), p


SWEEP = [(25, 2, 3), (25, 4, 1), (10, 1, 1), (10, 2, 2), (15, 2, 1), (20, 3, 2), (40, 4, 1), (25, 3, 0), (5, 1, 1)]


@pytest.mark.parametrize("budget,cap,floor", SWEEP)
def test_sweep(spark, small, budget, cap, floor):
    c = domain(spark, small).candidates
    opt = al.optimal(c, budget, cap, floor)
    gre = al.greedy(c, budget, cap, floor)
    assert al.check_feasible(opt, c, budget, cap, floor).count() == 0
    assert al.check_feasible(gre, c, budget, cap, floor).count() == 0
    total = lambda df: df.agg(F.sum("gain")).head()[0]
    assert total(gre) <= total(opt) <= total(al.bound(c, budget))


def test_dominance_and_naive_breaks_the_cap(spark, small):
    s = scenarios(domain(spark, small))
    total = {k: v.agg(F.sum("gain")).head()[0] for k, v in s.items()}
    assert total["greedy_by_need"] <= total["optimal"] <= total["unconstrained_bound"]
    assert total["greedy_feasible"] <= total["optimal"]
    rules = {r["rule"] for r in al.check_feasible(s["naive_top"], domain(spark, small).candidates, 25, 2, 3).collect()}
    assert "cap" in rules


def test_infeasible(spark, small):
    c = domain(spark, small).candidates
    assert al.status(c, 40, 1, 1).head()["status"] == "Infeasible"
    assert al.optimal(c, 40, 1, 1).count() == 0


def test_missing_zone_is_reported(spark):
    c = spark.createDataFrame([(0, 1, "g1", "A", 5, 5, "s", "plains", 1), (0, 2, "g3", "B", 1, 1, "s", "plains", 1)], SCHEMA)
    rows = al.check_feasible(c.filter("zone = 'A'"), c, 1, 1, 1).collect()
    assert [(r["rule"], r["subject"], r["found"]) for r in rows] == [("floor", "B", 0)]


def test_non_nested_groups_fail(spark):
    rows = [(0, 1, "g", "z1", 5, 5, "s", "plains", 1), (0, 2, "g", "z2", 9, 9, "s", "plains", 1), (0, 3, "h", "z2", 7, 7, "s", "plains", 1)]
    c = spark.createDataFrame(rows, SCHEMA)
    for run in (al.optimal, al.greedy, al.status):
        with pytest.raises(Exception, match="lies in zones z1 and z2"):
            run(c, 2, 1, 1).collect()


def test_status_counts_all_usable_units(spark):
    rows = [(0, i, f"g{i}", "z1" if i < 9 else "z2", i, i, "s", "plains", 1) for i in range(10)]
    state = al.status(spark.createDataFrame(rows, SCHEMA), 3, 1, 2).head()
    assert (state["status"], state["reason"], state["usable"], state["smallest_zone"]) == ("Infeasible", "zone", 10, 1)
