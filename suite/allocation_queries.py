"""Allocation scenarios and their reports."""

from pyspark.sql import functions as F

from equisite.operators import allocation as al
from equisite.operators import index as ix
from equisite.plans import settings as cfg
from suite.prelude import sql
from suite.topic import topic

QUERIES, ORACLES, register = topic()
BUDGET, CAP, FLOOR = (cfg.get_param(k) for k in ("budget", "max_per_group", "min_per_zone"))


def optimal_ctes(tag, source, gain="gain", budget=BUDGET, cap=CAP, floor=FLOOR, part=""):
    """The three passes as SQL over ``source``; ``part`` is an extra partition column."""
    p, by = (f"{part}, ", f"PARTITION BY {part}") if part else ("", "")
    return {
        f"{tag}_1": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {p}grp ORDER BY {gain} DESC, unit_id) AS g
            FROM {source}) WHERE g <= {cap}""",
        f"{tag}_2": f"""SELECT *, row_number() OVER (PARTITION BY {p}zone ORDER BY {gain} DESC, unit_id) AS z,
            count(*) OVER (PARTITION BY {p}zone) AS in_zone FROM {tag}_1""",
        f"{tag}_3": f"""SELECT *, row_number() OVER ({by} ORDER BY z <= {floor} DESC, {gain} DESC, unit_id) AS k,
            (count(*) OVER ({by}) >= {budget} AND sum(CASE WHEN z <= {floor} THEN 1 ELSE 0 END) OVER ({by}) <= {budget}
             AND min(in_zone) OVER ({by}) >= {floor}) AS feasible FROM {tag}_2""",
        tag: f"SELECT * FROM {tag}_3 WHERE feasible AND k <= {budget}",
    }


def greedy_ctes(tag, source, key, budget=BUDGET, cap=CAP, floor=FLOOR):
    """The walk and the repair as SQL, swaps paired by number."""
    return {
        f"{tag}_1": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY {key} DESC, unit_id) AS g
            FROM {source}) WHERE g <= {cap}""",
        f"{tag}_2": f"""SELECT *, row_number() OVER (ORDER BY {key} DESC, unit_id) AS place,
            row_number() OVER (PARTITION BY zone ORDER BY {key} DESC, unit_id) AS z FROM {tag}_1""",
        f"{tag}_3": f"""SELECT *, count(*) FILTER (WHERE place <= {budget}) OVER (PARTITION BY zone) AS have FROM {tag}_2""",
        f"{tag}_out": f"""SELECT unit_id, place, row_number() OVER (ORDER BY {key}, unit_id DESC) AS i
            FROM {tag}_3 WHERE place <= {budget} AND z > {floor}""",
        f"{tag}_in": f"""SELECT *, row_number() OVER (ORDER BY zone, {key} DESC, unit_id) AS i
            FROM {tag}_3 WHERE place > {budget} AND z > have AND z <= {floor}""",
        tag: f"""SELECT scheme, unit_id, grp, zone, terrain, need_e9, gain, rural_population, place AS pick_rank FROM {tag}_3
            WHERE place <= {budget} AND unit_id NOT IN (SELECT o.unit_id FROM {tag}_out o JOIN {tag}_in USING (i))
            UNION ALL SELECT scheme, a.unit_id, grp, zone, terrain, need_e9, gain, rural_population, o.place
            FROM {tag}_in a JOIN {tag}_out o USING (i)""",
    }


_COLS = "scheme, unit_id, grp, zone, terrain, need_e9, gain, rural_population"
SCENARIOS = {
    **optimal_ctes("opt", "fx_cand"),
    **greedy_ctes("gre", "fx_cand", "gain"),
    **greedy_ctes("grn", "fx_cand", "need_e9"),
    "nai": f"""SELECT {_COLS}, row_number() OVER (ORDER BY need_e9 DESC, unit_id) AS pick_rank FROM fx_cand
        QUALIFY pick_rank <= {BUDGET}""",
    "bnd": f"""SELECT {_COLS}, row_number() OVER (ORDER BY gain DESC, unit_id) AS pick_rank FROM fx_cand
        QUALIFY pick_rank <= {BUDGET}""",
    "picks": " UNION ALL ".join(
        f"SELECT '{name}' AS scenario, {_COLS}, {rank} AS pick_rank FROM {tag}" for name, tag, rank in (
            ("naive_top", "nai", "pick_rank"), ("unconstrained_bound", "bnd", "pick_rank"),
            ("greedy_feasible", "gre", "pick_rank"), ("greedy_by_need", "grn", "pick_rank"),
            ("optimal", "opt", "CAST(NULL AS BIGINT)"))),
}


def scenarios(d):
    """All strategies; each has at most a budget of rows and is kept, since every report reads it again."""
    c = d.candidates
    found = {"naive_top": al.naive(c, BUDGET), "unconstrained_bound": al.bound(c, BUDGET),
            "greedy_feasible": al.greedy(c, BUDGET, CAP, FLOOR),
            "greedy_by_need": al.greedy(c, BUDGET, CAP, FLOOR, sort_by="need_e9"),
            "optimal": optimal(d)}
    return {name: picks.persist() for name, picks in found.items()}


def optimal(d):
    return al.optimal(d.candidates, BUDGET, CAP, FLOOR)


def all_picks(d):
    return al.stack(scenarios(d))


@register("alloc_optimal", sql("SELECT unit_id, grp, zone, terrain, need_e9, gain FROM opt", **SCENARIOS))
def _(d):
    return optimal(d).select("unit_id", "grp", "zone", "terrain", "need_e9", "gain")


@register("alloc_status", sql(f"""SELECT cap, floor_, status, usable, forced, smallest_zone FROM (
    SELECT {CAP}::BIGINT AS cap, {FLOOR}::BIGINT AS floor_, CASE WHEN bool_and(feasible) THEN 'Optimal' ELSE 'Infeasible' END AS status,
      count(*) AS usable, count(*) FILTER (WHERE z <= {FLOOR}) AS forced, min(in_zone) AS smallest_zone FROM opt_3 UNION ALL
    SELECT 1, 6, CASE WHEN bool_and(feasible) THEN 'Optimal' ELSE 'Infeasible' END,
      count(*), count(*) FILTER (WHERE z <= 6), min(in_zone) FROM bad_3)""",
    **SCENARIOS, **optimal_ctes("bad", "fx_cand", cap=1, floor=6)))
def _(d):
    parts = [al.status(d.candidates, BUDGET, cap, floor).select(
        F.lit(cap).cast("long").alias("cap"), F.lit(floor).cast("long").alias("floor_"),
        "status", "usable", "forced", "smallest_zone") for cap, floor in ((CAP, FLOOR), (1, 6))]
    return parts[0].unionByName(parts[1])


@register("alloc_naive", sql("SELECT unit_id, pick_rank, need_e9, gain FROM nai", **SCENARIOS))
def _(d):
    return al.naive(d.candidates, BUDGET).select("unit_id", "pick_rank", "need_e9", "gain")


@register("alloc_bound", sql("SELECT unit_id, pick_rank, need_e9, gain FROM bnd", **SCENARIOS))
def _(d):
    return al.bound(d.candidates, BUDGET).select("unit_id", "pick_rank", "need_e9", "gain")


@register("alloc_greedy", sql("SELECT unit_id, zone, pick_rank, gain FROM gre", **SCENARIOS))
def _(d):
    return al.greedy(d.candidates, BUDGET, CAP, FLOOR).select("unit_id", "zone", "pick_rank", "gain")


@register("alloc_greedy_need", sql("SELECT unit_id, zone, pick_rank, gain FROM grn", **SCENARIOS))
def _(d):
    return al.greedy(d.candidates, BUDGET, CAP, FLOOR, sort_by="need_e9").select(
        "unit_id", "zone", "pick_rank", "gain")


@register("allocation_picks", sql("""SELECT scenario, unit_id, grp, zone, terrain, pick_rank, need_e9 // 1000000 AS need_milli,
    rural_population, gain FROM picks""", **SCENARIOS))
def _(d):
    from equisite.functions.numbers import div
    return all_picks(d).select("scenario", "unit_id", "grp", "zone", "terrain", "pick_rank",
                               div("need_e9", F.lit(1_000_000)).alias("need_milli"), "rural_population", "gain")


_FEASIBILITY = " UNION ALL ".join(f"""
    SELECT '{name}' AS scenario, 'budget' AS rule, 'all' AS subject, count(*) AS found, {BUDGET}::BIGINT AS required FROM {tag}
      HAVING count(*) <> {BUDGET} UNION ALL
    SELECT '{name}', 'cap', grp, count(*), {CAP} FROM {tag} GROUP BY grp HAVING count(*) > {CAP} UNION ALL
    SELECT '{name}', 'floor', z.zone, count(t.unit_id), {FLOOR} FROM (SELECT DISTINCT zone FROM fx_cand) z
      LEFT JOIN {tag} t ON t.zone = z.zone GROUP BY z.zone HAVING count(t.unit_id) < {FLOOR}"""
    for name, tag in (("naive_top", "nai"), ("unconstrained_bound", "bnd"), ("greedy_feasible", "gre"), ("greedy_by_need", "grn"), ("optimal", "opt")))


@register("feasibility", sql(_FEASIBILITY, **SCENARIOS))
def _(d):
    out = None
    for name, df in scenarios(d).items():
        part = al.check_feasible(df, d.candidates, BUDGET, CAP, FLOOR).withColumn("scenario", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@register("allocation_summary", sql(f"""SELECT scenario, scheme, count(*) AS facilities, count(DISTINCT grp) AS groups_covered,
    count(DISTINCT zone) AS zones_covered, CAST(sum(gain) AS BIGINT) AS total_gain,
    CAST(sum(rural_population) AS BIGINT) AS rural_population_in_selected,
    count(*) FILTER (WHERE terrain <> 'plains') AS hilly_or_tribal_picks,
    (SELECT max(n) FROM by_group b WHERE b.scenario = p.scenario) AS max_in_any_group,
    (SELECT string_agg(grp || ' (' || n || ')', ', ' ORDER BY n DESC, grp) FROM by_group b
      WHERE b.scenario = p.scenario AND n > {CAP}) AS groups_over_cap
    FROM picks p GROUP BY scenario, scheme""", **SCENARIOS,
    by_group="SELECT scenario, grp, count(*) AS n FROM picks GROUP BY 1, 2"))
def _(d):
    return al.summary(all_picks(d), CAP)


@register("states_over_cap", sql(f"SELECT scenario, grp, count(*) AS n FROM picks GROUP BY 1, 2 HAVING count(*) > {CAP}",
                                 **SCENARIOS))
def _(d):
    return al.over_cap_groups(all_picks(d), CAP)


@register("premiums", sql("""SELECT scheme, CAST((o - g) * 10000 // g AS BIGINT) AS vs_greedy_bp,
    CAST((o - w) * 10000 // w AS BIGINT) AS vs_wrong_key_bp, CAST((o - n) * 10000 // n AS BIGINT) AS vs_naive_bp,
    CAST((o - b) * 10000 // b AS BIGINT) AS price_of_equity_bp
    FROM (SELECT scheme, sum(gain) FILTER (WHERE scenario = 'optimal') AS o, sum(gain) FILTER (WHERE scenario = 'greedy_feasible') AS g,
      sum(gain) FILTER (WHERE scenario = 'greedy_by_need') AS w, sum(gain) FILTER (WHERE scenario = 'naive_top') AS n,
      sum(gain) FILTER (WHERE scenario = 'unconstrained_bound') AS b FROM picks GROUP BY scheme)""", **SCENARIOS))
def _(d):
    return al.premiums(all_picks(d))


@register("terrain_mix", sql(f"""SELECT scenario, terrain, count(*) AS n,
    terrain = 'plains' AND count(*) = {BUDGET} AS all_plains FROM picks GROUP BY 1, 2""", **SCENARIOS))
def _(d):
    return al.terrain_mix(all_picks(d), BUDGET)


@register("picks_changed", sql("""SELECT (SELECT count(*) FROM ((SELECT unit_id FROM opt EXCEPT SELECT unit_id FROM alt)
      UNION ALL (SELECT unit_id FROM alt EXCEPT SELECT unit_id FROM opt))) // 2 AS changed,
    (SELECT count(*) FROM (SELECT unit_id FROM opt INTERSECT SELECT unit_id FROM alt)) AS shared""",
    **SCENARIOS, **optimal_ctes("alt", "fx_cand", gain="gain_population")))
def _(d):
    other = al.optimal(ix.choose_objective(d.default_score, "gain_population"), BUDGET, CAP, FLOOR)
    return al.picks_changed(optimal(d), other)
