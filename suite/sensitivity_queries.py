"""Weight draws, stability, what-if and snapshot."""

from pyspark.sql import functions as F

from equisite.functions.classify import stability
from equisite.operators import allocation as al
from equisite.operators import sensitivity as sn
from equisite.operators import snapshot as sp
from equisite.operators import violations as vi
from equisite.operators import whatif as wf
from equisite.plans import settings as cfg
from equisite.plans.session import fresh_path, materialise
from equisite.sources import files
from fixtures import IDS
from suite.allocation_queries import BUDGET, CAP, FLOOR, SCENARIOS, all_picks, greedy_ctes, optimal, optimal_ctes
from suite.prelude import sql
from suite.topic import topic

QUERIES, ORACLES, register = topic()
DRAWS, TOP_N = 10_000, 25
# Fixed value: the method's number of draws per regime.
# Whole-number Dirichlet parameters, concentration 50 around equal weights.
ALPHAS = [7, 7, 7, 7, 7, 7, 8]


def _u(*parts):
    return f"((('0x' || substr(md5({' || chr(124) || '.join(str(p) for p in parts)}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


def _draw_sql(source, gammas):
    total = " + ".join(f"g{i}" for i in IDS)
    ws = ", ".join(f"CAST(floor(g{i} / ({total}) * 1000000 + 0.5) AS BIGINT) AS w{i}" for i in IDS)
    return f"SELECT draw, {ws} FROM (SELECT draw, {gammas} FROM {source})"


_UNIFORM = ", ".join(f"-ln({_u(cfg.SEED, 'draw', i)}) AS g{i}" for i in IDS)
_CENTRED = ", ".join(
    f"list_reduce(range(1, {a + 1}), lambda s, j: s - ln({_u(cfg.SEED, 'draw', i, 'CAST(j AS BIGINT)')}), 0.0::DOUBLE) AS g{i}"
    for i, a in zip(IDS, ALPHAS))
_NUM = " + ".join(f"coalesce(w{i} * p{i}, 0)" for i in IDS)
_DEN = " + ".join(f"CASE WHEN p{i} IS NULL THEN 0 ELSE w{i} END" for i in IDS)


def _regime_ctes(tag, gammas):
    return {
        f"{tag}_draws": _draw_sql(f"(SELECT range AS draw FROM range({DRAWS}))", gammas),
        f"{tag}_need": f"""SELECT draw, unit_id, grp, zone, catchment_norm, rural_population, CAST(({_NUM}) // ({_DEN}) AS BIGINT) AS need_e9
            FROM fx_base CROSS JOIN {tag}_draws""",
        f"{tag}_rank": f"SELECT *, row_number() OVER (PARTITION BY draw ORDER BY need_e9 DESC, unit_id) AS rank FROM {tag}_need",
        f"{tag}_gain": f"""SELECT *, CAST(need_e9::HUGEINT * least(catchment_norm, rural_population) // catchment_norm AS BIGINT) AS gain FROM {tag}_need""",
        **optimal_ctes(f"{tag}_opt", f"{tag}_gain", part="draw"),
        f"{tag}_band": f"""SELECT unit_id, count(*) AS draws, CAST(sum(need_e9) // count(*) AS BIGINT) AS mean_need_e9,
            CAST(round(quantile_cont(need_e9, 0.05) / 1000) AS BIGINT) AS p05_need_e6, CAST(round(quantile_cont(need_e9, 0.95) / 1000) AS BIGINT) AS p95_need_e6
            FROM {tag}_need GROUP BY 1""",
        f"{tag}_stab": f"""SELECT unit_id, count(*) FILTER (WHERE rank <= {TOP_N}) AS times_in_top_n,
            CAST(sum(rank) * 100 // count(*) AS BIGINT) AS mean_rank_centi, min(rank) AS best_rank, max(rank) AS worst_rank FROM {tag}_rank GROUP BY 1""",
        f"{tag}_alloc": f"""SELECT unit_id, runs, times_allocated, CASE WHEN times_allocated / runs > 0.95 THEN 'robust'
            WHEN times_allocated / runs < 0.05 THEN 'excluded' ELSE 'contested' END AS classification FROM (
              SELECT b.unit_id, (SELECT count(DISTINCT draw) FROM {tag}_opt) AS runs, coalesce(t.n, 0) AS times_allocated FROM fx_base b
              LEFT JOIN (SELECT unit_id, count(*) AS n FROM {tag}_opt GROUP BY 1) t USING (unit_id))""",
    }


_BASE = {"fx_base": """SELECT w.*, c.unit_name, c.grp, c.zone, c.terrain, c.catchment_norm, c.rural_population, c.population FROM fx_wide w
    JOIN fx_cand c USING (unit_id)"""}
_SENS = {
    **_BASE, **_regime_ctes("uni", _UNIFORM), **_regime_ctes("cen", _CENTRED),
    "sens": " UNION ALL ".join(f"SELECT '{name}' AS regime, * FROM {t}_band JOIN {t}_stab USING (unit_id) JOIN {t}_alloc USING (unit_id)"
                               for name, t in (("uniform", "uni"), ("centred", "cen"))),
}
_CONF = """SELECT o.unit_id, o.grp, o.zone, o.need_e9, c.times_allocated AS times_allocated_centred, c.times_in_top_n AS times_in_top_n_centred,
    c.classification AS classification_centred, u.times_allocated AS times_allocated_uniform, u.times_in_top_n AS times_in_top_n_uniform,
    u.classification AS classification_uniform, c.mean_rank_centi, c.best_rank, c.worst_rank FROM opt o
    LEFT JOIN sens c ON c.unit_id = o.unit_id AND c.regime = 'centred' LEFT JOIN sens u ON u.unit_id = o.unit_id AND u.regime = 'uniform'"""


def base(d):
    """Scored units with their percentiles: what every re-weighting starts from."""
    return d.default_score.select("unit_id", "unit_name", "grp", "zone", "terrain", "catchment_norm",
                                  "rural_population", *[f"p{i}" for i in IDS])


def draws(d, kind, n=DRAWS):
    ids = d.spark.range(n).withColumnRenamed("id", "draw")
    if kind == "uniform":
        return sn.uniform_draws(ids, IDS, cfg.SEED)
    return sn.centred_draws(ids, IDS, ALPHAS, cfg.SEED)


def dealt(d, kind, n=DRAWS):
    return sn.dealt_by_draw(base(d), draws(d, kind, n), IDS)


def stable_picks(d, kind):
    """Picks of every draw, written: they are read twice and have a budget of rows per draw."""
    picks = sn.picked_by_draw(dealt(d, kind), base(d), BUDGET, CAP, FLOOR).select("draw", "unit_id", "gain")
    return materialise(picks, "picks")


def sensitivity(d, n=DRAWS):
    parts = [sn.regime(k, base(d), draws(d, k, n), IDS, TOP_N, BUDGET, CAP, FLOOR) for k in ("uniform", "centred")]
    return parts[0].unionByName(parts[1])


@register("draws_uniform", sql(_draw_sql("(SELECT vec_id AS draw FROM embeddings)", _UNIFORM)))
def _(d):
    return sn.uniform_draws(d.table("embeddings").select(F.col("vec_id").alias("draw")), IDS, cfg.SEED)


@register("draws_centred", sql(_draw_sql("(SELECT vec_id AS draw FROM embeddings)", _CENTRED)))
def _(d):
    return sn.centred_draws(d.table("embeddings").select(F.col("vec_id").alias("draw")), IDS, ALPHAS, cfg.SEED)


# Concentration 50 around the default weights, and a skewed vector with parameters below 1.
_FRACTIONAL = [50 * w / 1_000_000 for w in cfg.SCHEMES[cfg.DEFAULT_SCHEME]]
_SKEWED = [0.4, 0.75, 1.0, 1.5, 2.25, 6.5, 20.125]


def _gamma_ctes(tag, alphas):
    """One row per draw, indicator and try; the first accepted try counts."""
    params = ", ".join(f"({i}, {a!r}::DOUBLE, {max(a, a + (a < 1)) - 1 / 3!r}::DOUBLE)" for i, a in zip(IDS, alphas))
    u = [_u(cfg.SEED, "draw", "i", "j", f"'{k}'") for k in "abc"]
    return {
        f"{tag}_try": f"""SELECT draw, i, a, d, j, sqrt(-2.0::DOUBLE * ln({u[0]})) * cos(2 * pi() * {u[1]}) AS z, ln({u[2]}) AS lu
            FROM (SELECT vec_id AS draw FROM embeddings), (VALUES {params}) p(i, a, d), (SELECT unnest(range(1, 13)) AS j)""",
        f"{tag}_val": f"SELECT *, pow(1.0::DOUBLE + z / (3 * sqrt(d)), 3.0::DOUBLE) AS v FROM {tag}_try",
        f"{tag}_hit": f"""SELECT draw, i, a, arg_min(d * v, j) AS g FROM {tag}_val WHERE CASE WHEN v > 0 THEN lu < 0.5 * z * z + d - d * v + d * ln(v) ELSE false END
            GROUP BY 1, 2, 3""",
        f"{tag}_g": "SELECT draw, " + ", ".join(f"max(g) FILTER (WHERE i = {i}) AS g{i}" for i in IDS) + f""" FROM (
            SELECT draw, i, CASE WHEN a < 1 THEN g * pow({_u(cfg.SEED, 'draw', 'i', "'boost'")}, 1.0::DOUBLE / a) ELSE g END AS g FROM {tag}_hit) GROUP BY 1""",
    }


def _gamma_sql(tag, alphas):
    return sql(_draw_sql(f"{tag}_g", ", ".join(f"g{i}" for i in IDS)), **_gamma_ctes(tag, alphas))


@register("draws_gamma", _gamma_sql("ga", _FRACTIONAL))
def _(d):
    return sn.gamma_draws(d.table("embeddings").select(F.col("vec_id").alias("draw")), IDS, _FRACTIONAL, cfg.SEED)


@register("draws_gamma_skewed", _gamma_sql("gs", _SKEWED))
def _(d):
    return sn.gamma_draws(d.table("embeddings").select(F.col("vec_id").alias("draw")), IDS, _SKEWED, cfg.SEED)


@register("per_draw", sql(f"""SELECT draw, count(*) AS units, min(need_e9) AS least_need_e9, max(need_e9) AS most_need_e9,
    CAST(sum(need_e9) // count(*) AS BIGINT) AS mean_need_e9, any_value(p.picks) AS picks, any_value(p.gain) AS gain, any_value(p.picked_ids) AS picked_ids,
    CAST(sum(CASE WHEN rank <= {TOP_N} THEN unit_id * rank ELSE 0 END) AS BIGINT) AS top_ids FROM uni_rank JOIN (
      SELECT draw, count(*) AS picks, CAST(sum(gain) AS BIGINT) AS gain, CAST(sum(unit_id) AS BIGINT) AS picked_ids FROM uni_opt GROUP BY 1) p USING (draw)
    GROUP BY draw""", **_SENS))
def _(d):
    return sn.per_draw(dealt(d, "uniform"), stable_picks(d, "uniform"), TOP_N)


@register("need_band", sql("SELECT * FROM uni_band", **_SENS))
def _(d):
    return sn.need_band(base(d), draws(d, "uniform"), IDS)


@register("need_band_sketch", sql("SELECT unit_id, draws, mean_need_e9, true AS low_within, true AS high_within FROM uni_band", **_SENS))
def _(d):
    """Bands from sketches, and whether their ranks among the unit's draws are within the stated error."""
    bands = sn.sketched_bands(base(d), draws(d, "uniform"), IDS)
    need = sn.needs_by_unit(base(d).join(bands, "unit_id"), draws(d, "uniform"), IDS, keep=bands.columns[1:])
    met = need.groupBy("unit_id", "draws", "mean_need_e9").agg(
        *[F.count_if(F.col("need_e9") < F.col(c)).alias(f"{c}_under") for c in ("p05_need_e9", "p95_need_e9")],
        *[F.count_if(F.col("need_e9") <= F.col(c)).alias(f"{c}_upto") for c in ("p05_need_e9", "p95_need_e9")])

    def within(c, q):
        low, high = (F.col("draws") * (q - sn.SKETCH_ERROR), F.col("draws") * (q + sn.SKETCH_ERROR))
        return (F.col(f"{c}_under") <= high) & (F.col(f"{c}_upto") >= low)
    return met.select("unit_id", "draws", "mean_need_e9", within("p05_need_e9", 0.05).alias("low_within"),
                      within("p95_need_e9", 0.95).alias("high_within"))


@register("rank_stability", sql("SELECT * FROM uni_stab", **_SENS))
def _(d):
    return sn.rank_stability(dealt(d, "uniform"), TOP_N)


@register("alloc_stability", sql("SELECT * FROM cen_alloc", **_SENS))
def _(d):
    return sn.alloc_stability(base(d), stable_picks(d, "centred"))


@register("classify", sql("""SELECT unit_id, CASE WHEN 20 * t > 19 * r THEN 'robust' WHEN 20 * t < r THEN 'excluded' ELSE 'contested' END AS classification
    FROM (SELECT unit_id, rural_hh AS t, total_hh AS r FROM fx_population)"""))
def _(d):
    return d.population.select("unit_id", stability(F.col("rural_hh"), F.col("total_hh")).alias("classification"))


@register("sensitivity", sql("SELECT * FROM sens", **_SENS))
def _(d):
    return sensitivity(d)


@register("allocation_confidence", sql(_CONF, **SCENARIOS, **_SENS))
def _(d):
    return sn.confidence(optimal(d).select("unit_id", "grp", "zone", "need_e9"), sensitivity(d))


@register("class_counts", sql("""SELECT regime, classification, count(*) AS n FROM sens WHERE unit_id IN (SELECT unit_id FROM opt)
    GROUP BY 1, 2""", **SCENARIOS, **_SENS))
def _(d):
    return sn.class_counts(sensitivity(d), optimal(d))


@register("contested", sql(f"SELECT * FROM ({_CONF}) WHERE classification_centred = 'contested'", **SCENARIOS, **_SENS))
def _(d):
    return sn.contested(sn.confidence(optimal(d).select("unit_id", "grp", "zone", "need_e9"), sensitivity(d)))


# -- what-if ------------------------------------------------------------------------------------

_W_BUDGET, _W_CAP, _W_FLOOR = 40, 3, 4
_SUM = "(SELECT sum(raw) FROM wi_raw)"
_WHATIF = {
    **_BASE,
    "wi_raw": "SELECT indicator_id, count(*) AS raw FROM fx_fact GROUP BY 1",
    "wi_w": f"SELECT indicator_id, CAST(raw * 1000000 // {_SUM} AS BIGINT) AS w_ppm FROM wi_raw",
    "wi_vec": "SELECT " + ", ".join(f"max(w_ppm) FILTER (WHERE indicator_id = {i}) AS w{i}" for i in IDS) + " FROM wi_w",
    "wi_need": f"SELECT 'custom' AS scheme, b.*, CAST(({_NUM}) // ({_DEN}) AS BIGINT) AS need_e9 FROM fx_base b CROSS JOIN wi_vec",
    "wi_cand": """SELECT *, rank() OVER (ORDER BY need_e9 DESC) AS national_rank,
        CAST(need_e9::HUGEINT * least(catchment_norm, rural_population) // 1000000000 AS BIGINT) AS gain FROM wi_need""",
    **optimal_ctes("wi_opt", "wi_cand", budget=_W_BUDGET, cap=_W_CAP, floor=_W_FLOOR),
    **greedy_ctes("wi_gre", "wi_cand", "gain", budget=_W_BUDGET, cap=_W_CAP, floor=_W_FLOOR),
    "wi_nai": f"SELECT * FROM wi_cand ORDER BY need_e9 DESC, unit_id LIMIT {_W_BUDGET}",
}


def custom_weights(d):
    """Raw weights that no named scheme has: how many units report each indicator."""
    return d.facts.groupBy("indicator_id").agg(F.count("*").alias("raw")).select(
        F.lit("custom").alias("scheme"), "indicator_id", "raw")


def rescored(d):
    """Written first: the planner then knows how few the weights are."""
    weights = materialise(wf.renormalise(custom_weights(d)), "weights")
    return wf.rescore(base(d), weights, IDS, "gain_population").persist()


@register("whatif_weights", sql("SELECT indicator_id, w_ppm FROM wi_w", **_WHATIF))
def _(d):
    return wf.renormalise(custom_weights(d)).select("indicator_id", "w_ppm")


@register("whatif", sql("SELECT unit_id, grp, zone, need_e9, national_rank, gain FROM wi_opt", **_WHATIF))
def _(d):
    return wf.solve(rescored(d), _W_BUDGET, _W_CAP, _W_FLOOR).select(
        "unit_id", "grp", "zone", "need_e9", "national_rank", "gain")


@register("whatif_status", sql(f"""SELECT CASE WHEN usable >= budget AND forced <= budget AND smallest_zone >= floor_ THEN 'Optimal' ELSE 'Infeasible' END AS status,
    concat_ws(',', CASE WHEN usable < budget THEN 'budget' END, CASE WHEN forced > budget THEN 'floors' END,
      CASE WHEN smallest_zone < floor_ THEN 'zone' END) AS reason, * FROM (
      SELECT budget, cap, floor_, CAST(sum(u) AS BIGINT) AS usable, CAST(sum(least(u, floor_)) AS BIGINT) AS forced, CAST(min(u) AS BIGINT) AS smallest_zone
      FROM (SELECT budget, cap, floor_, zone, sum(least(n, cap)) AS u FROM (SELECT grp, zone, count(*) AS n FROM wi_cand GROUP BY 1, 2)
        CROSS JOIN (VALUES ({_W_BUDGET}::BIGINT, {_W_CAP}::BIGINT, {_W_FLOOR}::BIGINT), (60, 1, 2), (30, 3, 7)) s(budget, cap, floor_) GROUP BY 1, 2, 3, 4)
      GROUP BY 1, 2, 3)""", **_WHATIF))
def _(d):
    scored = rescored(d)
    parts = [wf.solve_status(scored, *s) for s in ((_W_BUDGET, _W_CAP, _W_FLOOR), (60, 1, 2), (30, 3, 7))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("whatif_headline", sql("""SELECT facilities, groups, zones, hilly_or_tribal, gain, naive_gain,
    CAST((gain - naive_gain) * 10000 // naive_gain AS BIGINT) AS gap_bp FROM (SELECT count(*) AS facilities, count(DISTINCT grp) AS groups,
      count(DISTINCT zone) AS zones, count(*) FILTER (WHERE terrain <> 'plains') AS hilly_or_tribal, CAST(sum(gain) AS BIGINT) AS gain,
      (SELECT CAST(sum(gain) AS BIGINT) FROM wi_nai) AS naive_gain FROM wi_opt)""", **_WHATIF))
def _(d):
    scored = rescored(d)
    return wf.headline(wf.solve(scored, _W_BUDGET, _W_CAP, _W_FLOOR), scored, _W_BUDGET)


def _compare_sql(name, tag):
    broken = f"""SELECT 'budget' AS rule, 'all' AS subject, count(*) AS found FROM {tag} HAVING count(*) <> {_W_BUDGET} UNION ALL
        SELECT 'cap', grp, count(*) FROM {tag} GROUP BY grp HAVING count(*) > {_W_CAP} UNION ALL
        SELECT 'floor', z.zone, count(t.unit_id) FROM (SELECT DISTINCT zone FROM wi_cand) z LEFT JOIN {tag} t ON t.zone = z.zone
          GROUP BY z.zone HAVING count(t.unit_id) < {_W_FLOOR}"""
    return f"""SELECT '{name}' AS strategy, CAST(sum(gain) AS BIGINT) AS gain, count(DISTINCT grp) AS groups, count(DISTINCT zone) AS zones,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM {tag} GROUP BY grp)) AS max_in_one_group,
        (SELECT string_agg(rule || ' ' || subject || ': ' || found, '; ' ORDER BY rule, subject) FROM ({broken})) AS violations FROM {tag}"""


@register("strategy_compare", sql("SELECT *, violations IS NULL AS feasible FROM (" + " UNION ALL ".join(
    _compare_sql(n, t) for n, t in (("optimal", "wi_opt"), ("greedy", "wi_gre"), ("naive", "wi_nai"))) + ")", **_WHATIF))
def _(d):
    scored = rescored(d)
    return wf.compare({"optimal": wf.solve(scored, _W_BUDGET, _W_CAP, _W_FLOOR),
                       "greedy": al.greedy(scored, _W_BUDGET, _W_CAP, _W_FLOOR),
                       "naive": al.naive(scored, _W_BUDGET)}, scored, _W_BUDGET, _W_CAP, _W_FLOOR)


@register("whatif_confidence", sql("""SELECT o.unit_id, o.need_e9, CAST(s.times_allocated * 100 // s.runs AS BIGINT) AS stability_pct, s.classification
    FROM wi_opt o LEFT JOIN cen_alloc s USING (unit_id)""", **_WHATIF, **{k: v for k, v in _SENS.items() if k != "fx_base"}))
def _(d):
    picks = wf.solve(rescored(d), _W_BUDGET, _W_CAP, _W_FLOOR).select("unit_id", "need_e9")
    stored = sn.alloc_stability(base(d), stable_picks(d, "centred"))
    return wf.with_confidence(picks, stored.withColumn("regime", F.lit("centred")))


# -- snapshot -----------------------------------------------------------------------------------

@register("snapshot_base", sql("SELECT unit_id, unit_name, grp, zone, terrain, rural_population, catchment_norm, " + ", ".join(
    f"p{i}" for i in IDS) + " FROM fx_base", **_BASE))
def _(d):
    path = fresh_path(d.spark, "snapshot")
    columns = ["unit_name", "grp", "zone", "terrain", "rural_population", "catchment_norm"]
    sp.snapshot_base(d.scored_units, d.wide, d.default_score, columns).write.mode("overwrite").parquet(path)
    return d.spark.read.parquet(path)


_SNAP_COLUMNS = ["unit_name", "grp", "zone", "terrain", "rural_population", "catchment_norm"]


def snapshot_of(d):
    """The domain's committed snapshot of base, sensitivity and allocation, written once: (folder, its tables)."""
    if hasattr(d, "snapshot"):
        return d.snapshot
    folder = fresh_path(d.spark, "full-snapshot")
    tables = {"base": sp.snapshot_base(d.scored_units, d.wide, d.default_score, _SNAP_COLUMNS),
              "sensitivity": sensitivity(d).select("unit_id", "regime", "draws", "times_allocated", "runs", "times_in_top_n", "classification"),
              "allocation": all_picks(d).select("scenario", "unit_id", "need_e9", "gain")}
    sp.write_snapshot(tables, folder)
    d.snapshot = folder, list(tables)
    return d.snapshot


@register("snapshot_tables", sql("""SELECT 'base' AS table_name, count(*) AS n_rows, true AS unchanged FROM fx_base UNION ALL
    SELECT 'sensitivity', count(*), true FROM sens UNION ALL SELECT 'allocation', count(*), true FROM picks""", **SCENARIOS, **_SENS))
def _(d):
    return sp.verify_snapshot(d.spark, *snapshot_of(d))


@register("sensitivity_rules", sql("""SELECT rule, CAST(unit_id AS VARCHAR) AS key, detail, count(*) AS n FROM (
    SELECT 'classification known' AS rule, unit_id, 'unsure' AS detail FROM sens WHERE unit_id % 37 = 0 UNION ALL
    SELECT 'stability is a share', unit_id, CAST(times_in_top_n AS VARCHAR) FROM sens WHERE unit_id % 41 = 0 UNION ALL
    SELECT 'classification known', unit_id, classification FROM sens WHERE unit_id % 37 <> 0 AND classification NOT IN ('robust', 'contested', 'excluded') UNION ALL
    SELECT 'stability is a share', unit_id, CAST(times_in_top_n AS VARCHAR) FROM sens WHERE unit_id % 41 <> 0
      AND (times_in_top_n NOT BETWEEN 0 AND draws OR times_allocated NOT BETWEEN 0 AND runs)) GROUP BY 1, 2, 3""", **_SENS))
def _(d):
    """The standing rules on stored sensitivity, where some units have an unknown class or more picks than runs."""
    folder, _ = snapshot_of(d)
    stored = d.spark.read.parquet(f"{folder}/sensitivity")
    damaged = (stored.withColumn("classification", F.when(F.col("unit_id") % 37 == 0, F.lit("unsure")).otherwise(F.col("classification")))
               .withColumn("times_allocated", F.when(F.col("unit_id") % 41 == 0, F.col("runs") + 1).otherwise(F.col("times_allocated"))))
    return vi.sensitivity_rules(damaged).groupBy("rule", "key", "detail").agg(F.count("*").alias("n"))


@register("snapshot_read_back", sql("""SELECT p.scenario, o.source_kind, count(*) AS units, CAST(sum(p.gain) AS BIGINT) AS gain,
    count(*) FILTER (WHERE s.classification = 'robust') AS robust FROM picks p JOIN sens s ON s.unit_id = p.unit_id AND s.regime = 'centred',
    (VALUES ('table'), ('snapshot')) o(source_kind) GROUP BY 1, 2""", **SCENARIOS, **_SENS))
def _(d):
    """The same report from both sources: managed tables, and the snapshot where there are none."""
    folder, names = snapshot_of(d)
    reports, made = [], []
    for kind in ("table", "snapshot"):
        read = {}
        for name in names[1:]:
            table = f"{name}_{folder[-12:]}"
            if kind == "table":
                d.spark.read.parquet(f"{folder}/{name}").write.saveAsTable(table)
                made.append(table)
            read[name] = files.table_or_snapshot(d.spark, table if kind == "table" else f"no_{table}", f"{folder}/{name}")
        centred = read["sensitivity"].filter("regime = 'centred'").select("unit_id", "classification")
        reports.append(read["allocation"].join(centred, "unit_id").groupBy("scenario", "source_kind").agg(
            F.count("*").alias("units"), F.sum("gain").alias("gain"), F.count_if(F.col("classification") == "robust").alias("robust")))
    out = materialise(reports[0].unionByName(reports[1]), "read-back")
    for table in made:
        d.spark.sql(f"DROP TABLE {table}")
    return out


@register("snapshot_manifest", sql("""SELECT 'equal_per_indicator' AS scheme, (SELECT count(*) FROM fx_base) AS units, 7::BIGINT AS indicators,
    (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT scenario AS s FROM picks)) AS scenarios,
    (SELECT string_agg(r, ',' ORDER BY r) FROM (SELECT DISTINCT regime AS r FROM sens)) AS regimes, true AS stamped""", **SCENARIOS, **_SENS))
def _(d):
    path = fresh_path(d.spark, "manifest")
    kept, _ = snapshot_of(d)
    stored = {name: d.spark.read.parquet(f"{kept}/{name}") for name in ("base", "allocation", "sensitivity")}
    files.write_manifest(sp.manifest(stored["base"], stored["allocation"], cfg.DEFAULT_SCHEME, [i[1] for i in cfg.INDICATORS],
                                     stored["sensitivity"]), path)
    back = d.spark.read.schema("scheme string, units long, indicators array<string>, scenarios array<string>, regimes array<string>, "
                               "exported_at string").json(path)
    return back.select("scheme", "units", F.size("indicators").cast("long").alias("indicators"),
                       F.array_join("scenarios", ",").alias("scenarios"),
                       F.array_join("regimes", ",").alias("regimes"), (F.length("exported_at") >= 20).alias("stamped"))
