"""Need index chain."""

from pyspark.sql import functions as F

from equisite.operators import index as ix
from equisite.operators import ranking as rk
from equisite.plans import settings as cfg
from fixtures import IDS
from suite.prelude import sql
from suite.topic import topic

QUERIES, ORACLES, register = topic()


@register("indicator_score", sql("SELECT unit_id, indicator_id, domain, value_bp, need_bp FROM fx_score"))
def _(d):
    return d.score_long.select("unit_id", "indicator_id", "domain", "value_bp", "need_bp")


@register("indicator_percentile", sql("SELECT unit_id, indicator_id, need_bp, pct_e9 FROM fx_pct"))
def _(d):
    return d.percentile.select("unit_id", "indicator_id", "need_bp", "pct_e9")


@register("percentile_wide", sql("SELECT * FROM fx_wide"))
def _(d):
    return d.wide


@register("need_index", sql("SELECT unit_id, scheme, indicators_present, weight_covered_ppm, need_e9 FROM fx_need"))
def _(d):
    return d.need


@register("weight_relation", sql("""SELECT scheme, indicator_id, indicator_key, w_ppm, units_with_value
    FROM fx_weight JOIN fx_indicator USING (indicator_id)
    JOIN (SELECT indicator_id, count(*) AS units_with_value FROM fx_fact GROUP BY 1) USING (indicator_id)"""))
def _(d):
    present = d.facts.groupBy("indicator_id").agg(F.count("*").alias("units_with_value"))
    return (d.weights.join(d.indicators, "indicator_id").join(present, "indicator_id")
            .select("scheme", "indicator_id", "indicator_key", "w_ppm", "units_with_value"))


@register("terrain", sql("SELECT unit_id, grp, minority_bp, terrain, catchment_norm FROM fx_district"))
def _(d):
    return d.units.select("unit_id", "grp", "minority_bp", "terrain", "catchment_norm")


_SCORE = ["unit_id", "scheme", "grp", "zone", "terrain", "indicators_present", "need_e9", "rural_population",
          "at_risk", "required_facilities", "gain_population", "gain_neutral"]


@register("district_score", sql(f"SELECT {', '.join(_SCORE)} FROM fx_scored"))
def _(d):
    return d.score.select(*_SCORE)


@register("required_facilities", sql("""SELECT unit_id, rural_population, catchment_norm,
    CAST(ceil(CAST(rural_population AS DECIMAL(18,0)) / catchment_norm) AS BIGINT) AS required_facilities
    FROM fx_district WHERE rural_population > 0"""))
def _(d):
    from equisite.functions.numbers import ceil_div
    return d.units.filter("rural_population > 0").select(
        "unit_id", "rural_population", "catchment_norm",
        ceil_div("rural_population", "catchment_norm").alias("required_facilities"))


_PEERS = """SELECT unit_id, scheme, need_e9, rank() OVER (PARTITION BY scheme ORDER BY need_e9 DESC) AS national_rank,
    rank() OVER (PARTITION BY scheme, grp ORDER BY need_e9 DESC) AS group_rank,
    count(*) OVER (PARTITION BY scheme, grp) AS units_in_group,
    CAST(sum(need_e9) OVER (PARTITION BY scheme, grp) // count(*) OVER (PARTITION BY scheme, grp) AS BIGINT) AS group_mean_e9,
    CAST(sum(need_e9) OVER (PARTITION BY scheme, zone) // count(*) OVER (PARTITION BY scheme, zone) AS BIGINT) AS zone_mean_e9
    FROM fx_scored"""


@register("peer_benchmark", sql(f"SELECT *, need_e9 - group_mean_e9 AS gap_to_group_e9 FROM ({_PEERS})"))
def _(d):
    return ix.peer_benchmark(d.score, d.groups).select(
        "unit_id", "scheme", "need_e9", "national_rank", "group_rank", "units_in_group",
        "group_mean_e9", "zone_mean_e9", "gap_to_group_e9")


@register("score_export", sql(f"""SELECT c.unit_id, c.grp, c.need_e9, c.at_risk, national_rank, group_rank,
    c.need_e9 - group_mean_e9 AS gap_to_group_e9 FROM fx_cand c JOIN ({_PEERS}) USING (unit_id, scheme)"""))
def _(d):
    peers = ix.peer_benchmark(d.default_score, d.groups)
    return ix.score_export(d.default_score, peers, cfg.DEFAULT_SCHEME).select(
        "unit_id", "grp", "need_e9", "at_risk", "national_rank", "group_rank", "gap_to_group_e9")


@register("top15", sql("""SELECT * FROM (SELECT rank() OVER (ORDER BY need_e9 DESC) AS national_rank, unit_id, grp, terrain, need_e9,
    rural_population, at_risk, indicators_present FROM fx_cand) ORDER BY national_rank, unit_id LIMIT 15"""))
def _(d):
    ranked = rk.rank_desc(d.default_score, ["scheme"], "need_e9", "national_rank")
    return (ranked.select("national_rank", "unit_id", "grp", "terrain", "need_e9", "rural_population",
                          "at_risk", "indicators_present")
            .orderBy("national_rank", "unit_id").limit(15))


@register("supply_degeneracy", sql("""SELECT unit_id, scheme, terrain, need_e9, at_risk, underservice_e9, prediction_e9,
    CAST(underservice_e9::HUGEINT * 10000 // nullif(prediction_e9, 0) AS BIGINT) AS ratio_bp,
    prediction_e9 >= underservice_e9 AND (prediction_e9 - underservice_e9 - 1)::HUGEINT * rural_population <= catchment_norm::HUGEINT * 1000000000 AS cancels
    FROM (SELECT *, CAST(at_risk::HUGEINT * 1000000000 * catchment_norm // rural_population AS BIGINT) AS underservice_e9,
      need_e9 * catchment_norm AS prediction_e9 FROM fx_scored)"""))
def _(d):
    return ix.supply_degeneracy(d.score)


@register("scheme_distribution", sql("""SELECT scheme, count(*) AS n, min(need_e9) AS lo_e9, max(need_e9) AS hi_e9,
    CAST(sum(need_e9) // count(*) AS BIGINT) AS mean_e9, round(stddev_samp(need_e9 / 1e9), 6) AS sd
    FROM fx_scored GROUP BY scheme"""))
def _(d):
    return ix.scheme_distribution(d.score)


@register("scheme_overlap", sql("""SELECT a.scheme AS scheme_a, b.scheme AS scheme_b,
    count(*) FILTER (WHERE a.rk <= 25 AND b.rk <= 25) AS shared FROM r a JOIN r b USING (unit_id)
    WHERE a.scheme < b.scheme GROUP BY 1, 2""",
    r="SELECT scheme, unit_id, rank() OVER (PARTITION BY scheme ORDER BY need_e9 DESC) AS rk FROM fx_scored"))
def _(d):
    return ix.scheme_overlap(d.score)


@register("view_counts", sql(" UNION ALL ".join(
    f"SELECT '{v}' AS relation, count(*) AS n FROM {t}" for v, t in (
        ("indicator_score", "fx_score"), ("indicator_percentile", "fx_pct"), ("need_index", "fx_need"),
        ("district_score", "fx_scored"), ("peer_benchmark", "fx_scored")))))
def _(d):
    from equisite.operators.reports import labelled_counts
    return labelled_counts({
        "indicator_score": d.score_long, "indicator_percentile": d.percentile, "need_index": d.need,
        "district_score": d.score, "peer_benchmark": ix.peer_benchmark(d.score, d.groups)})


@register("top_n", sql("SELECT unit_id, need_e9 FROM fx_cand ORDER BY need_e9 DESC, unit_id LIMIT 25"))
def _(d):
    return rk.top_n(d.default_score, "need_e9", 25, "unit_id").select("unit_id", "need_e9")


@register("bottom_n", sql("SELECT unit_id, need_e9 FROM fx_cand ORDER BY need_e9, unit_id LIMIT 10"))
def _(d):
    return rk.top_n(d.default_score, "need_e9", 10, "unit_id", ascending=True).select("unit_id", "need_e9")


@register("topk_per_group", sql("""SELECT grp, unit_id, need_e9, place FROM (SELECT *,
    row_number() OVER (PARTITION BY grp ORDER BY need_e9 DESC, unit_id) AS place FROM fx_cand) WHERE place <= 4"""))
def _(d):
    return rk.top_k_per_group(d.default_score, ["grp"], "need_e9", 4, "unit_id").select(
        "grp", "unit_id", "need_e9", F.col("place").cast("long").alias("place"))


@register("objective_choice", sql("""SELECT objective, unit_id, gain FROM (
    SELECT 'gain_neutral' AS objective, unit_id, gain_neutral AS gain FROM fx_cand UNION ALL
    SELECT 'gain_population', unit_id, gain_population FROM fx_cand)"""))
def _(d):
    parts = [ix.choose_objective(d.default_score, o).select(F.lit(o).alias("objective"), "unit_id", "gain")
             for o in cfg.OBJECTIVES]
    return parts[0].unionByName(parts[1])
