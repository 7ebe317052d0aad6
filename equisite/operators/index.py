"""Need index: direction, percentile, weighted composite, unit score, peers, supply proof."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equisite.functions.numbers import E9, ceil_div, div, mul_div, toward_need
from equisite.operators.ranking import percent_rank_e9, rank_desc, ranks_in_levels
from equisite.plans.bounds import broadcast_if_small
from equisite.plans.settings import OBJECTIVES, get_param


def indicator_score(facts: DataFrame, indicators: DataFrame, top: int = 10_000) -> DataFrame:
    """Present values only (never imputed), turned so that higher is worse."""
    return (facts.filter(F.col("value_bp").isNotNull())
            .join(indicators, "indicator_id")
            .withColumn("need_bp", toward_need("value_bp", "higher_is_worse", top)))


def indicator_percentile(score: DataFrame) -> DataFrame:
    """Percentile of each unit within each indicator's distribution (``percent_rank``)."""
    return percent_rank_e9(score, ["indicator_id"], "need_bp", "pct_e9")


def percentile_wide(pct: DataFrame, ids: Sequence[int]) -> DataFrame:
    """One row per unit, one column per indicator, NULL where absent; a single shuffle."""
    return pct.groupBy("unit_id").agg(
        *[F.expr(f"max(pct_e9) FILTER (WHERE indicator_id = {i})").alias(f"p{i}") for i in ids])


def weights_wide(weights: DataFrame, ids: Sequence[int], key: str = "scheme") -> DataFrame:
    """One row per weight vector; the same shape serves named schemes and sampled draws."""
    return weights.groupBy(key).agg(
        *[F.expr(f"coalesce(sum(w_ppm) FILTER (WHERE indicator_id = {i}), 0)").alias(f"w{i}") for i in ids])


def need_terms(ids: Sequence[int]) -> tuple[Column, Column, Column]:
    """(need_e9, weight covered, indicators present) from p* and w* columns.

    Weights are renormalised over the indicators a unit has; an absent one never counts as 0.
    """
    weighted = " + ".join(f"coalesce(w{i} * p{i}, 0)" for i in ids)
    covered = " + ".join(f"if(p{i} IS NULL, 0, w{i})" for i in ids)
    present = " + ".join(f"if(p{i} IS NULL, 0L, 1L)" for i in ids)
    return F.expr(f"({weighted}) div nullif({covered}, 0)"), F.expr(covered), F.expr(present)


def need_by_vector(wide: DataFrame, vectors: DataFrame, ids: Sequence[int],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Need of every unit under every weight vector.

    The vectors come from literals or a range, so the planner knows their size: while they fit its
    broadcast threshold, units stay in place and each row is repeated once per vector inside its
    task; beyond it the product is cut into blocks. The long fact table never meets the vectors.
    """
    key = [c for c in vectors.columns if not c.startswith("w")][0]
    need, covered, present = need_terms(ids)
    return (wide.crossJoin(vectors)
            .select("unit_id", *keep, key, present.alias("indicators_present"),
                    covered.alias("weight_covered_ppm"), need.alias("need_e9")))


def district_score(need: DataFrame, units: DataFrame, params: dict[str, int] | None = None) -> DataFrame:
    """Join need with population and norm; apply the missingness floor and positive population."""
    floor = get_param("min_indicators_present", params)
    joined = need.filter(F.col("indicators_present") >= floor).join(
        units.filter(F.col("rural_population") > 0), "unit_id")
    return with_gains(joined)


def with_gains(df: DataFrame) -> DataFrame:
    """People at risk, facilities implied by the norm, and both objectives.

    A gain is at most 10**9 times the norm, which fits a whole number; people at risk may not.
    """
    served = "least(catchment_norm, rural_population)"
    return df.withColumns({
        "at_risk": mul_div("need_e9", "rural_population", str(E9)),
        "required_facilities": ceil_div("rural_population", "catchment_norm"),
        "gain_population": F.expr(f"need_e9 * {served} div {E9}"),
        "gain_neutral": F.expr(f"need_e9 * {served} div catchment_norm")})


def choose_objective(score: DataFrame, objective: str) -> DataFrame:
    """Alias the configured objective to ``gain``; an unknown one fails."""
    if objective not in OBJECTIVES:
        raise ValueError(f"unknown objective: {objective}")
    return score.withColumn("gain", F.col(objective))


def peer_benchmark(score: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Overall and group rank, group size, group and zone mean, gap to the group mean.

    Ranks and group means come from one count of the scores; zone means are pre-aggregated totals joined back
    (bounded by the zone dimension), so no window gathers a whole group.
    """
    ranked = ranks_in_levels(score, {"national": ["scheme"], "group": ["scheme", "grp"]}, "need_e9")
    by_zone = score.groupBy("scheme", "zone").agg(
        div(F.sum("need_e9"), F.count("*")).alias("zone_mean_e9"))
    if groups is not None:
        by_zone = broadcast_if_small(by_zone, groups)
    return (ranked.join(by_zone, ["scheme", "zone"])
            .withColumn("units_in_group", F.col("group_size")).withColumn("group_mean_e9", div(F.col("group_sum"), F.col("group_size")))
            .drop("national_size", "national_sum", "group_size", "group_sum")
            .withColumn("gap_to_group_e9", F.col("need_e9") - F.col("group_mean_e9")))


def supply_degeneracy(score: DataFrame) -> DataFrame:
    """Norm-implied supply cancels: stored people at risk over (rural / norm) is need times norm.

    ``at_risk`` is a rounded-down whole number, so the measured value may lie below the prediction by less than one
    person's share, norm / rural; ``cancels`` is false for anything else.
    """
    wide = "decimal(38,0)"
    measured = F.call_function("div", F.col("at_risk").cast(wide) * E9 * F.col("catchment_norm"), F.col("rural_population").cast(wide))
    prediction = F.col("need_e9") * F.col("catchment_norm")
    gap = (F.col("prediction_e9") - F.col("underservice_e9")).cast(wide)
    out = score.select("unit_id", "scheme", "terrain", "need_e9", "at_risk", "rural_population", "catchment_norm",
                       measured.alias("underservice_e9"), prediction.alias("prediction_e9"))
    cancels = (gap >= 0) & ((gap - 1) * F.col("rural_population") <= F.col("catchment_norm").cast(wide) * E9)
    return out.select("unit_id", "scheme", "terrain", "need_e9", "at_risk", "underservice_e9", "prediction_e9",
                      mul_div("underservice_e9", F.lit(10_000), "prediction_e9").alias("ratio_bp"), cancels.alias("cancels"))


def scheme_distribution(score: DataFrame) -> DataFrame:
    need = F.col("need_e9")
    return score.groupBy("scheme").agg(
        F.count("*").alias("n"), F.min(need).alias("lo_e9"), F.max(need).alias("hi_e9"),
        div(F.sum(need), F.count("*")).alias("mean_e9"),
        F.round(F.stddev_samp(need / float(E9)), 6).alias("sd"))


def scheme_overlap(score: DataFrame, top: int = 25) -> DataFrame:
    """Shared units among the top ranks of each pair of schemes (ties at the edge included)."""
    ranked = rank_desc(score, ["scheme"], "need_e9", "rk")
    heads = ranked.filter(F.col("rk") <= top).select("scheme", "unit_id")
    a, b = heads.alias("a"), heads.alias("b")
    shared = (a.join(b, (F.col("a.unit_id") == F.col("b.unit_id")) & (F.col("a.scheme") < F.col("b.scheme")))
              .groupBy(F.col("a.scheme").alias("scheme_a"), F.col("b.scheme").alias("scheme_b"))
              .agg(F.count("*").alias("shared")))
    schemes = score.select("scheme").distinct()
    pairs = (schemes.alias("a").join(schemes.alias("b"), F.col("a.scheme") < F.col("b.scheme"))
             .select(F.col("a.scheme").alias("scheme_a"), F.col("b.scheme").alias("scheme_b")))
    return pairs.join(shared, ["scheme_a", "scheme_b"], "left").select(
        "scheme_a", "scheme_b", F.coalesce("shared", F.lit(0)).alias("shared"))


def score_export(score: DataFrame, peers: DataFrame, scheme: str) -> DataFrame:
    ranks = peers.filter(F.col("scheme") == scheme).select(
        "unit_id", "national_rank", "group_rank", "gap_to_group_e9")
    return score.filter(F.col("scheme") == scheme).join(ranks, "unit_id")
