"""Re-score, re-rank and re-allocate under assumptions chosen at run time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equisite.functions.numbers import div
from equisite.operators import allocation as al
from equisite.operators.index import choose_objective, need_by_vector, weights_wide, with_gains
from equisite.operators.ranking import rank_desc


def renormalise(raw: DataFrame, total: int = 1_000_000) -> DataFrame:
    """Raw weights (scheme, indicator_id, raw) to parts per million; an all-zero vector stays zero."""
    sums = raw.groupBy("scheme").agg(F.coalesce(F.nullif(F.sum("raw"), F.lit(0)), F.lit(1)).alias("_s"))
    return raw.join(sums, "scheme").select(
        "scheme", "indicator_id", div(F.col("raw") * total, F.col("_s")).alias("w_ppm"))


def rescore(base: DataFrame, weights: DataFrame, ids: Sequence[int], objective: str) -> DataFrame:
    """Need and gains of the base units under one weight vector, with the chosen objective as gain."""
    need = need_by_vector(base, weights_wide(weights, ids), ids,
                          keep=["unit_name", "grp", "zone", "terrain", "catchment_norm", "rural_population"])
    return choose_objective(with_gains(need), objective)


def solve(scored: DataFrame, budget: int, cap: int, floor: int) -> DataFrame:
    """The optimal picks with their overall rank."""
    ranked = rank_desc(scored, ["scheme"], "need_e9", "national_rank")
    return al.optimal(ranked, budget, cap, floor)


def solve_status(scored: DataFrame, budget: int, cap: int, floor: int) -> DataFrame:
    """Why a setting has no picks: status and reason beside what was asked for."""
    return al.status(scored, budget, cap, floor).select(
        "status", "reason", F.lit(budget).cast("long").alias("budget"), F.lit(cap).cast("long").alias("cap"),
        F.lit(floor).cast("long").alias("floor_"), "usable", "forced", "smallest_zone")


def headline(picks: DataFrame, scored: DataFrame, budget: int) -> DataFrame:
    """Facilities, groups, zones, non-plains picks, and the gain against the unconstrained list."""
    naive = al.naive(scored, budget).agg(F.sum("gain").alias("naive_gain"))
    return (picks.agg(F.count("*").alias("facilities"), F.count_distinct("grp").alias("groups"),
                      F.count_distinct("zone").alias("zones"),
                      F.count_if(F.col("terrain") != "plains").alias("hilly_or_tribal"),
                      F.sum("gain").alias("gain"))
            .crossJoin(naive)
            .withColumn("gap_bp", div((F.col("gain") - F.col("naive_gain")) * 10_000, F.col("naive_gain"))))


def compare(strategies: dict[str, DataFrame], zones: DataFrame, budget: int, cap: int, floor: int) -> DataFrame:
    """One row per strategy: gain, spread, and the constraints it breaks.

    A strategy has at most a budget of picks; they are kept, because each measure reads them.
    """
    rows = []
    for name, picks in strategies.items():
        picks = picks.persist()
        fullest = picks.groupBy("grp").agg(F.count("*").alias("n")).agg(F.max("n").alias("max_in_one_group"))
        broken = al.check_feasible(picks, zones, budget, cap, floor)
        label = F.concat(F.col("rule"), F.lit(" "), F.col("subject"), F.lit(": "), F.col("found").cast("string"))
        texts = broken.select("rule", "subject", label.alias("label")).agg(
            F.expr("listagg(label, '; ') WITHIN GROUP (ORDER BY rule, subject)").alias("violations"))
        rows.append(picks.agg(F.sum("gain").alias("gain"), F.count_distinct("grp").alias("groups"),
                              F.count_distinct("zone").alias("zones"))
                    .crossJoin(fullest).crossJoin(texts)
                    .withColumn("feasible", F.col("violations").isNull())
                    .withColumn("strategy", F.lit(name)))
    return reduce(DataFrame.unionByName, rows)


def with_confidence(picks: DataFrame, sens: DataFrame) -> DataFrame:
    """Picks with the stored stability of the default settings, in percent."""
    stored = sens.filter(F.col("regime") == "centred").select(
        "unit_id", div(F.col("times_allocated") * 100, F.col("runs")).alias("stability_pct"), "classification")
    return picks.join(stored, "unit_id", "left")
