"""Allocate a fixed budget under per-group caps and per-zone floors.

Groups nest in zones, so the integer optimum needs no solver: keep the best ``cap`` units of each
group (any subset of them satisfies every cap), force the best ``floor`` of each zone, fill up with
the best of the rest. Nesting and feasibility are decided by counts per group, taken from all candidates
inside the same plan. Every window filter sits next to its window, so tasks ship at most ``cap``
rows per group and the last pass sees ``zones x budget`` rows, however many units there are. The
same plan runs per key (for example per weight draw) when ``keys`` is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equisite.functions.numbers import div
from equisite.operators.ranking import top_n


def _best(key: str, *before) -> list:
    return [*before, F.col(key).desc(), F.col("unit_id")]


def _survivors(candidates: DataFrame, cap: int, budget: int, key: str, keys: Sequence[str]) -> DataFrame:
    """Best units of each group within the cap; a group can never supply more than the budget."""
    w = Window.partitionBy(*keys, "grp").orderBy(*_best(key))
    return (candidates.withColumn("_g", F.row_number().over(w))
            .filter(F.col("_g") <= min(cap, budget)).drop("_g"))


def group_sizes(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates per group and its zone; fails, while it runs, on a group that lies in two zones.

    One partial aggregate over all candidates: of the size of the group dimension (times ``keys``).
    """
    nested = F.min("zone").eqNullSafe(F.max("zone"))
    message = F.concat(F.lit("group "), F.coalesce(F.col("grp"), F.lit("null")), F.lit(" lies in zones "),
                       F.min("zone"), F.lit(" and "), F.max("zone"))
    return candidates.groupBy(*keys, "grp").agg(
        F.when(nested, F.min("zone")).otherwise(F.raise_error(message)).alias("zone"), F.count("*").alias("_n"))


def conditions(candidates: DataFrame, budget: int, cap: int, floor: int, keys: Sequence[str]) -> DataFrame:
    """One row per problem, from counts alone: usable units, forced units, smallest zone, feasibility.

    Zones are those of all candidates; a unit is usable if its group's cap leaves room for it.
    """
    usable = F.sum(F.least(F.col("_n"), F.lit(cap)))
    zones = group_sizes(candidates, keys).groupBy(*keys, "zone").agg(usable.alias("_in_zone"))
    forced = F.sum(F.least(F.col("_in_zone"), F.lit(floor)))
    return zones.groupBy(*keys).agg(F.sum("_in_zone").alias("usable"), forced.alias("forced"),
                                    F.min("_in_zone").alias("smallest_zone")).withColumn(
        "feasible", (F.col("usable") >= budget) & (F.col("forced") <= budget) & (F.col("smallest_zone") >= floor))


def _in_zones(candidates: DataFrame, budget: int, cap: int, key: str, keys: Sequence[str]) -> DataFrame:
    """Survivors with their place in the zone. A zone never gives more than the budget, and gives
    its best, so places beyond the budget are dropped: what follows sees zones x budget rows."""
    by_zone = Window.partitionBy(*keys, "zone")
    return (_survivors(candidates, cap, budget, key, keys)
            .withColumn("_z", F.row_number().over(by_zone.orderBy(*_best(key))))
            .filter(F.col("_z") <= budget))


def _checked(rows: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of feasible problems. ``facts`` has one row per problem; without keys it is a single row."""
    own = [k for k in keys if k in facts.columns]
    good = facts.filter("feasible").select(*own, "feasible")
    joined = rows.join(good, own) if own else rows.crossJoin(F.broadcast(good))
    return joined.drop("feasible")


def optimal(candidates: DataFrame, budget: int, cap: int, floor: int, gain: str = "gain",
            keys: Sequence[str] = (), facts: DataFrame | None = None) -> DataFrame:
    """The exact optimum; no rows for an infeasible problem (see ``status``), an error if groups do not nest.

    ``facts`` are conditions already known: problems over the same candidates share one row of them.
    """
    facts = conditions(candidates, budget, cap, floor, keys) if facts is None else facts
    ranked = _in_zones(candidates, budget, cap, gain, keys).withColumn("_forced", F.col("_z") <= floor)
    w = Window.partitionBy(*keys).orderBy(*_best(gain, F.col("_forced").desc()))
    best = ranked.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= budget)
    return _checked(best, facts, keys).select(*candidates.columns)


def status(candidates: DataFrame, budget: int, cap: int, floor: int, keys: Sequence[str] = ()) -> DataFrame:
    """One row per problem: Optimal or Infeasible, the conditions that fail, and what they were measured on."""
    reason = F.concat_ws(",", F.when(F.col("usable") < budget, F.lit("budget")), F.when(F.col("forced") > budget, F.lit("floors")),
                         F.when(F.col("smallest_zone") < floor, F.lit("zone")))
    good = F.coalesce("feasible", F.lit(False))
    return conditions(candidates, budget, cap, floor, keys).select(
        *keys, F.when(good, F.lit("Optimal")).otherwise(F.lit("Infeasible")).alias("status"),
        F.when(F.col("usable").isNull(), F.lit("budget")).otherwise(reason).alias("reason"), "usable", "forced", "smallest_zone")


def naive(candidates: DataFrame, budget: int) -> DataFrame:
    """Top of the need ranking, constraints ignored."""
    return _numbered(top_n(candidates, "need_e9", budget, "unit_id"), "need_e9")


def bound(candidates: DataFrame, budget: int, gain: str = "gain") -> DataFrame:
    """Top of the objective, constraints ignored: no feasible pick can beat it."""
    return _numbered(top_n(candidates, gain, budget, "unit_id"), gain)


def _numbered(picks: DataFrame, key: str) -> DataFrame:
    """Pick order; sees at most ``budget`` rows."""
    return picks.withColumn("pick_rank", F.row_number().over(Window.orderBy(*_best(key))).cast("long"))


def greedy(candidates: DataFrame, budget: int, cap: int, floor: int, sort_by: str = "gain",
           keys: Sequence[str] = ()) -> DataFrame:
    """Walk the order within the cap, then repair zones below the floor.

    The repair in relations: zone shortfalls are met by that zone's next survivors (zones in name
    order, best first); places are freed by the lowest picks among those beyond the floor of their
    zone. The i-th added unit takes the place of the i-th freed one; swaps end when either side
    runs out.
    """
    # a join with the groups runs the nesting check without moving the survivors
    nested = group_sizes(candidates, keys).groupBy(*keys).agg(F.count("zone").alias("_groups"))
    base = _in_zones(candidates, budget, cap, sort_by, keys)
    base = (base.join(nested, list(keys)) if keys else base.crossJoin(F.broadcast(nested))).filter("_groups >= 0")
    whole, by_zone = Window.partitionBy(*keys), Window.partitionBy(*keys, "zone")
    walked = (base.withColumn("_place", F.row_number().over(whole.orderBy(*_best(sort_by))))
              .withColumn("_picked", F.col("_place") <= budget)
              .withColumn("_have", F.count_if("_picked").over(by_zone)))
    spare = F.col("_picked") & (F.col("_z") > floor)
    wanted = ~F.col("_picked") & (F.col("_z") > F.col("_have")) & (F.col("_z") <= floor)
    marked = walked.withColumn("_role", F.when(spare, F.lit("spare")).when(wanted, F.lit("wanted"))
                               .otherwise(F.when(F.col("_picked"), F.lit("kept"))))
    marked = marked.filter(F.col("_role").isNotNull())
    by_role = Window.partitionBy(*keys, "_role")
    order_out = by_role.orderBy(F.col(sort_by).asc(), F.col("unit_id").desc())
    order_in = by_role.orderBy("zone", F.col(sort_by).desc(), "unit_id")
    marked = marked.withColumn("_swap", F.when(F.col("_role") == "spare", F.row_number().over(order_out))
                               .when(F.col("_role") == "wanted", F.row_number().over(order_in)))
    pair = Window.partitionBy(*keys, "_swap")
    is_spare, is_wanted = F.col("_role") == "spare", F.col("_role") == "wanted"
    paired = (marked.withColumn("_slot", F.max(F.when(is_spare, F.col("_place"))).over(pair))
              .withColumn("_adds", F.count_if(is_wanted).over(pair)))
    stays = (F.col("_role") == "kept") | (is_spare & (F.col("_adds") == 0))
    enters = is_wanted & F.col("_slot").isNotNull()
    return (paired.filter(stays | enters)
            .withColumn("pick_rank", F.when(enters, F.col("_slot")).otherwise(F.col("_place")).cast("long"))
            .select(*candidates.columns, "pick_rank"))


def check_feasible(picks: DataFrame, candidate_zones: DataFrame, budget: int, cap: int,
                   floor: int) -> DataFrame:
    """Violation rows (rule, subject, found, required); empty means feasible.

    Zones come from the candidates, so a zone without any pick is reported. ``picks`` has at most
    a budget of rows.
    """
    spent = picks.agg(F.count("*").alias("found")).filter(F.col("found") != budget).select(
        F.lit("budget").alias("rule"), F.lit("all").alias("subject"), "found", F.lit(budget).alias("required"))
    over = picks.groupBy("grp").agg(F.count("*").alias("found")).filter(F.col("found") > cap).select(
        F.lit("cap").alias("rule"), F.col("grp").alias("subject"), "found", F.lit(cap).alias("required"))
    counts = picks.groupBy("zone").agg(F.count("*").alias("found"))
    under = (candidate_zones.select("zone").distinct().join(counts, "zone", "left")
             .withColumn("found", F.coalesce("found", F.lit(0))).filter(F.col("found") < floor)
             .select(F.lit("floor").alias("rule"), F.col("zone").alias("subject"), "found",
                     F.lit(floor).alias("required")))
    out = spent.unionByName(over).unionByName(under)
    return out.withColumn("required", F.col("required").cast("long"))


def stack(scenarios: dict[str, DataFrame]) -> DataFrame:
    """Picks of all scenarios in one relation; a set without an order has no pick rank."""
    out = None
    for name, df in scenarios.items():
        if "pick_rank" not in df.columns:
            df = df.withColumn("pick_rank", F.lit(None).cast("long"))
        df = df.select(F.lit(name).alias("scenario"), "scheme", "unit_id", "grp", "zone", "terrain",
                       "pick_rank", "need_e9", "gain", "rural_population")
        out = df if out is None else out.unionByName(df)
    return out


def summary(picks: DataFrame, cap: int) -> DataFrame:
    """Totals per scenario, the fullest group, and the groups above the cap."""
    per_group = picks.groupBy("scenario", "scheme", "grp").agg(F.count("*").alias("n"))
    fullest = per_group.groupBy("scenario", "scheme").agg(F.max("n").alias("max_in_any_group"))
    totals = picks.groupBy("scenario", "scheme").agg(
        F.count("*").alias("facilities"), F.count_distinct("grp").alias("groups_covered"),
        F.count_distinct("zone").alias("zones_covered"), F.sum("gain").alias("total_gain"),
        F.sum("rural_population").alias("rural_population_in_selected"),
        F.count_if(F.col("terrain") != "plains").alias("hilly_or_tribal_picks"))
    return (totals.join(fullest, ["scenario", "scheme"])
            .join(over_cap_labels(per_group, cap), ["scenario", "scheme"], "left"))


def over_cap_labels(per_group: DataFrame, cap: int) -> DataFrame:
    """``GROUP (n), ...`` by falling count; one short line per scenario."""
    return (per_group.filter(F.col("n") > cap)
            .withColumn("label", F.concat("grp", F.lit(" ("), F.col("n").cast("string"), F.lit(")")))
            .groupBy("scenario", "scheme")
            .agg(F.expr("listagg(label, ', ') WITHIN GROUP (ORDER BY n DESC, grp)").alias("groups_over_cap")))


def over_cap_groups(picks: DataFrame, cap: int) -> DataFrame:
    return (picks.groupBy("scenario", "grp").agg(F.count("*").alias("n")).filter(F.col("n") > cap))


def premiums(picks: DataFrame) -> DataFrame:
    """The optimum against each other scenario, in basis points of that scenario's gain."""
    names = ["optimal", "greedy_feasible", "greedy_by_need", "naive_top", "unconstrained_bound"]
    totals = picks.groupBy("scheme").agg(
        *[F.sum(F.when(F.col("scenario") == n, F.col("gain"))).alias(n) for n in names])

    def against(other: str):
        return div((F.col("optimal") - F.col(other)) * 10_000, other)

    return totals.select(
        "scheme", against("greedy_feasible").alias("vs_greedy_bp"),
        against("greedy_by_need").alias("vs_wrong_key_bp"), against("naive_top").alias("vs_naive_bp"),
        against("unconstrained_bound").alias("price_of_equity_bp"))


def terrain_mix(picks: DataFrame, budget: int) -> DataFrame:
    """Picks per scenario and terrain, flagged when every pick is plains."""
    counts = picks.groupBy("scenario", "terrain").agg(F.count("*").alias("n"))
    return counts.withColumn("all_plains", (F.col("terrain") == "plains") & (F.col("n") == budget))


def picks_changed(a: DataFrame, b: DataFrame) -> DataFrame:
    """How many picks differ between two selections of one size: half the symmetric difference."""
    left = a.select("unit_id", F.lit(1).alias("in_a"))
    right = b.select("unit_id", F.lit(1).alias("in_b"))
    both = left.join(right, "unit_id", "full")
    lonely = F.count_if(F.col("in_a").isNull() | F.col("in_b").isNull())
    return both.agg(div(lonely, F.lit(2)).alias("changed"),
                    F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("shared"))
