"""The driver's tables mapped onto the domain relations (see FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equisite.functions.classify import norm_of, terrain
from equisite.functions.numbers import cents, mul_div_sql
from equisite.operators import index as ix
from equisite.plans import settings as cfg

IDS = cfg.INDICATOR_IDS


def _named(expressions: dict[str, str]) -> list:
    return [F.expr(e).alias(name) for name, e in expressions.items()]


class Domain:
    """Lazily built domain relations over one folder of tables.

    ``measures`` (one row per unit) is what every index query starts from and the only costly
    step. It and the scores are used several times within one plan (a rank counts its input and
    then joins back to it), so they are kept in memory and on disk; a lost block is recomputed.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def groups(self) -> DataFrame:
        """Group dimension: each group lies in exactly one zone."""
        region = self.table("region").select("r_regionkey", F.col("r_name").alias("zone"))
        return (self.table("nation")
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                .select("n_nationkey", F.col("n_name").alias("grp"), "zone"))

    @cached_property
    def unit_dim(self) -> DataFrame:
        return (self.table("customer").select("c_custkey", "c_name", "c_nationkey")
                .join(self.groups, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("unit_id"), F.col("c_name").alias("unit_name"), "grp", "zone"))

    @cached_property
    def order_facts(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey", F.col("o_custkey").alias("unit_id"), F.col("o_orderstatus").alias("status"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
            cents("o_totalprice").alias("cents"))

    @staticmethod
    def _population_aggs() -> dict[str, str]:
        return {"cents": "sum(cents)", "total_hh": "count(*)", "rural_hh": "count_if(status <> 'P')",
                "minority_cents": "coalesce(sum(cents) FILTER (WHERE priority = 1), 0)"}

    @staticmethod
    def _population_columns() -> list[str]:
        return ["cents div 100 AS population", "rural_hh", "total_hh",
                mul_div_sql("minority_cents", 10_000, "cents") + " AS minority_bp",
                mul_div_sql("cents div 100", "rural_hh", "total_hh") + " AS rural_population"]

    @cached_property
    def population(self) -> DataFrame:
        """Population side only, from one pass over the orders."""
        return (self.order_facts.groupBy("unit_id").agg(*_named(self._population_aggs()))
                .selectExpr("unit_id", *self._population_columns()))

    @cached_property
    def measures(self) -> DataFrame:
        """One row per unit: population columns, n1..n7 and v1..v7.

        Line items are first summed per order, which shares the join's partitioning; the unit
        totals then need one more shuffle, with partial sums before it.
        """
        lines = (self.table("lineitem")
                 .select("l_orderkey", cents("l_extendedprice").alias("c"), "l_returnflag", "l_linestatus")
                 .groupBy("l_orderkey").agg(*_named({
                     "lines": "count(*)", "line_cents": "sum(c)",
                     "r_cents": "coalesce(sum(c) FILTER (WHERE l_returnflag = 'R'), 0)",
                     "o_cents": "coalesce(sum(c) FILTER (WHERE l_linestatus = 'O'), 0)"})))
        sums = self._population_aggs()
        for i in range(1, 6):
            sums[f"n{i}"] = f"count_if(priority = {i})"
            sums[f"c{i}"] = f"sum(cents) FILTER (WHERE priority = {i})"
            sums[f"f{i}"] = f"coalesce(sum(cents) FILTER (WHERE priority = {i} AND status = 'F'), 0)"
        sums |= {c: f"sum({c})" for c in ("lines", "line_cents", "r_cents", "o_cents")}
        joined = self.order_facts.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        shares = {**{i: (f"n{i}", f"f{i}", f"c{i}") for i in range(1, 6)},
                  6: ("coalesce(lines, 0)", "r_cents", "line_cents"), 7: ("coalesce(lines, 0)", "o_cents", "line_cents")}
        columns = ["unit_id", *self._population_columns()]
        for i, (n, part, whole) in shares.items():
            columns += [f"{n} AS n{i}", f"{mul_div_sql(part, 10_000, whole)} AS v{i}"]
        return joined.groupBy("unit_id").agg(*_named(sums)).selectExpr(*columns).persist()

    def _with_terrain(self, population: DataFrame) -> DataFrame:
        kind = terrain(F.col("grp"), F.col("minority_bp"), cfg.HILL_GROUPS, cfg.PARAMS["tribal_share_bp"])
        return (self.unit_dim.join(population, "unit_id", "left").withColumn("terrain", kind)
                .withColumn("catchment_norm", norm_of(F.col("terrain"), cfg.NORMS)))

    @cached_property
    def units(self) -> DataFrame:
        """Unit dimension with population, terrain and norm."""
        return self._with_terrain(self.population)

    @cached_property
    def facts(self) -> DataFrame:
        """Long facts (unit, indicator, n, value); a missing indicator has no row."""
        pairs = ", ".join(f"{i}, n{i}, v{i}" for i in IDS)
        return (self.measures.selectExpr("unit_id", f"stack({len(IDS)}, {pairs}) as (indicator_id, n, value_bp)")
                .filter("value_bp is not null"))

    @cached_property
    def indicators(self) -> DataFrame:
        return cfg.indicator_relation(self.spark)

    @cached_property
    def weights(self) -> DataFrame:
        return cfg.weight_relation(self.spark)

    @cached_property
    def score_long(self) -> DataFrame:
        return ix.indicator_score(self.facts, self.indicators)

    @cached_property
    def percentile(self) -> DataFrame:
        return ix.indicator_percentile(self.score_long)

    @cached_property
    def wide(self) -> DataFrame:
        return ix.percentile_wide(self.percentile, IDS)

    @cached_property
    def need(self) -> DataFrame:
        return ix.need_by_vector(self.wide, ix.weights_wide(self.weights, IDS), IDS)

    @cached_property
    def scored_units(self) -> DataFrame:
        """Units with the population taken from ``measures``: no second pass over the orders."""
        return self._with_terrain(self.measures.select(
            "unit_id", "population", "rural_hh", "total_hh", "minority_bp", "rural_population"))

    @cached_property
    def score(self) -> DataFrame:
        return ix.district_score(self.need, self.scored_units).persist()

    @cached_property
    def default_score(self) -> DataFrame:
        """Scores under the default scheme; the percentiles ride along for re-weighting."""
        one = {cfg.DEFAULT_SCHEME: cfg.SCHEMES[cfg.DEFAULT_SCHEME]}
        vectors = ix.weights_wide(cfg.weight_relation(self.spark, one), IDS)
        need = ix.need_by_vector(self.wide, vectors, IDS, keep=[f"p{i}" for i in IDS])
        return ix.district_score(need, self.scored_units).persist()

    @cached_property
    def candidates(self) -> DataFrame:
        """Scored units under the default scheme and objective."""
        return ix.choose_objective(self.default_score, "gain_neutral")


_DOMAINS: dict = {}


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DOMAINS:
        _DOMAINS[key] = Domain(spark, sf_dir)
    return _DOMAINS[key]


# The words part names are made of.
ADJECTIVES = ["small", "large", "red", "blue", "hot", "cold", "old", "new"]
NOUNS = ["ring", "bolt", "gear", "gizmo", "plate", "rod", "anvil", "widget"]


class Names:
    """Name linkage inputs from the part table: parents, and units with perturbed names."""

    def __init__(self, d: Domain):
        self.d = d

    @cached_property
    def parents(self) -> DataFrame:
        return (self.d.table("part").groupBy(F.col("p_type").alias("parent_grp"), F.col("p_name").alias("parent_name"))
                .agg(F.min("p_partkey").alias("parent_code"))
                .select("parent_code", "parent_grp", "parent_name"))

    @cached_property
    def units(self) -> DataFrame:
        """One unit per parent name, perturbed by a rule on the code; equal results are one unit."""
        name, rule = F.col("parent_name"), F.col("parent_code") % 7
        first, second = F.split(name, " ")[0], F.split(name, " ")[1]
        text = (F.when(rule == 1, F.concat_ws(" ", second, first))
                .when(rule == 2, F.concat(F.upper(name), F.lit(" District")))
                .when(rule == 3, F.concat(name, F.substring(name, -1, 1)))
                .when(rule == 4, F.translate(name, "oe", "öé"))
                .when(rule == 5, F.concat(F.when(first == "hot", F.lit("cold ")).otherwise(F.lit("hot ")), second))
                .when(rule == 6, F.concat(F.lit("zqx "), F.substring(second, 1, 3)))
                .otherwise(name))
        return (self.parents.groupBy(F.col("parent_grp").alias("grp"), text.alias("unit_name"))
                .agg(F.min("parent_code").alias("unit_id")).select("unit_id", "grp", "unit_name"))

    @cached_property
    def group_map(self) -> DataFrame:
        """Group to candidate parent groups; one group has two."""
        also = F.when(F.col("grp") == "MEDIUM", F.array("grp", F.lit("LARGE"))).otherwise(F.array("grp"))
        return self.units.select("grp").distinct().withColumn("parent_groups", also)

    @cached_property
    def overrides(self) -> DataFrame:
        rule = F.col("unit_id") % 23
        base = self.units.join(self.parents.select(F.col("parent_code").alias("unit_id"), "parent_name"), "unit_id")
        return base.filter(rule.isin(0, 1, 2, 3)).select(
            "grp", "unit_name", F.col("grp").alias("target_grp"),
            F.when(rule == 1, F.lit("Blue Anvil")).when(rule == 3, F.lit("no such name"))
            .otherwise(F.col("parent_name")).alias("target_name"),
            F.when(rule == 1, F.lit("child_of")).when(rule == 2, F.lit("exclude")).otherwise(F.lit("rename")).alias("rule"),
            F.concat(F.lit("manual row "), rule.cast("string")).alias("override_note"))


SYLLABLES = "ba ker lo min na pur ra sito vu chad".split()


class ManyNames:
    """Names that grow with the data: a made-up parent name per customer, blocked by nation, and a unit per customer whose
    name is that of the parent with its words swapped, a letter missing or one too many, or another one."""

    def __init__(self, d: Domain):
        self.d = d

    @staticmethod
    def word(number: Column) -> Column:
        syllables = F.array(*[F.lit(x) for x in SYLLABLES])
        return F.concat(*[F.get(syllables, (F.floor(number / n) % 10).cast("int")) for n in (100, 10, 1)])

    @cached_property
    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.d.table("customer").select(k.alias("unit_id"), F.col("c_nationkey").cast("string").alias("grp"),
                                               self.word(k * 7919).alias("first"), self.word(k * 31 + 7).alias("second"),
                                               self.word(k * 13 + 5).alias("other"))

    @cached_property
    def parents(self) -> DataFrame:
        return self.customers.select(F.col("unit_id").alias("parent_code"), F.col("grp").alias("parent_grp"),
                                     F.concat_ws(" ", "first", "second").alias("parent_name"))

    @cached_property
    def units(self) -> DataFrame:
        rule = F.col("unit_id") % 4
        text = (F.when(rule == 0, F.concat_ws(" ", "second", "first"))
                .when(rule == 1, F.concat(F.substr("first", F.lit(1), F.length("first") - 1), F.lit(" "), F.col("second")))
                .when(rule == 2, F.concat(F.col("first"), F.lit(" "), F.col("second"), F.lit("x"))).otherwise(F.col("other")))
        return self.customers.select("unit_id", "grp", text.alias("unit_name"))

    @cached_property
    def blocks(self) -> DataFrame:
        return self.customers.select("grp", F.col("grp").alias("parent_grp")).distinct()


class Raw:
    """The verbatim text form of the facts, with its source defects."""

    def __init__(self, d: Domain):
        self.d = d

    @cached_property
    def rows(self) -> DataFrame:
        pairs = ", ".join(f"{i}, coalesce(n{i}, 0), v{i}" for i in IDS)
        long = (self.d.unit_dim.join(self.d.measures, "unit_id", "left")
                .selectExpr("unit_id", "unit_name", "grp", f"stack({len(IDS)}, {pairs}) as (id, n, v)"))
        key = F.element_at(F.create_map(*[F.lit(x) for i, k, _, _ in cfg.INDICATORS for x in (i, k)]), F.col("id"))
        label = F.concat(F.col("id").cast("string"), F.lit(". Share of "), key)
        text = (F.when((F.col("unit_id") % 101 == 0) & (F.col("id") == 7), F.lit("Share without a number"))
                .when(F.col("unit_id") % 97 == 0, F.concat(F.lit("Section header "), label))
                .when((F.col("unit_id") % 5 == 0) & (F.col("id") == 5), F.concat(label, F.lit(" (rev)")))
                .otherwise(label))
        value = (F.when(F.col("n") == 0, F.lit("NA")).when(F.col("n") < 2, F.lit("*"))
                 .otherwise(F.col("v").cast("string")))
        earlier = F.when(F.col("unit_id") % 10 == 0, F.lit("NA")).otherwise(
            (F.coalesce("v", F.lit(0)) + F.col("unit_id") % 100).cast("string"))
        first = long.select("unit_id", "unit_name", "grp", text.alias("indicator_text"), value.alias("value_text"),
                            earlier.alias("earlier_text"), (F.col("unit_id") * 20 + F.col("id")).alias("line"))
        again = first.filter(F.col("unit_id") % 50 == 0).select(
            "unit_id", "unit_name", "grp", "indicator_text", F.lit("NA").alias("value_text"), "earlier_text",
            (F.col("line") + 10).alias("line"))
        return first.unionByName(again)


def _box(a: float, b: float, c: float, d: float) -> list:
    return [[a, b], [c, b], [c, d], [a, d], [a, b]]


# Outlines of the group layer (ordinal, name, rings); the last overlaps earlier ones.
OUTLINES = [
    (1, "Econömy District", [_box(-0.45, -0.45, -0.05, 0.0)]),
    (2, "LARGÉ", [[[-0.05, -0.45], [0.1, -0.45], [0.1, -0.1], [0.05, -0.1], [0.05, 0.0], [-0.05, 0.0], [-0.05, -0.45]]]),
    (3, "Medium Zila", [_box(0.1, -0.45, 0.45, 0.0)]),
    (4, "Promo-Dist", [_box(-0.45, 0.0, -0.05, 0.45), _box(-0.2, 0.05, -0.15, 0.1)]),
    (5, "Smal", [_box(-0.05, 0.0, 0.1, 0.45)]),
    (6, "Standart", [_box(0.1, 0.0, 0.45, 0.45)]),
    (7, "Nowhere", [_box(-0.2, -0.2, 0.2, 0.12)]),
]


class Shapes:
    """Unit polygons around the embedding points, and the group layer."""

    def __init__(self, d: Domain):
        self.d, self.names = d, Names(d)

    @cached_property
    def shapes(self) -> DataFrame:
        """Squares, L shapes and squares with a hole; every twentieth has a second part."""
        e = F.col("embedding")
        rows = self.d.table("embeddings").select(
            F.col("vec_id").alias("shape_id"), e[0].cast("double").alias("x"), e[1].cast("double").alias("y"),
            (F.abs(e[2].cast("double")) / 20 + 0.002).alias("h"))
        x, y, h = F.col("x"), F.col("y"), F.col("h")

        def ring(*points):
            return F.array(*[F.array(a, b) for a, b in points])

        def square(s, dx=0.0):
            return ring((x - s + dx, y - s), (x + s + dx, y - s), (x + s + dx, y + s), (x - s + dx, y + s), (x - s + dx, y - s))

        ell = ring((x - h, y - h), (x + h, y - h), (x + h, y), (x, y), (x, y + h), (x - h, y + h), (x - h, y - h))
        kind = F.col("shape_id") % 3
        rings = (F.when(kind == 0, F.array(square(h))).when(kind == 1, F.array(ell))
                 .otherwise(F.array(square(h), square(h / 2))))
        parts = F.when(F.col("shape_id") % 20 == 0, F.array(rings, F.array(square(h / 4, 0.5)))).otherwise(F.array(rings))
        adjective = F.element_at(F.array(*[F.lit(a) for a in ADJECTIVES]), (F.col("shape_id") % 8 + 1).cast("int"))
        noun = F.element_at(F.array(*[F.lit(n) for n in NOUNS]), (F.floor(F.col("shape_id") / 8) % 8 + 1).cast("int"))
        rule = F.col("shape_id") % 5
        name = (F.when(rule == 1, F.concat_ws(" ", adjective, noun, F.lit("district")))
                .when(rule == 2, F.concat(adjective, F.lit(" "), noun, F.substring(noun, -1, 1)))
                .when(rule == 3, F.concat_ws(" ", noun, adjective))
                .when(rule == 4, F.concat(F.lit("zz"), F.concat_ws(" ", adjective, noun)))
                .otherwise(F.concat_ws(" ", adjective, noun)))
        return rows.select("shape_id", name.alias("shape_name"), parts.alias("parts"))

    @cached_property
    def outlines(self) -> DataFrame:
        rows = [(o, n, [r]) for o, n, r in OUTLINES]
        return cfg.values(self.d.spark, rows, "ordinal int, geo_group string, parts array<array<array<array<double>>>>")

    @cached_property
    def units(self) -> DataFrame:
        return self.names.parents.select(F.col("parent_code").alias("unit_id"), F.col("parent_grp").alias("grp"),
                                         F.col("parent_name").alias("unit_name"))

    @cached_property
    def groups(self) -> DataFrame:
        return self.units.groupBy(F.col("grp").alias("parent_name")).agg(F.min("unit_id").alias("parent_code"))


# Share features of the residual model, as (numerator, denominator).
FEATURES = {
    "rural_hh_share": ("rural_hh", "total_hh"), "urgent_share": ("n1", "total_hh"), "high_share": ("n2", "total_hh"),
    "medium_share": ("n3", "total_hh"), "other_share": ("n4", "total_hh"), "lines_per_ten": ("n6", "total_hh_ten"),
    "rural_population_share": ("rural_population", "population"),
}


class Residual:
    """Inputs of the residual model; the target is the need index, so only identities are expected."""

    def __init__(self, d: Domain):
        self.d = d

    @cached_property
    def features(self) -> DataFrame:
        from equisite.operators.residual import share_features
        wide = self.d.measures.withColumn("total_hh_ten", F.col("total_hh") * 10)
        return share_features(wide, FEATURES, keep=["unit_id"])

    @cached_property
    def frame(self) -> DataFrame:
        from equisite.operators.residual import model_frame
        target = self.d.default_score.select("unit_id", (F.col("need_e9") / 1e9).alias("y"))
        return model_frame(target, self.features, FEATURES)

    @cached_property
    def folded(self) -> DataFrame:
        """Read by every fit, so written: its own plan is deep, and each fit would plan it again."""
        from equisite.operators.residual import assign_folds
        from equisite.plans.session import materialise
        return materialise(assign_folds(self.frame, cfg.SEED), "folded")
