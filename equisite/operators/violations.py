"""Constraints as queries: rows (rule, key, detail) for whatever breaks a rule; empty means valid.

A NULL outcome passes, as in an SQL CHECK, unless the rule says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rows(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.alias("detail"))


def unique(df: DataFrame, rule: str, keys: Sequence[str]) -> DataFrame:
    """Keys are counted with partial sums; the copies themselves never meet. NULL keys pass."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.filter(present).groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    return _rows(counts, rule, F.concat_ws("|", *[F.col(k).cast("string") for k in keys]),
                 F.concat(F.col("_n").cast("string"), F.lit(" rows")))


def foreign_key(df: DataFrame, rule: str, key: str, column: str, parent: DataFrame,
                parent_column: str | None = None) -> DataFrame:
    known = parent.select(F.col(parent_column or column).alias(column)).distinct()
    orphans = df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
    return _rows(orphans, rule, F.col(key), F.col(column).cast("string"))


def not_null(df: DataFrame, rule: str, key: str, column: str) -> DataFrame:
    return _rows(df.filter(F.col(column).isNull()), rule, F.col(key), F.lit(f"{column} is null"))


def holds(df: DataFrame, rule: str, key: str, condition: Column, detail: Column,
          null_passes: bool = True) -> DataFrame:
    return _rows(df.filter(~F.coalesce(condition, F.lit(null_passes))), rule, F.col(key), detail)


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rule_counts(rules: dict[str, DataFrame]) -> DataFrame:
    """How many rows break each rule, rules that hold included."""
    return all_of(*[df.agg(F.count("*").alias("broken")).select(F.lit(name).alias("rule"), "broken")
                    for name, df in rules.items()])


def weight_sums(weights: DataFrame, total_ppm: int = 1_000_000) -> DataFrame:
    sums = weights.groupBy("scheme").agg(F.sum("w_ppm").alias("_s"))
    return holds(sums, "weights sum to one", "scheme", F.col("_s") == total_ppm, F.col("_s").cast("string"))


def weight_cover(weights: DataFrame, indicators: DataFrame) -> DataFrame:
    """Every scheme names exactly the index indicators."""
    wanted = weights.select("scheme").distinct().crossJoin(indicators.select("indicator_id"))
    missing = wanted.join(weights, ["scheme", "indicator_id"], "left_anti")
    extra = weights.join(indicators, "indicator_id", "left_anti").select("scheme", "indicator_id")
    out = missing.unionByName(extra)
    return _rows(out, "scheme covers the index", F.col("scheme"), F.col("indicator_id").cast("string"))


def sensitivity_rules(sens: DataFrame) -> DataFrame:
    return all_of(
        holds(sens, "classification known", "unit_id", F.col("classification").isin("robust", "contested", "excluded"),
              F.col("classification"), null_passes=False),
        holds(sens, "stability is a share", "unit_id",
              F.col("times_in_top_n").between(0, F.col("draws")) & F.col("times_allocated").between(0, F.col("runs")),
              F.col("times_in_top_n").cast("string")))


def standing_rules(units: DataFrame, indicators: DataFrame, weights: DataFrame, facts: DataFrame,
                   score: DataFrame, norms: dict[str, int]) -> dict[str, DataFrame]:
    """Keys, references, ranges and implications of the derived relations, by rule."""
    kind = F.col("terrain")
    norm_of = F.create_map(*[F.lit(x) for kv in norms.items() for x in kv])
    specified = F.col("indicator_key").isNotNull() & F.col("domain").isNotNull() & F.col("higher_is_worse").isNotNull()
    text = lambda c: F.col(c).cast("string")
    rules = {
        "unit key": unique(units, "unit key", ["unit_id"]),
        "unit natural key": unique(units, "unit natural key", ["grp", "unit_name"]),
        "indicator key": unique(indicators, "indicator key", ["indicator_key"]),
        "fact key": unique(facts, "fact key", ["unit_id", "indicator_id"]),
        "weight key": unique(weights, "weight key", ["scheme", "indicator_id"]),
        "score key": unique(score, "score key", ["scheme", "unit_id"]),
        "fact unit": foreign_key(facts, "fact unit", "indicator_id", "unit_id", units),
        "fact indicator": foreign_key(facts, "fact indicator", "unit_id", "indicator_id", indicators),
        "unit zone": not_null(units, "unit zone", "unit_id", "zone"),
        "unit terrain": not_null(units, "unit terrain", "unit_id", "terrain"),
        "indicator range": holds(indicators, "indicator range", "indicator_id", F.col("indicator_id").between(1, 104), text("indicator_id")),
        "index member specified": holds(indicators, "index member specified", "indicator_id", specified, text("indicator_key"), False),
        "terrain known": holds(units, "terrain known", "unit_id", kind.isin(list(norms)), kind),
        "norm agrees with terrain": holds(units, "norm agrees with terrain", "unit_id", F.col("catchment_norm") == F.try_element_at(norm_of, kind), kind),
        "rural within total": holds(units, "rural within total", "unit_id", F.col("rural_population") <= F.col("population"), text("rural_population")),
        "weight not negative": holds(weights, "weight not negative", "scheme", F.col("w_ppm") >= 0, text("w_ppm"), False),
        "value in range": holds(facts, "value in range", "unit_id", F.col("value_bp").between(0, 10_000), text("value_bp")),
    }
    rules["weights sum to one"] = weight_sums(weights)
    rules["scheme covers the index"] = weight_cover(weights, indicators)
    return rules


def apportioned_rule(units: DataFrame) -> DataFrame:
    return holds(units, "apportioned means siblings", "unit_id",
                 F.col("is_apportioned") == (F.col("n_sharing_parent") > 1), F.col("n_sharing_parent").cast("string"))
