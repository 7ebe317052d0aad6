"""Report relations: counts, coverage, floors, name variants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equisite.functions.numbers import div


def labelled_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """One row per relation with its row count."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
             for name, df in relations.items()]
    return reduce(DataFrame.unionByName, parts)


def indicator_coverage(facts: DataFrame, indicators: DataFrame) -> DataFrame:
    """Present, missing, range and mean of each index indicator."""
    v = F.col("value_bp")
    stats = facts.groupBy("indicator_id").agg(
        F.count(v).alias("present"), (F.count("*") - F.count(v)).alias("missing"),
        F.min(v).alias("min_v"), F.max(v).alias("max_v"), div(F.sum(v), F.count(v)).alias("mean_v"))
    return stats.join(indicators.select("indicator_id", "indicator_key", "domain"), "indicator_id")


def below_floor(facts: DataFrame, floor: int) -> DataFrame:
    """Units with fewer present values than the floor."""
    return (facts.groupBy("unit_id").agg(F.count("value_bp").alias("n_present"))
            .filter(F.col("n_present") < floor))


def volume_totals(units: DataFrame, indicators: DataFrame, facts: DataFrame) -> DataFrame:
    """Totals of several relations in one row."""
    return (units.agg(F.count("*").alias("units"), F.sum("rural_population").alias("rural_population"))
            .crossJoin(indicators.agg(F.count("*").alias("indicators")))
            .crossJoin(facts.agg(F.count("*").alias("facts"))))


def conservation(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Per parent: the children's shares against the parent's own total, within one per child."""
    got = children.groupBy("parent_id").agg(
        F.sum("population_alloc").alias("children_total"), F.count("*").alias("n_children"))
    return (got.join(parents.select("parent_id", "parent_population"), "parent_id")
            .withColumn("conserved", F.abs(F.col("children_total") - F.col("parent_population")) <= F.col("n_children")))


def member_flag(df: DataFrame, members: DataFrame, key: str, out: str) -> DataFrame:
    """Whether each row's key occurs among the members."""
    known = members.select(key).distinct().withColumn(out, F.lit(True))
    return df.join(known, key, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def total_check(df: DataFrame, column: str, expected: int, tolerance_bp: int) -> DataFrame:
    """A total against an external figure, within a tolerance in basis points."""
    total = df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("total")).withColumn("expected", F.lit(expected).cast("long"))
    wide = [F.col(c).cast("decimal(19,0)") for c in ("total", "expected")]
    return total.withColumn("within", F.abs(wide[0] - wide[1]) * 10_000 <= wide[1] * tolerance_bp)


def unstable_names(catalogue: DataFrame) -> DataFrame:
    """Indicator numbers that were published under more than one name."""
    return catalogue.filter(F.col("name_variants") > 1)
