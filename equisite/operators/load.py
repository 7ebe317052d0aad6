"""From verbatim text rows to the indicator catalogue and the typed fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equisite.functions.numbers import leading_number, lenient, missing_flag
from equisite.operators.ranking import keep_first


def parse_rows(raw: DataFrame) -> DataFrame:
    return raw.withColumn("indicator_id", leading_number("indicator_text"))


def in_range(parsed: DataFrame, low: int = 1, high: int = 104) -> DataFrame:
    return parsed.filter(F.col("indicator_id").isNotNull() & F.col("indicator_id").between(low, high))


def modal_name(parsed: DataFrame) -> DataFrame:
    """Most frequent name per indicator number, smallest on ties, and how many names there are.

    Names are counted first, so the second step sees distinct names, not rows.
    """
    counts = in_range(parsed).groupBy("indicator_id", "indicator_text").agg(F.count("*").alias("n"))
    best = F.struct((-F.col("n")).alias("n"), F.col("indicator_text").alias("t"))
    return counts.groupBy("indicator_id").agg(
        F.min(best)["t"].alias("name_as_published"), F.count("*").alias("name_variants"))


def catalogue(parsed: DataFrame, indicators: DataFrame) -> DataFrame:
    """One row per indicator number seen; index members carry key, domain and direction."""
    return (modal_name(parsed).join(indicators, "indicator_id", "left")
            .withColumn("in_index", F.col("indicator_key").isNotNull()))


def unparsed(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.count_if(F.col("indicator_id").isNull()).alias("unparsed"))


def fact_build(parsed: DataFrame, units: DataFrame) -> DataFrame:
    """Typed facts: known units, numbers in range, lenient values, first row per key.

    ``line`` is the source order, so "first" does not depend on how the scan was split.
    """
    typed = in_range(parsed).select(
        "grp", "unit_name", "indicator_id", "line", lenient("value_text", "long").alias("value_bp"),
        lenient("earlier_text", "long").alias("earlier_bp"), missing_flag("value_text").alias("flag"))
    joined = typed.join(units.select("unit_id", "unit_name", "grp"), ["grp", "unit_name"])
    rows = joined.select("unit_id", "indicator_id", "value_bp", "earlier_bp", "flag", "line")
    return keep_first(rows, ["unit_id", "indicator_id"], "line").drop("line")


def load_audit(counts: DataFrame, files: DataFrame) -> DataFrame:
    """Which file, which checksum, how many rows, when."""
    return counts.join(files, "filename", "left").withColumn("loaded_at", F.current_timestamp())
