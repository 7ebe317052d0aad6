"""Exact ranks without an unbounded sort in one task.

``rank`` and ``percent_rank`` only need, for each distinct value, how many rows lie below it. The
counts are aggregated first (map-side, so a hot value costs one row per task), summed up over the
distinct values, and joined back. ``row_number`` additionally breaks ties by a whole-number id.
There is one way for data of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equisite.functions.numbers import E9, mul_div
from equisite.plans.bounds import BROADCAST_ROWS
from equisite.plans.session import materialise

RANGE = 1_000_000
"""Values, or ids, of a range that one window runs over."""


def value_counts(df: DataFrame, keys: Sequence[str], value: str, width: int = RANGE, weight: str | None = None) -> DataFrame:
    """One row per (keys, value): ``n`` rows, ``below`` rows with a smaller value, ``total`` rows.

    A row of ``df`` counts ``weight`` times, if given.

    The running sum is split over value ranges of size ``width``: a range holds at most ``width`` distinct whole
    numbers, however many rows share them.
    """
    keys = list(keys)
    rows = F.sum(weight) if weight else F.count("*")
    counts = df.groupBy(*keys, value).agg(rows.alias("n")).withColumn("_range", F.floor(F.col(value) / width))
    ranges = counts.groupBy(*keys, "_range").agg(F.sum("n").alias("_n"))
    over_ranges = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*keys, "_range",
                           F.coalesce(F.sum("_n").over(over_ranges), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy(*keys)).alias("total"))
    inside = (Window.partitionBy(*keys, "_range").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (counts.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(ranges, [*keys, "_range"])
            .select(*keys, value, "n", (F.col("_before") + F.col("_inside")).alias("below"), "total"))


def _cells(df: DataFrame, keys: Sequence[str], value: str, tie_id: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their id range, and one row per (keys, value, id range) with the rows in it.

    Joins back to the rows go through these cells: a value shared by a third of all rows meets its rank in as many
    tasks as it has id ranges.
    """
    rows = df.withColumn("_ids", F.floor(F.col(tie_id) / width))
    return rows, rows.groupBy(*keys, value, "_ids").agg(F.count("*").alias("_cell"))


def rank_desc(df: DataFrame, keys: Sequence[str], value: str, out: str, tie_id: str = "unit_id",
              width: int = RANGE) -> DataFrame:
    """``rank()`` with gaps, highest value first; ``tie_id`` is any whole number that tells rows apart."""
    rows, cells = _cells(df, keys, value, tie_id, width)
    table = value_counts(df, keys, value, width).select(
        *keys, value, (F.col("total") - F.col("below") - F.col("n") + 1).alias(out))
    placed = cells.drop("_cell").join(table, [*keys, value])
    return rows.join(placed, [*keys, value, "_ids"]).drop("_ids").select(*df.columns, out)


def ranks_in_levels(df: DataFrame, levels: dict[str, Sequence[str]], value: str, tie_id: str = "unit_id",
                    width: int = RANGE) -> DataFrame:
    """Ranks on several levels at once: for each ``name: keys`` the columns name_rank (highest first), name_size and
    name_sum (of the values).

    ``df`` is counted once, into cells of (all keys, value, id range), which are written; every level sums them up
    and all levels join back to the rows together, through the same cells.
    """
    keys = list(dict.fromkeys(k for own in levels.values() for k in own))
    rows, cells = _cells(df, keys, value, tie_id, width)
    cells = materialise(cells, "rank-cells")
    placed = cells
    for name, own in levels.items():
        own = list(own)
        table = value_counts(cells, own, value, width, "_cell").select(
            *own, value, (F.col("total") - F.col("below") - F.col("n") + 1).alias(f"{name}_rank"), F.col("total").alias(f"{name}_size"))
        sums = cells.groupBy(*own).agg(F.sum(F.col(value) * F.col("_cell")).alias(f"{name}_sum"))
        placed = placed.join(table, [*own, value]).join(sums, own)
    return rows.join(placed.drop("_cell"), [*keys, value, "_ids"]).drop("_ids")


def percent_rank_e9(df: DataFrame, keys: Sequence[str], value: str, out: str, tie_id: str = "unit_id",
                    width: int = RANGE) -> DataFrame:
    """``percent_rank()`` as a whole number: least gets 0, most gets 10**9.

    The table of distinct values is broadcast when a count shows it to be small (scores in basis points have at most
    10,001 values), so the rows stay where they are; otherwise rows meet it through cells.
    """
    table = value_counts(df, keys, value, width).select(
        *keys, value, mul_div("below", F.lit(E9), F.greatest(F.col("total") - 1, F.lit(1))).alias(out))
    distinct = df.select(*keys, value).distinct()
    if distinct.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(table), [*keys, value]).select(*df.columns, out)
    rows, cells = _cells(df, keys, value, tie_id, width)
    placed = cells.drop("_cell").join(table, [*keys, value])
    return rows.join(placed, [*keys, value, "_ids"]).drop("_ids").select(*df.columns, out)


def order_rank(df: DataFrame, keys: Sequence[str], value: str, tie_id: str, out: str, width: int = RANGE) -> DataFrame:
    """``row_number()``, highest value first, ties by ascending whole-number id.

    A row's place is the rows with a higher value, plus the rows of its value in lower id ranges, plus its place
    inside its id range, which holds at most ``width`` ids.
    """
    keys = list(keys)
    rows, cells = _cells(df, keys, value, tie_id, width)
    higher = value_counts(df, keys, value, width).select(
        *keys, value, (F.col("total") - F.col("below") - F.col("n")).alias("_higher"))
    lower = (Window.partitionBy(*keys, value).orderBy("_ids")
             .rowsBetween(Window.unboundedPreceding, -1))
    base = (cells.withColumn("_lower", F.coalesce(F.sum("_cell").over(lower), F.lit(0)))
            .join(higher, [*keys, value])
            .select(*keys, value, "_ids", (F.col("_higher") + F.col("_lower")).alias("_base")))
    inside = Window.partitionBy(*keys, value, "_ids").orderBy(tie_id)
    return (rows.join(base, [*keys, value, "_ids"])
            .withColumn(out, (F.col("_base") + F.row_number().over(inside)).cast("long"))
            .select(*df.columns, out))


def keep_first(df: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """First row per key under an explicit order.

    An aggregate, not a window: partial minima are taken before the shuffle, so a key with very
    many copies never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ranked).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
            .select(*df.columns))


def top_n(df: DataFrame, value: str, n: int, tie_id: str, ascending: bool = False) -> DataFrame:
    """The n rows with the highest (or lowest) value; each task ships at most n rows."""
    first = F.col(value).asc() if ascending else F.col(value).desc()
    return df.orderBy(first, F.col(tie_id)).limit(n)


def top_k_per_group(df: DataFrame, keys: Sequence[str], value: str, k: int, tie_id: str,
                    out: str = "place") -> DataFrame:
    """The k best rows per group; the filter next to the window limits groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(tie_id))
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)
