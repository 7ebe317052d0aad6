"""Threshold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def terrain(group: Column, minority_bp: Column, hill_groups: Sequence[str], tribal_bp: int) -> Column:
    """Hill groups first, then a large minority share, else plains; a missing share counts as 0."""
    return (F.when(group.isin(list(hill_groups)), F.lit("hilly"))
            .when(F.coalesce(minority_bp, F.lit(0)) >= tribal_bp, F.lit("tribal"))
            .otherwise(F.lit("plains")))


def norm_of(terrain_col: Column, norms: dict[str, int]) -> Column:
    """Catchment norm by terrain; an unknown terrain gives NULL."""
    table = F.create_map(*[F.lit(x) for kv in norms.items() for x in kv])
    return F.try_element_at(table, terrain_col).cast("long")


def stability(times: Column, runs: Column, robust_pct: int = 95, excluded_pct: int = 5) -> Column:
    """Strictly above / strictly below, compared without division; no run at all is excluded."""
    return (F.when(100 * times > robust_pct * runs, F.lit("robust"))
            .when((100 * times < excluded_pct * runs) | (runs == 0), F.lit("excluded"))
            .otherwise(F.lit("contested")))
