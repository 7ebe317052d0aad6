"""Thinning that keeps common borders common.

Rings are cut at junctions, the vertices where not all rings run the same way. What lies between two junctions is an arc,
and neighbours share it vertex by vertex. An arc is simplified by Douglas-Peucker in a direction that depends on its
vertices alone, so both sides of a border keep the same ones without ever being brought together: the only shuffle is
that of vertices, which finds the junctions.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equisite.plans.session import materialise

RING = ["shape_id", "part", "ring"]


def ring_rows(shapes: DataFrame) -> DataFrame:
    """One row per ring, its points as they are."""
    return (shapes.select("shape_id", F.posexplode("parts").alias("part", "rings"))
            .select("shape_id", "part", F.posexplode("rings").alias("ring", "points")))


def _closed() -> Column:
    return (F.size("points") > 3) & (F.element_at("points", 1) == F.element_at("points", -1))


def ring_vertices(rings: DataFrame) -> DataFrame:
    """Vertices of closed rings by place, each with its two neighbours in the ring, the smaller first."""
    n = F.size("points") - 1

    def vertex(i: Column) -> Column:
        at, after = F.get("points", i), F.get("points", i + 1)
        before = F.get("points", F.pmod(i - 1, n))
        return F.struct(i.alias("seq"), at[0].alias("x"), at[1].alias("y"),
                        F.least(before, after).alias("low"), F.greatest(before, after).alias("high"))
    rows = rings.filter(_closed()).withColumn("v", F.explode(F.transform(F.sequence(F.lit(0), n - 1), vertex)))
    return rows.select(*RING, "v.*")


def ring_places(rings: DataFrame) -> DataFrame:
    """Vertices of closed rings by place."""
    rows = rings.filter(_closed()).select(*RING, F.posexplode(F.slice("points", F.lit(1), F.size("points") - 1)).alias("seq", "at"))
    return rows.select(*RING, "seq", F.col("at")[0].alias("x"), F.col("at")[1].alias("y"))


def junctions(vertices: DataFrame) -> DataFrame:
    """(x, y) that rings enter or leave in different ways, or where a ring turns back on itself.

    Two extremes of every coordinate of the neighbours tell whether all their pairs are the same, so a vertex of very many
    rings is summed before the shuffle, and numbers, unlike arrays, are summed without a sort. What a coordinate does not tell
    (one that is missing, further ones of a point) a hash of the pair does.
    """
    parts = {"ax": F.col("low")[0], "ay": F.col("low")[1], "bx": F.col("high")[0], "by": F.col("high")[1], "pair": F.xxhash64("low", "high")}
    flat = vertices.select("x", "y", (F.col("low") == F.col("high")).alias("turns"), *[c.alias(k) for k, c in parts.items()])
    ways = flat.groupBy("x", "y").agg(F.max("turns").alias("turns"), *[f(k).alias(f"{k}_{f.__name__}") for k in parts for f in (F.min, F.max)])
    differs = reduce(Column.__or__, [~F.col(f"{k}_min").eqNullSafe(F.col(f"{k}_max")) for k in parts])
    return ways.filter(differs | F.col("turns")).select("x", "y")


def _farthest(px: np.ndarray, py: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """Squared distance and place of the inner vertex farthest from the chord; the first of equal ones."""
    ax, ay = px[low], py[low]
    dx, dy = px[high] - ax, py[high] - ay
    ex, ey = px[low + 1:high] - ax, py[low + 1:high] - ay
    length = dx * dx + dy * dy
    t = np.clip((ex * dx + ey * dy) / length, 0.0, 1.0) if length > 0 else np.zeros(len(ex))
    rx, ry = ex - t * dx, ey - t * dy
    far = rx * rx + ry * ry
    k = int(np.argmax(far))
    return float(far[k]), low + 1 + k


FEW = 64
"""Vertices up to which plain numbers are faster than arrays."""


def _farthest_of_few(px: list[float], py: list[float], low: int, high: int) -> tuple[float, int]:
    """``_farthest``, by the same operations on plain numbers."""
    ax, ay = px[low], py[low]
    dx, dy = px[high] - ax, py[high] - ay
    length = dx * dx + dy * dy
    most, at = -1.0, low + 1
    for k in range(low + 1, high):
        ex, ey = px[k] - ax, py[k] - ay
        t = min(max((ex * dx + ey * dy) / length, 0.0), 1.0) if length > 0 else 0.0
        rx, ry = ex - t * dx, ey - t * dy
        far = rx * rx + ry * ry
        if far > most:
            most, at = far, k
    return most, at


def arc_kept(px: np.ndarray, py: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices of an arc stay.

    Both ends and the farthest vertex always do, and of a closed arc also the farthest vertex of each half: so a ring of two
    arcs, or of one, does not collapse into a line. No vertex that goes is farther than the tolerance from what stays.
    """
    last = len(px) - 1
    kept = np.zeros(last + 1, dtype=bool)
    kept[[0, last]] = True
    forced = 2 if px[0] == px[last] and py[0] == py[last] else 1
    farthest = _farthest
    if last < FEW and max(np.abs(px).max(), np.abs(py).max()) < 1e100:  # larger ones can overflow
        px, py, farthest = px.tolist(), py.tolist(), _farthest_of_few
    todo = [(0, last, 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2:
            continue
        far, k = farthest(px, py, low, high)
        if depth < forced or far > tolerance * tolerance:
            kept[k] = True
            todo += [(low, k, depth + 1), (k, high, depth + 1)]
    return kept


def _backwards(px: np.ndarray, py: np.ndarray) -> bool:
    """Whether the vertices are less when read from the end."""
    differs = np.flatnonzero((px != px[::-1]) | (py != py[::-1]))
    if not len(differs):
        return False
    a, b = differs[0], len(px) - 1 - differs[0]
    return (px[b], py[b]) < (px[a], py[a])


def ring_kept(x: np.ndarray, y: np.ndarray, cuts: np.ndarray, tolerance: float) -> np.ndarray:
    """Places of a closed ring's vertices that stay; ``cuts`` are the places of its junctions.

    A ring without a junction starts at its least vertex, so that an island and the hole around it agree.
    """
    n = len(x) - 1
    starts = np.sort(cuts) if len(cuts) else np.lexsort((y[:n], x[:n]))[:1]
    kept = np.zeros(n, dtype=bool)
    for i, start in enumerate(starts):
        end = starts[i + 1] if i + 1 < len(starts) else starts[0] + n
        at = np.arange(start, end + 1) % n
        if _backwards(x[at], y[at]):
            at = at[::-1]
        kept[at[arc_kept(x[at], y[at], tolerance)]] = True
    return np.flatnonzero(kept)


def simplified_rings(shapes: DataFrame, tolerance: float) -> DataFrame:
    """One row per ring: its key, ``points`` and the places ``kept``.

    Rings that do not close, have fewer than four points or a coordinate that is null or no number keep all points. Rings are
    written when this is called: four steps read them, and shapes may be costly to make.
    """
    rings = materialise(ring_rows(shapes), "rings")
    cuts = ring_places(rings).join(junctions(ring_vertices(rings)), ["x", "y"]).groupBy(*RING).agg(F.collect_list("seq").alias("cuts"))

    @F.pandas_udf("array<int>")
    def places(x: pd.Series, y: pd.Series, cut: pd.Series) -> pd.Series:
        none = np.zeros(0, dtype=int)
        out = []
        for xs, ys, c in zip(x, y, cut):
            xs, ys = np.asarray(xs, dtype=float), np.asarray(ys, dtype=float)
            whole = np.isfinite(xs).all() and np.isfinite(ys).all()
            out.append(ring_kept(xs, ys, none if c is None else np.asarray(c, dtype=int), tolerance) if whole else np.arange(len(xs) - 1))
        return pd.Series(out, dtype=object)

    xs, ys = F.transform("points", lambda p: p[0]), F.transform("points", lambda p: p[1])
    all_places = F.when(F.size("points") > 0, F.sequence(F.lit(0), F.size("points") - 1)).otherwise(F.array().cast("array<int>"))
    closed = rings.filter(_closed()).join(cuts, RING, "left").select(*RING, "points", places(xs, ys, F.col("cuts")).alias("kept"))
    return closed.unionByName(rings.filter(~F.coalesce(_closed(), F.lit(False))).select(*RING, "points", all_places.alias("kept")))


def simplified_vertices(shapes: DataFrame, tolerance: float) -> DataFrame:
    """One row per vertex that stays (a closed ring's end is not repeated)."""
    rows = simplified_rings(shapes, tolerance).select(*RING, "points", F.explode("kept").alias("seq"))
    at = F.get("points", F.col("seq"))
    return rows.select(*RING, "seq", at[0].alias("x"), at[1].alias("y"))


def simplified(shapes: DataFrame, tolerance: float) -> DataFrame:
    """(shape_id, parts) with thinned rings, for export; parts and rings keep their order."""
    first = F.get("points", F.get("kept", F.lit(0)))
    points = F.transform("kept", lambda i: F.get("points", i))
    points = F.when(_closed(), F.concat(points, F.array(first))).otherwise(points)
    rings = simplified_rings(shapes, tolerance).select(*RING, points.alias("points"))

    def in_order(column: str, *value: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(column, *value))), lambda s: s[value[0]])
    parts = rings.groupBy("shape_id", "part").agg(in_order("ring", "points").alias("rings"))
    return parts.groupBy("shape_id").agg(in_order("part", "rings").alias("parts"))
