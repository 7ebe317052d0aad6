"""Polygons: edges, interior points, point-in-polygon join, name crosswalk, thinning.

A shape is one row; ``parts`` holds its polygons, each a list of rings of [x, y]. Per-shape work
stays inside the row (no shuffle); only the spatial join and the name match move data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equisite.operators import linkage as lk
from equisite.plans.bounds import BROADCAST_ROWS, broadcast_if_small
from equisite.plans.session import materialise

MAP_ACCEPT, GROUP_ACCEPT = 82, 70
EDGES_OF_A_CELL, FINEST = 16, 5
"""Edges that a polygon has per halving of its cells, and halvings at most."""

BUSY_POINTS = 100_000
"""Points of a cell that one task decides when cells are not broadcast."""

FIRST_POLYGONS = 4096
"""Polygons of the first round of a spatial join."""


def _ring_edges(ring: Column) -> Column:
    def edge(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        return F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2"))
    # a ring without an edge has none; it does not take those of the other rings with it
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    edges = F.transform(F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1))), edge)
    return F.when(F.size(ring) > 1, edges).otherwise(none)


def with_edges(shapes: DataFrame) -> DataFrame:
    """Add all edges, holes included, and the bounding box."""
    edges = F.flatten(F.transform(F.flatten("parts"), _ring_edges))
    out = shapes.withColumn("edges", edges)
    xs, ys = F.transform("edges", lambda e: e["x1"]), F.transform("edges", lambda e: e["y1"])
    return (out.withColumn("xmin", F.array_min(xs)).withColumn("xmax", F.array_max(xs))
            .withColumn("ymin", F.array_min(ys)).withColumn("ymax", F.array_max(ys)))


def polygon_edges(shapes: DataFrame) -> DataFrame:
    """One row per edge, keyed by part, ring and sequence."""
    return (shapes.select("shape_id", F.posexplode("parts").alias("part", "rings"))
            .select("shape_id", "part", F.posexplode("rings").alias("ring", "points"))
            .select("shape_id", "part", "ring", F.posexplode(_ring_edges(F.col("points"))).alias("seq", "e"))
            .select("shape_id", "part", "ring", "seq", "e.*"))


def _crosses(e: Column, y: Column) -> Column:
    """Half-open rule: a vertex on the line belongs to one of its two edges only."""
    return (e["y1"] <= y) != (e["y2"] <= y)


def _x_at(e: Column, y: Column) -> Column:
    return e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])


def _stretches(edges: Column, y: Column) -> Column:
    """Inner stretches of the horizontal line at ``y``: (width, -left, middle, height)."""
    xs = F.array_sort(F.transform(F.filter(edges, lambda e: _crosses(e, y)), lambda e: _x_at(e, y)))
    starts = F.filter(xs, lambda x, i: i % 2 == 0)
    ends = F.filter(xs, lambda x, i: i % 2 == 1)
    return F.zip_with(starts, ends, lambda a, b: F.struct((b - a).alias("width"), (-a).alias("left"),
                                                         ((a + b) / 2).alias("mid"), y.alias("height")))


def interior_point(shapes: DataFrame) -> DataFrame:
    """A point inside each shape: the middle of the widest inner stretch of a level line.

    The line is that at mid height; where it meets nothing (parts apart from each other, flat shapes), all lines
    midway between neighbouring vertex heights are tried. Unlike a centroid the point cannot fall outside a concave
    shape or into a hole. Only a shape without area has none.
    """
    boxed = with_edges(shapes)
    middle = _stretches(F.col("edges"), (F.col("ymin") + F.col("ymax")) / 2)
    heights = F.array_sort(F.array_distinct(F.transform("edges", lambda e: e["y1"])))
    between = F.zip_with(F.slice(heights, F.lit(1), F.greatest(F.size(heights) - 1, F.lit(0))),
                         F.slice(heights, F.lit(2), F.greatest(F.size(heights) - 1, F.lit(0))), lambda a, b: (a + b) / 2)
    any_line = F.flatten(F.transform(between, lambda y: _stretches(F.col("edges"), y)))
    best = F.coalesce(F.array_max(middle), F.array_max(F.when(F.size(middle) == 0, any_line)))
    return boxed.withColumn("_best", best).withColumn("px", F.col("_best.mid")).withColumn("py", F.col("_best.height")).drop("_best")


def contains(edges: str, x: Column, y: Column) -> Column:
    """Even-odd parity of the edges to the right of the point."""
    hits = F.size(F.filter(edges, lambda e: _crosses(e, y) & (x < _x_at(e, y))))
    return hits % 2 == 1


def _range(low: Column, high: Column, side: Column) -> Column:
    """Numbers of the cells between two places; a side is a power of two, so the division is exact."""
    return F.sequence(F.floor(low / side), F.floor(high / side))


def _turns(e: Column, x: Column, y: Column, right: Column) -> Column:
    """What an edge near a cell adds to the parity of a point in it; ``right`` is the cell's right side.

    Edges that lie wholly to the right of the cell count as crossed wherever their ends lie on two sides of the point's height.
    Over a chain of them all inner ends cancel, and its outer ends are ends of edges near the cell: those are counted here.
    """
    def end(ex: Column, ey: Column) -> Column:
        return (e["closed"] & (ex > right) & (ey <= y)).cast("int")
    return (_crosses(e, y) & (x < _x_at(e, y))).cast("int") + end(e["x1"], e["y1"]) + end(e["x2"], e["y2"])


def _parity(edges: Column, x: Column, y: Column, right: Column) -> Column:
    return F.aggregate(edges, F.lit(0), lambda n, e: n + _turns(e, x, y, right)) % 2


def polygon_cells(polygons: DataFrame) -> DataFrame:
    """(_side, _cx, _cy, ordinal, near, base): the cells of every polygon that hold a part of it.

    A polygon has a grid of its own size, the finer the more edges it has. ``near`` are the edges that meet the cell (none:
    the cell is wholly inside), ``base`` the parity that goes with them, known from the cell's middle. Edges are rows here,
    so a polygon with very many of them is no large task.
    """
    ring = F.struct(_ring_edges(F.col("ring")).alias("edges"), (F.element_at("ring", 1) == F.element_at("ring", -1)).alias("closed"))
    rings = (polygons.select("ordinal", F.explode(F.flatten("parts")).alias("ring")).filter(F.size("ring") > 1).select("ordinal", ring.alias("r")))
    rows = rings.select("ordinal", "r.closed", F.explode("r.edges").alias("e")).select("ordinal", "closed", "e.*")
    lows, highs = F.least, F.greatest
    boxes = rows.groupBy("ordinal").agg(
        F.min(lows("x1", "x2")).alias("xmin"), F.max(highs("x1", "x2")).alias("xmax"), F.min(lows("y1", "y2")).alias("ymin"),
        F.max(highs("y1", "y2")).alias("ymax"), F.count("*").alias("n"))
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(1e-12))
    finer = F.least(F.greatest(F.floor(F.log2(F.col("n") / EDGES_OF_A_CELL)), F.lit(0)), F.lit(FINEST))
    boxes = boxes.select("ordinal", "xmin", "xmax", extent.alias("_extent"),
                         F.pow(F.lit(2.0), (F.ceil(F.log2(extent)) - finer).cast("double")).alias("_side"))
    side = F.col("_side")
    edges = rows.join(boxes, "ordinal")
    # where an edge is crossed is rounded: what ends just beside a cell is near it too
    blur = F.col("_extent") * 1e-12 + F.greatest(F.abs("x1"), F.abs("x2")) * 1e-14
    # a line that does not close has nothing to cancel it: all cells on its left count it
    left = F.when(F.col("closed"), lows("x1", "x2") - blur).otherwise(F.col("xmin"))
    near = (edges.withColumn("_cx", F.explode(_range(left, highs("x1", "x2") + blur, side)))
            .withColumn("_cy", F.explode(_range(lows("y1", "y2"), highs("y1", "y2"), side)))
            .groupBy("ordinal", "_side", "_cx", "_cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2", "closed")).alias("near")))
    level = (edges.withColumn("_cy", F.explode(_range(lows("y1", "y2"), highs("y1", "y2"), side)))
             .withColumn("_y", (F.col("_cy") + 0.5) * side))
    e = F.struct("x1", "y1", "x2", "y2")
    crossed = level.filter(_crosses(e, F.col("_y"))).groupBy("ordinal", "_side", "_cy", "xmin", "xmax").agg(F.collect_list(_x_at(e, F.col("_y"))).alias("xs"))
    middles = (crossed.withColumn("_cx", F.explode(_range(F.col("xmin"), F.col("xmax"), side)))
               .withColumn("_x", (F.col("_cx") + 0.5) * side)
               .withColumn("middle", F.size(F.filter("xs", lambda x: F.col("_x") < x)) % 2)
               .select("ordinal", "_side", "_cx", "_cy", "middle"))
    cells = near.join(middles.filter("middle = 1"), ["ordinal", "_side", "_cx", "_cy"], "full").withColumn(
        "near", F.coalesce("near", F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double,closed:boolean>>")))
    at = [(F.col(c) + 0.5) * side for c in ("_cx", "_cy")]
    base = (F.coalesce("middle", F.lit(0)) + _parity(F.col("near"), *at, (F.col("_cx") + 1) * side)) % 2
    return cells.select("_side", "_cx", "_cy", "ordinal", "near", base.alias("base"))


def _round_ends(polygons: DataFrame) -> list:
    """Ordinals at which rounds end: the first has about ``FIRST_POLYGONS`` polygons, every other one as many as all before it."""
    n = polygons.count()
    halvings = max(0, (max(n, 1) // FIRST_POLYGONS).bit_length() - 1)
    if not halvings:
        return []
    shares = [0.5 ** i for i in range(halvings, 0, -1)]
    ends = polygons.agg(F.percentile_approx("ordinal", shares, 100_000).alias("ends")).head()["ends"]
    return sorted(set(ends or []))


def _first_found(points: DataFrame, cells: DataFrame, point_id: str) -> DataFrame:
    """(point_id, ordinal): the first of the cells' polygons that contains the point; points in none are left out."""
    weight = cells.agg(F.coalesce(F.sum(F.size("near") + 1), F.lit(0)).alias("n")).head()["n"]
    sides = [r[0] for r in cells.select("_side").distinct().collect()]  # powers of two between the layer's sizes
    placed = (points.filter("px IS NOT NULL AND py IS NOT NULL").select(point_id, "px", "py")
              .withColumn("_side", F.explode(F.array(*[F.lit(x) for x in sides]).cast("array<double>")))
              .withColumn("_cx", F.floor(F.col("px") / F.col("_side"))).withColumn("_cy", F.floor(F.col("py") / F.col("_side"))))
    cell = ["_side", "_cx", "_cy"]
    if weight <= BROADCAST_ROWS:
        met = placed.join(F.broadcast(cells), cell)
    else:
        busy = placed.groupBy(*cell).agg(F.count("*").alias("_n")).filter(F.col("_n") > BUSY_POINTS)
        busy = materialise(busy.select(*cell, F.ceil(F.col("_n") / BUSY_POINTS).cast("int").alias("_salts")), "busy-cells")
        dealt = cells.join(busy, cell, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
        salted = (placed.join(broadcast_if_small(busy), cell, "left")
                  .withColumn("_salt", F.pmod(F.xxhash64(point_id), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts"))
        met = salted.join(dealt, [*cell, "_salt"])
    inside = (F.col("base") + _parity(F.col("near"), F.col("px"), F.col("py"), (F.col("_cx") + 1) * F.col("_side"))) % 2 == 1
    return met.filter(inside).groupBy(point_id).agg(F.min("ordinal").alias("ordinal"))


def spatial_join(points: DataFrame, polygons: DataFrame, point_id: str, name: str) -> DataFrame:
    """Left join each point (px, py) to the first polygon (by ``ordinal``) that contains it.

    Polygons become cells (``polygon_cells``): a point meets the cell it lies in, of each grid that the layer uses, and is
    decided there by the few edges near the cell, or by none in a cell that lies inside. Cells are broadcast if a count of
    their edges shows them to be few; otherwise cells with very many points are dealt to several tasks. Points without a
    place take no part in the joins. Matches are reduced by a minimum, per task before the shuffle.

    A layer of many polygons is met in rounds by ordinal, each with as many polygons as all before it. A point that is found
    leaves, so where polygons lie on top of each other a point meets about as many as stand before its first, not all.
    """
    cells = materialise(polygon_cells(polygons.select("ordinal", "parts")), "cells")
    ends, left, parts = _round_ends(polygons), points, []
    for low, high in zip([None, *ends], [*ends, None]):
        own = cells if low is None else cells.filter(F.col("ordinal") > low)
        own = own if high is None else own.filter(F.col("ordinal") <= high)
        parts.append(_first_found(left, own, point_id))
        if high is None:
            break
        parts[-1] = materialise(parts[-1], "first-found")
        left = materialise(left.select(point_id, "px", "py").join(parts[-1], point_id, "left_anti"), "points-left")
    first = reduce(DataFrame.unionByName, parts)
    named = first.join(polygons.select("ordinal", F.col(name).alias("_name")), "ordinal").select(point_id, F.col("_name").alias(name))
    return points.select(point_id).distinct().join(named, point_id, "left")


def group_map(geo_groups: DataFrame, groups: DataFrame, accept: int = GROUP_ACCEPT) -> DataFrame:
    """Best domain group for each polygon-layer group name, from ``accept`` percent up.

    ``geo_groups`` has geo_group; ``groups`` has (parent_code, parent_name). Both are dimensions.
    """
    left = geo_groups.select(F.col("geo_group").alias("unit_id"), F.lit("all").alias("grp"),
                             F.col("geo_group").alias("unit_name"))
    pool = groups.select("parent_code", F.lit("all").alias("parent_grp"), "parent_name")
    blocks = groups.select(F.lit("all").alias("grp"), F.lit("all").alias("parent_grp")).limit(1)
    best = lk.best_match(left, pool, blocks)
    return best.select(F.col("unit_id").alias("geo_group"), "score_e4",
                       F.when(F.col("score_e4") >= accept * 10_000, F.col("parent_name")).alias("grp"))


def name_crosswalk(shapes: DataFrame, units: DataFrame, qualifiers: Sequence[str],
                   accept: int = MAP_ACCEPT) -> DataFrame:
    """Match shapes (shape_id, shape_name, geo_group, grp) to units of their group, then make it 1:1.

    Runs what it matches, and stops if a unit is still claimed by two shapes.
    """
    pool = units.select(F.col("unit_id").alias("parent_code"), F.col("grp").alias("parent_grp"),
                        F.col("unit_name").alias("parent_name"))
    blocks = units.select("grp").distinct().withColumn("parent_grp", F.col("grp"))
    matched = lk.with_tiers(lk.best_match(shapes, pool, blocks, id_col="shape_id", name="shape_name"),
                            accept, accept, qualifiers)
    note = (F.when(F.col("grp").isNull(), F.lit("NO_GROUP"))
            .when(F.col("parent_code").isNull(), F.lit("NO_UNITS")).otherwise(F.col("note")))
    rows = matched.select("shape_id", "shape_name", "geo_group", "grp", F.col("match_code").alias("unit_id"),
                          F.col("match_e4").alias("score_e4"), note.alias("note"))
    out = materialise(lk.one_to_one(materialise(rows, "map-matches")), "map-crosswalk")
    claims = out.filter(F.col("unit_id").isNotNull()).groupBy("unit_id").agg(F.count("*").alias("n"))
    require_one_to_one(claims.agg(F.count_if(F.col("n") > 1).alias("shared_ids")))
    return out


def geo_coverage(xwalk: DataFrame, units: DataFrame, warn_pct: int = 80) -> DataFrame:
    """Polygons, resolved groups, matches, units covered, releases and shared ids in one row."""
    shared = (xwalk.filter(F.col("unit_id").isNotNull()).groupBy("unit_id").agg(F.count("*").alias("n"))
              .agg(F.count("*").alias("units_covered"), F.count_if(F.col("n") > 1).alias("shared_ids")))
    return (xwalk.agg(F.count("*").alias("polygons"), F.count("geo_group").alias("group_resolved"),
                      F.count("unit_id").alias("matched"), F.count_if("released").alias("released"))
            .crossJoin(shared).crossJoin(units.agg(F.count("*").alias("units")))
            .withColumn("below_warning", F.col("units_covered") * 100 < F.col("units") * warn_pct))


def require_one_to_one(coverage: DataFrame) -> None:
    """A unit claimed by two polygons would overstate its footprint and stops the run."""
    if coverage.select("shared_ids").head()["shared_ids"]:
        raise ValueError("a unit is claimed by more than one polygon")


def _snapped(ring: Column, tolerance: float) -> Column:
    grid = F.transform(ring, lambda p: F.struct(F.floor(p[0] / tolerance + 0.5).alias("gx"),
                                                F.floor(p[1] / tolerance + 0.5).alias("gy")))
    return F.filter(grid, lambda v, i: (i == 0) | (v != F.try_element_at(grid, i)))


def _grid_box(ring: Column) -> Column:
    """The grid box around a snapped ring, at least one cell wide and high."""
    def corner(x: Column, y: Column) -> Column:
        return F.struct(x.alias("gx"), y.alias("gy"))
    xs, ys = F.transform(ring, lambda v: v["gx"]), F.transform(ring, lambda v: v["gy"])
    x0, y0 = F.array_min(xs), F.array_min(ys)
    x1, y1 = F.greatest(F.array_max(xs), x0 + 1), F.greatest(F.array_max(ys), y0 + 1)
    return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))


def _thinned_parts(tolerance: float) -> Column:
    """Parts with snapped rings. A hole below four vertices is gone; an outer ring below four becomes the grid box
    around it, so that no part and no shape vanishes."""
    def part(rings: Column) -> Column:
        snapped = F.transform(rings, lambda ring: _snapped(ring, tolerance))
        solid = F.transform(snapped, lambda ring, i: F.when((i == 0) & (F.size(ring) < 4), _grid_box(ring)).otherwise(ring))
        return F.filter(solid, lambda ring: F.size(ring) >= 4)
    return F.transform("parts", part)


def thin_rings(shapes: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Vertices snapped to a grid of the tolerance, repeats and degenerate rings dropped; one row per kept vertex."""
    return (shapes.select("shape_id", F.posexplode(_thinned_parts(tolerance)).alias("part", "rings"))
            .select("shape_id", "part", F.posexplode("rings").alias("ring", "points"))
            .select("shape_id", "part", "ring", F.posexplode("points").alias("seq", "v"))
            .select("shape_id", "part", "ring", "seq", "v.gx", "v.gy"))


def thinned(shapes: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Shapes with thinned ``parts``, for export."""
    def point(v: Column) -> Column:
        return F.array(v["gx"] * tolerance, v["gy"] * tolerance)
    return shapes.withColumn("parts", F.transform(_thinned_parts(tolerance), lambda rings: F.transform(
        rings, lambda ring: F.transform(ring, point))))


def map_relation(units: DataFrame, xwalk: DataFrame, selected: DataFrame) -> DataFrame:
    """Units with a polygon, and whether the allocation chose them."""
    shape_of = xwalk.filter(F.col("unit_id").isNotNull()).select("unit_id", "shape_id")
    chosen = selected.select("unit_id", F.lit(True).alias("selected"))
    return (units.join(shape_of, "unit_id").join(chosen, "unit_id", "left")
            .withColumn("selected", F.coalesce("selected", F.lit(False))))
