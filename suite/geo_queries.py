"""Polygons and the map crosswalk."""

from pyspark.sql import functions as F

from equisite.operators import geo, topology
from equisite.plans.session import fresh_path, materialise
from equisite.sources import files
from fixtures import ADJECTIVES, NOUNS, OUTLINES, Shapes
from suite import prelude as pre
from suite.allocation_queries import SCENARIOS, optimal
from suite.prelude import NAMES, sql
from suite.topic import topic

QUERIES, ORACLES, register = topic()


def _ring(points):
    return "[" + ", ".join(f"[{a}, {b}]" for a, b in points) + "]"


def _square(s, dx="0.0::DOUBLE"):
    return _ring([(f"x - {s} + {dx}", f"y - {s}"), (f"x + {s} + {dx}", f"y - {s}"), (f"x + {s} + {dx}", f"y + {s}"),
                  (f"x - {s} + {dx}", f"y + {s}"), (f"x - {s} + {dx}", f"y - {s}")])


_ELL = _ring([("x - h", "y - h"), ("x + h", "y - h"), ("x + h", "y"), ("x", "y"), ("x", "y + h"), ("x - h", "y + h"), ("x - h", "y - h")])
_PICK = lambda words, i: "[" + ", ".join(f"'{w}'" for w in words) + f"][{i} + 1]"
_OUTLINES = " UNION ALL ".join(
    f"SELECT {o} AS ordinal, '{n}' AS geo_group, [{', '.join(_ring([(f'{a}::DOUBLE', f'{b}::DOUBLE') for a, b in r]) for r in rings)}] AS rings"
    for o, n, rings in OUTLINES)

_SHAPES = {
    "sh_xy": """SELECT vec_id AS shape_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y,
        abs(embedding[3]::DOUBLE) / 20 + 0.002::DOUBLE AS h FROM embeddings""",
    "sh_rings": f"""SELECT shape_id, x, y, h, CASE shape_id % 3 WHEN 0 THEN [{_square('h')}] WHEN 1 THEN [{_ELL}]
        ELSE [{_square('h')}, {_square('h / 2')}] END AS rings FROM sh_xy""",
    "sh": f"""SELECT shape_id, CASE shape_id % 5 WHEN 1 THEN a || ' ' || n || ' district' WHEN 2 THEN a || ' ' || n || right(n, 1)
        WHEN 3 THEN n || ' ' || a WHEN 4 THEN 'zz' || a || ' ' || n ELSE a || ' ' || n END AS shape_name,
        CASE WHEN shape_id % 20 = 0 THEN [rings, [{_square('h / 4', '0.5::DOUBLE')}]] ELSE [rings] END AS parts
        FROM (SELECT *, {_PICK(ADJECTIVES, '(shape_id % 8)')} AS a, {_PICK(NOUNS, '(shape_id // 8 % 8)')} AS n FROM sh_rings)""",
    "sh_ring": """SELECT shape_id, part, i - 1 AS ring, rings[i] AS points FROM (
        SELECT shape_id, p - 1 AS part, parts[p] AS rings FROM (SELECT *, unnest(range(1, length(parts) + 1)) AS p FROM sh)) t,
        LATERAL (SELECT unnest(range(1, length(t.rings) + 1)) AS i)""",
    "sh_point": "SELECT shape_id, part, ring, seq - 1 AS seq, points[seq][1] AS x, points[seq][2] AS y FROM (SELECT *, unnest(range(1, length(points) + 1)) AS seq FROM sh_ring)",
    "sh_edge": """SELECT * FROM (SELECT shape_id, part, ring, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM sh_point
        WINDOW w AS (PARTITION BY shape_id, part, ring ORDER BY seq)) WHERE x2 IS NOT NULL""",
    "sh_mid": "SELECT shape_id, (min(y1) + max(y1)) / 2 AS py FROM sh_edge GROUP BY 1",
    "sh_hit": """SELECT shape_id, py, x, row_number() OVER w AS k, lead(x) OVER w AS x_next FROM (
        SELECT e.shape_id, py, x1 + (py - y1) * (x2 - x1) / (y2 - y1) AS x FROM sh_edge e JOIN sh_mid USING (shape_id) WHERE (y1 <= py) <> (y2 <= py))
        WINDOW w AS (PARTITION BY shape_id ORDER BY x)""",
    "sh_inner": """SELECT shape_id, (x + x_next) / 2 AS px, py FROM sh_hit WHERE k % 2 = 1
        QUALIFY row_number() OVER (PARTITION BY shape_id ORDER BY x_next - x DESC, x) = 1""",
    "ol": _OUTLINES,
    "ol_edge": """SELECT * FROM (SELECT ordinal, geo_group, r, points[k][1] AS x1, points[k][2] AS y1, points[k + 1][1] AS x2, points[k + 1][2] AS y2
        FROM (SELECT ordinal, geo_group, r, points, unnest(range(1, length(points))) AS k
              FROM (SELECT ordinal, geo_group, r, rings[r] AS points FROM (SELECT *, unnest(range(1, length(rings) + 1)) AS r FROM ol))))""",
    "sh_state": """SELECT i.shape_id, h.geo_group FROM sh_inner i LEFT JOIN (
        SELECT shape_id, ordinal, geo_group FROM sh_inner JOIN ol_edge ON (y1 <= py) <> (y2 <= py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)
        GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1 QUALIFY row_number() OVER (PARTITION BY shape_id ORDER BY ordinal) = 1) h USING (shape_id)""",
}
_CROSSWALK = {
    **NAMES, **_SHAPES,
    "gm_cand": f"""SELECT geo_group, parent_grp, code, {pre.sorted_tokens(pre.normalised('geo_group'))} AS a, {pre.sorted_tokens(pre.normalised('parent_grp'))} AS b
        FROM (SELECT DISTINCT geo_group FROM sh_state WHERE geo_group IS NOT NULL), (SELECT parent_grp, min(parent_code) AS code FROM nm_parent GROUP BY 1)""",
    "sg": f"""SELECT s.shape_id, s.shape_name, t.geo_group, g.grp, {pre.normalised('shape_name')} AS norm, {pre.sorted_tokens(pre.normalised('shape_name'))} AS a
        FROM sh s JOIN sh_state t USING (shape_id) LEFT JOIN gm g USING (geo_group)""",
    "gx_cand": f"""SELECT s.*, parent_code, parent_name, {pre.normalised('parent_name')} AS parent_norm, {pre.sorted_tokens(pre.normalised('parent_name'))} AS b
        FROM sg s JOIN nm_parent ON parent_grp = s.grp""",
}
_QL, _QR = pre.qualifiers("norm", ADJECTIVES), pre.qualifiers("parent_norm", ADJECTIVES)
_SIM = pre.similarity_ctes("all_pairs")
# the pair list needs the group map, which needs scores of the group pairs: scored in two rounds
_SIM_G = {k + "_g": v.replace("lcs_run", "lcs_run_g").replace("all_pairs", "gm_cand") for k, v in _SIM.items()}
_SIM_X = {k + "_x": v.replace("lcs_run", "lcs_run_x").replace("all_pairs", "gx_cand") for k, v in _SIM.items()}
_XW = {
    **NAMES, **_SHAPES, "gm_cand": _CROSSWALK["gm_cand"], **_SIM_G,
    "gm": """SELECT geo_group, score_e4, CASE WHEN score_e4 >= 700000 THEN parent_grp END AS grp FROM gm_cand JOIN scores_g USING (a, b)
        QUALIFY row_number() OVER (PARTITION BY geo_group ORDER BY score_e4 DESC, code) = 1""",
    "sg": _CROSSWALK["sg"], "gx_cand": _CROSSWALK["gx_cand"], **_SIM_X,
    "gx_best": """SELECT * FROM gx_cand JOIN scores_x USING (a, b)
        QUALIFY row_number() OVER (PARTITION BY shape_id ORDER BY score_e4 DESC, parent_code) = 1""",
    "gx_all": f"""SELECT s.shape_id, s.shape_name, s.geo_group, s.grp,
          CASE WHEN ok THEN parent_code END AS unit_id, CASE WHEN ok THEN score_e4 END AS score_e4,
          CASE WHEN s.grp IS NULL THEN 'NO_GROUP' WHEN b.shape_id IS NULL THEN 'NO_UNITS' ELSE b.note END AS note
        FROM sg s LEFT JOIN (SELECT shape_id, parent_code, score_e4, score_e4 >= 820000 AND {_QL} = {_QR} AS ok,
            CASE WHEN score_e4 >= 820000 AND {_QL} <> {_QR} THEN 'SIBLING|' || parent_name || '|' || score_e4
                 WHEN score_e4 < 820000 THEN 'BELOW|' || parent_name || '|' || score_e4 END AS note
          FROM gx_best) b USING (shape_id)""",
    "gx_win": """SELECT unit_id, shape_id AS win, shape_name AS win_name FROM gx_all WHERE unit_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY score_e4 DESC, shape_id) = 1""",
    "gx": """SELECT shape_id, shape_name, geo_group, grp, CASE WHEN shape_id = win THEN unit_id END AS unit_id,
          CASE WHEN shape_id = win THEN score_e4 END AS score_e4,
          CASE WHEN shape_id <> win THEN 'TAKEN|' || win_name ELSE note END AS note,
          coalesce(shape_id <> win, false) AS released FROM gx_all LEFT JOIN gx_win USING (unit_id)""",
}


def points_of(s: Shapes):
    """Interior points, written: a join reads them twice, and each is a search over a shape's edges."""
    return materialise(geo.interior_point(s.shapes).select("shape_id", "px", "py"), "points")


def located(s: Shapes):
    """Each shape's interior point in the group layer, written once: three steps read it."""
    return materialise(geo.spatial_join(points_of(s), s.outlines, "shape_id", "geo_group"), "located")


def groups_of(s: Shapes, where):
    return geo.group_map(where.select("geo_group").dropna().distinct(), s.groups)


def resolved(s: Shapes):
    """Shapes with the group layer's polygon they lie in and the domain group it stands for."""
    where = located(s)
    groups = materialise(groups_of(s, where).select("geo_group", "grp"), "group-map")
    return (s.shapes.select("shape_id", "shape_name").join(where, "shape_id")
            .join(groups, "geo_group", "left"))


def crosswalk(s: Shapes):
    return geo.name_crosswalk(resolved(s), s.units, ADJECTIVES).withColumn(
        "released", F.coalesce("released", F.lit(False)))


_EDGE = ["shape_id", "part", "ring", "seq", "x1", "y1", "x2", "y2"]


@register("polygon_edges", sql(f"SELECT {', '.join(_EDGE)} FROM sh_edge", **_SHAPES))
def _(d):
    edges = geo.polygon_edges(Shapes(d).shapes)
    return edges.select("shape_id", *[F.col(c).cast("long").alias(c) for c in ("part", "ring", "seq")], "x1", "y1", "x2", "y2")


@register("interior_point", sql("SELECT shape_id, px, py FROM sh_inner", **_SHAPES))
def _(d):
    return geo.interior_point(Shapes(d).shapes).select("shape_id", "px", "py")


@register("spatial_join_shapes", sql("""SELECT i.shape_id, h.found FROM sh_inner i LEFT JOIN (SELECT shape_id, min(other) AS found FROM (
      SELECT p.shape_id, e.shape_id AS other FROM sh_inner p JOIN sh_edge e ON (y1 <= py) <> (y2 <= py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)
      GROUP BY 1, 2 HAVING count(*) % 2 = 1) GROUP BY 1) h USING (shape_id)""", **_SHAPES))
def _(d):
    """The shapes as a layer of their own: thousands of small, overlapping polygons."""
    s = Shapes(d)
    layer = s.shapes.select(F.col("shape_id").alias("ordinal"), F.col("shape_id").alias("found"), "parts")
    return geo.spatial_join(points_of(s), layer, "shape_id", "found")


@register("spatial_join", sql("SELECT shape_id, geo_group FROM sh_state", **_SHAPES))
def _(d):
    s = Shapes(d)
    return geo.spatial_join(points_of(s), s.outlines, "shape_id", "geo_group")


@register("group_map", sql("SELECT geo_group, score_e4, grp FROM gm", recursive=True, **_XW))
def _(d):
    s = Shapes(d)
    return groups_of(s, located(s))


@register("geo_crosswalk", sql("SELECT shape_id, shape_name, geo_group, grp, unit_id, score_e4, note FROM gx", recursive=True, **_XW))
def _(d):
    return crosswalk(Shapes(d)).select("shape_id", "shape_name", "geo_group", "grp", "unit_id", "score_e4", "note")


@register("one_to_one", sql("SELECT shape_id, unit_id, released FROM gx", recursive=True, **_XW))
def _(d):
    return crosswalk(Shapes(d)).select("shape_id", "unit_id", "released")


@register("geo_coverage", sql("""SELECT *, units_covered * 100 < units * 80 AS below_warning FROM (SELECT count(*) AS polygons, count(geo_group) AS group_resolved,
    count(unit_id) AS matched, count(*) FILTER (WHERE released) AS released, count(DISTINCT unit_id) AS units_covered,
    count(unit_id) - count(DISTINCT unit_id) AS shared_ids, (SELECT count(*) FROM nm_parent) AS units FROM gx)""", recursive=True, **_XW))
def _(d):
    s = Shapes(d)
    return geo.geo_coverage(crosswalk(s), s.units)


_THIN = {"th_all": """SELECT shape_id, part, ring, gx, gy, row_number() OVER (PARTITION BY shape_id, part, ring ORDER BY seq) - 1 AS seq FROM (
    SELECT *, lag(gx) OVER w AS pgx, lag(gy) OVER w AS pgy FROM (SELECT shape_id, part, ring, seq, CAST(floor(x / 0.01::DOUBLE + 0.5) AS BIGINT) AS gx,
      CAST(floor(y / 0.01::DOUBLE + 0.5) AS BIGINT) AS gy FROM sh_point) WINDOW w AS (PARTITION BY shape_id, part, ring ORDER BY seq))
    WHERE pgx IS NULL OR pgx <> gx OR pgy <> gy""",
    "th_small": """SELECT shape_id, part, min(gx) AS x0, min(gy) AS y0, greatest(max(gx), min(gx) + 1) AS x1, greatest(max(gy), min(gy) + 1) AS y1
        FROM th_all WHERE ring = 0 GROUP BY 1, 2 HAVING count(*) < 4""",
    "th": """SELECT * FROM th_all t WHERE (SELECT count(*) FROM th_all o WHERE o.shape_id = t.shape_id AND o.part = t.part AND o.ring = t.ring) >= 4
        UNION ALL SELECT shape_id, part, 0, [x0, x1, x1, x0, x0][i], [y0, y0, y1, y1, y0][i], i - 1 FROM th_small, (SELECT unnest(range(1, 6)) AS i)"""}


@register("thin_rings", sql("SELECT shape_id, part, ring, seq, gx, gy FROM th", **_SHAPES, **_THIN))
def _(d):
    thin = geo.thin_rings(Shapes(d).shapes)
    return thin.select("shape_id", *[F.col(c).cast("long").alias(c) for c in ("part", "ring", "seq")], "gx", "gy")


# A mosaic with common borders: one cell per customer, 40 in a row, 10 steps on each side. Place s of a cell's ring, the same
# text in both engines: its side, the step on the grid line, the line's cell, and the step's distance from the line.
_SIDE = "CAST(floor((s % 40) / 10.0) AS BIGINT)"
_STEP = f"(CASE WHEN {_SIDE} < 2 THEN s % 10 ELSE 10 - s % 10 END)"
_CX, _CY = f"(i + CASE WHEN {_SIDE} = 1 THEN 1 ELSE 0 END)", f"(j + CASE WHEN {_SIDE} = 2 THEN 1 ELSE 0 END)"
_OFF = f"(CASE WHEN {_STEP} % 10 = 0 THEN 0 ELSE ({_SIDE} % 2 * 5 + {_CX} * 7 + {_CY} * 13 + {_STEP} * {_STEP} * 31) % 17 - 8 END)"
_MX = f"CAST(100 * {_CX} + CASE WHEN {_SIDE} % 2 = 0 THEN 10 * {_STEP} ELSE {_OFF} END AS DOUBLE)"
_MY = f"CAST(100 * {_CY} + CASE WHEN {_SIDE} % 2 = 0 THEN {_OFF} ELSE 10 * {_STEP} END AS DOUBLE)"
BORDER_TOLERANCE = 6.0
_RING = "PARTITION BY shape_id"
_MOSAIC = {
    "mz_pt": f"SELECT shape_id, s, {_MX} AS x, {_MY} AS y FROM (SELECT c_custkey AS shape_id, c_custkey % 40 AS i, c_custkey // 40 AS j FROM customer), (SELECT unnest(range(0, 40)) AS s)",
    "mz_end": "SELECT DISTINCT p.x, p.y, q.x AS nx, q.y AS ny FROM mz_pt p JOIN mz_pt q ON q.shape_id = p.shape_id AND q.s IN ((p.s + 1) % 40, (p.s + 39) % 40)",
    "mz_cut": "SELECT x, y FROM mz_end GROUP BY 1, 2 HAVING count(*) <> 2",
    "mz_run": f"SELECT p.*, sum(CASE WHEN c.x IS NULL THEN 0 ELSE 1 END) OVER ({_RING} ORDER BY s) AS c FROM mz_pt p LEFT JOIN mz_cut c USING (x, y)",
    "mz_arc": f"SELECT shape_id, s, x, y, CASE c WHEN 0 THEN m ELSE c END AS arc, m, CASE c WHEN 0 THEN s + 40 ELSE s END AS place FROM (SELECT *, max(c) OVER ({_RING}) AS m FROM mz_run)",
    # every arc also has the first vertex of the next one
    "mz_all": """SELECT shape_id, arc, s, x, y, place FROM mz_arc UNION ALL SELECT shape_id, CASE arc WHEN 1 THEN m ELSE arc - 1 END, s, x, y, 99 FROM mz_arc
        QUALIFY row_number() OVER (PARTITION BY shape_id, arc ORDER BY place) = 1""",
    "mz_way": """SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY shape_id, arc) - 1 AS last,
        first_value([x, y]) OVER w > first_value([x, y]) OVER (PARTITION BY shape_id, arc ORDER BY place DESC) AS back FROM mz_all WINDOW w AS (PARTITION BY shape_id, arc ORDER BY place)""",
    "mz_line": "SELECT shape_id, arc, s, x, y, last, CASE WHEN back THEN last - k ELSE k END AS k FROM mz_way",
    "mz_dp": f"""SELECT shape_id, arc, 0 AS lo, last AS hi, 0 AS depth FROM mz_line WHERE k = 0 UNION ALL
        SELECT shape_id, arc, CASE half WHEN 0 THEN lo ELSE CAST(-best[2] AS BIGINT) END, CASE half WHEN 0 THEN CAST(-best[2] AS BIGINT) ELSE hi END, depth + 1 FROM (
          SELECT shape_id, arc, lo, hi, depth, max([(ex - t * dx) * (ex - t * dx) + (ey - t * dy) * (ey - t * dy), -k]) AS best FROM (
            SELECT d.shape_id, d.arc, d.lo, d.hi, d.depth, p.k, b.x - a.x AS dx, b.y - a.y AS dy, p.x - a.x AS ex, p.y - a.y AS ey,
              least(greatest(((p.x - a.x) * (b.x - a.x) + (p.y - a.y) * (b.y - a.y)) / ((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)), 0.0), 1.0) AS t
            FROM mz_dp d JOIN mz_line a ON a.shape_id = d.shape_id AND a.arc = d.arc AND a.k = d.lo JOIN mz_line b ON b.shape_id = d.shape_id AND b.arc = d.arc AND b.k = d.hi
            JOIN mz_line p ON p.shape_id = d.shape_id AND p.arc = d.arc AND p.k > d.lo AND p.k < d.hi) GROUP BY 1, 2, 3, 4, 5) AS split, (VALUES (0), (1)) h(half)
        WHERE depth = 0 OR best[1] > {BORDER_TOLERANCE ** 2}""",
    "mz_kept": """SELECT DISTINCT l.shape_id, l.s AS seq, l.x, l.y FROM mz_line l JOIN (SELECT shape_id, arc, lo AS k FROM mz_dp UNION SELECT shape_id, arc, hi FROM mz_dp) USING (shape_id, arc, k)""",
}


def mosaic(d):
    """Cells of customers whose borders are the same vertices on both sides.

    The text above, but every value of a place is made once and in whole numbers.
    """
    steps = "transform(sequence(0L, 40L), s -> named_struct('s', s, 'side', (s % 40) div 10))"
    steps = f"transform({steps}, t -> named_struct('side', t.side, 'step', IF(t.side < 2, t.s % 10, 10 - t.s % 10), 'cx', i + IF(t.side = 1, 1, 0), 'cy', j + IF(t.side = 2, 1, 0)))"
    steps = f"""transform({steps}, t -> named_struct('flat', t.side % 2 = 0, 'step', t.step, 'cx', t.cx, 'cy', t.cy,
        'off', IF(t.step % 10 = 0, 0, (t.side % 2 * 5 + t.cx * 7 + t.cy * 13 + t.step * t.step * 31) % 17 - 8)))"""
    ring = F.expr(f"""transform({steps}, t -> array(CAST(100 * t.cx + IF(t.flat, 10 * t.step, t.off) AS DOUBLE),
        CAST(100 * t.cy + IF(t.flat, t.off, 10 * t.step) AS DOUBLE)))""")
    # the table's file is small and comes in one task; its rings are forty times as large
    customers = d.table("customer").select("c_custkey").repartition(4 * d.spark.sparkContext.defaultParallelism)
    cells = customers.selectExpr("c_custkey AS shape_id", "c_custkey % 40 AS i", "c_custkey div 40 AS j")
    return cells.select("shape_id", F.array(F.array(ring)).alias("parts"))


@register("thin_shared", sql("SELECT * FROM mz_kept", recursive=True, **_MOSAIC))
def _(d):
    kept = topology.simplified_vertices(mosaic(d), BORDER_TOLERANCE)
    return kept.select("shape_id", F.col("seq").cast("long").alias("seq"), "x", "y")


@register("thin_shared_borders", sql("""SELECT p.shape_id, 40::BIGINT AS n_vertices, count(k.seq) AS n_kept, 0::BIGINT AS torn
    FROM mz_pt p LEFT JOIN mz_kept k ON k.shape_id = p.shape_id AND k.seq = p.s GROUP BY 1""", recursive=True, **_MOSAIC))
def _(d):
    """Per cell: vertices, those that stay, and those of them that a neighbour with the same vertex gave up."""
    cells = materialise(mosaic(d), "mosaic")
    vertices = topology.ring_places(topology.ring_rows(cells)).select("shape_id", "seq", "x", "y")
    kept = topology.simplified_vertices(cells, BORDER_TOLERANCE).select("shape_id", "seq", F.lit(True).alias("stays"))
    rows = vertices.join(kept, ["shape_id", "seq"], "left")
    split = rows.groupBy("x", "y").agg(F.count("*").alias("n"), F.count("stays").alias("k")).filter("k > 0 AND k < n").select("x", "y", F.lit(1).alias("split"))
    return (rows.join(split, ["x", "y"], "left").groupBy("shape_id")
            .agg(F.count("*").alias("n_vertices"), F.count("stays").alias("n_kept"), F.count(F.when(F.col("stays"), F.col("split"))).alias("torn")))


def _counts(df, *keys):
    vertices = F.aggregate(F.flatten("parts"), F.lit(0), lambda n, ring: n + F.size(ring))
    return df.select(*keys, F.size("parts").cast("long").alias("n_parts"), vertices.cast("long").alias("n_vertices"))


@register("src_geojson", sql("""SELECT shape_id, shape_name, length(parts) AS n_parts, (SELECT count(*) FROM sh_point p WHERE p.shape_id = s.shape_id) AS n_vertices
    FROM sh s""", **_SHAPES))
def _(d):
    path = fresh_path(d.spark, "shapes")
    files.write_collections(Shapes(d).shapes, path, ["shape_id", "shape_name"], "shape_id")
    return _counts(files.read_geojson(d.spark, path, "shape_id:long,shape_name:string", collection=True), "shape_id", "shape_name")


@register("geojson_out", sql("""SELECT shape_id, unit_id, length(parts) AS n_parts, (SELECT count(*) FROM th p WHERE p.shape_id = s.shape_id) AS n_vertices
    FROM sh s JOIN gx USING (shape_id) WHERE unit_id IS NOT NULL""", recursive=True, **_XW, **_THIN))
def _(d):
    s = Shapes(d)
    matched = crosswalk(s).filter("unit_id is not null").select("shape_id", "unit_id")
    path = fresh_path(d.spark, "map")
    files.write_geojson(geo.thinned(s.shapes).join(matched, "shape_id"), path, ["shape_id", "unit_id"])
    return _counts(files.read_geojson(d.spark, path, "shape_id:long,unit_id:long"), "shape_id", "unit_id")


@register("geojson_shared", sql("SELECT shape_id, 1::BIGINT AS n_parts, count(*) + 1 AS n_vertices FROM mz_kept GROUP BY 1", recursive=True, **_MOSAIC))
def _(d):
    """The mosaic thinned with common borders, exported and read back."""
    path = fresh_path(d.spark, "mosaic")
    files.write_geojson(topology.simplified(mosaic(d), BORDER_TOLERANCE), path, ["shape_id"])
    return _counts(files.read_geojson(d.spark, path, "shape_id:long"), "shape_id")


@register("map_relation", sql("""SELECT c.unit_id, g.shape_id, c.need_e9, c.unit_id IN (SELECT unit_id FROM opt) AS selected
    FROM fx_cand c JOIN gx g USING (unit_id)""", recursive=True, **_XW, **SCENARIOS))
def _(d):
    return geo.map_relation(d.default_score, crosswalk(Shapes(d)), optimal(d)).select("unit_id", "shape_id", "need_e9", "selected")
