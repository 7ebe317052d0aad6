"""Near-duplicate vectors by dual traversal of cover trees: every pair of a cosine of at least ``threshold``, exactly.

Vectors are scaled to length one; a cosine of c is a distance of sqrt(2 - 2c). A cover tree has nested levels: the net
of a level holds the nets above it, its radius is half of theirs, and every node knows its covering radius, the
largest distance to anything below it. Two nodes whose distance exceeds the threshold by more than both covering radii
hold no pair; if distance and radii together stay below it, all their pairs are links.

The upper levels come from a bounded sample (``SAMPLE`` vectors); its finest net gives cells. Every vector goes to its
nearest cell, and the cells' radii are taken over all vectors. Cells in the order of the tree are cut into groups of
at most ``GROUP`` vectors; a cell that holds a third of all rows is dealt to as many groups as it needs. The upper
trees are traversed against themselves once; pairs of groups with a surviving pair of cells become tasks. A task holds
one group, streams the other one past it in packed rows, continues the traversal through levels below the cells, and
compares what is left in double precision. Only vectors with links leave it, each with its count and one root: never
pairs. Roots are joined to components by iterated minima.

Where the data have no structure at this threshold (independent directions in many dimensions), no bound can cut a
pair, and the work is that of all pairs, in blocked matrix products; rows and shuffled bytes grow with vectors times
groups. Nothing is dropped to avoid it.

Defined cases: null, empty and zero vectors and those with null or non-finite components link with nothing; neither do
vectors of different lengths. Equal vectors are copies and link with each other. A repeated row is a vector of its
own. A missing vec_id takes part; a component's id is the least id that is not null, null if it has none. Empty table:
empty result. Only vec_id and embedding are read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equisite.llm.base import arrow_schema
from equisite.llm.chosen_path import components
from equisite.llm.vectors import by_key, content_key, finite, matrix, packed_rows
from equisite.plans.session import materialise

THRESHOLD = 0.9
SAMPLE = 1024
"""Vectors that the upper levels are made of: the bound of what the driver sees and what is broadcast."""

GROUP = 65_536
"""Vectors of a group at most: what a task holds."""

GROUPS = 12
"""Groups that are made at least (of 1,024 vectors or more), so that small tables use the cluster too."""

LEAF = 32
TILE = 512
SLACK = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by the largest component, so that squares stay in range."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between rows, never below the true ones by more than ``SLACK`` allows for."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Levels:
    """Nested nets over a bounded set of points: a point stands in all levels below the one that it enters."""

    def __init__(self, points: np.ndarray, finest: float):
        order, entered = [0], [4.0]
        near = distances(points[:1], points)[0]
        while len(order) < len(points) and near.max() > finest:
            far = int(near.argmax())
            order.append(far)
            entered.append(near[far])
            near = np.minimum(near, distances(points[far:far + 1], points)[0])
        net = points[order]
        # level k holds the points that entered at a radius above 2 / 2^k, level 0 the first point alone
        level_of = np.maximum(0, np.floor(np.log2(2 / np.array(entered))) + 1).astype(int)
        level_of[1:] = np.maximum(level_of[1:], 1)
        paths = np.zeros((len(net), level_of.max() + 1), int)
        apart = distances(net, net)
        for k in range(1, level_of.max() + 1):
            above = np.flatnonzero(level_of < k)
            paths[:, k - 1] = above[apart[:, above].argmin(1)]
        for k in range(level_of.max(), 0, -1):  # every point hangs below an ancestor of its ancestor
            paths[:, k - 1] = paths[paths[:, k], k - 1] if k < level_of.max() else paths[:, k - 1]
        paths[:, -1] = np.arange(len(net))
        order = np.lexsort(paths.T[::-1])
        back = np.empty(len(net), int)
        back[order] = np.arange(len(net))
        self.net, self.paths = net[order], back[paths[order]]

    def surviving(self, radius: np.ndarray, reach: float) -> np.ndarray:
        """Matrix of the pairs of cells that may hold a pair within ``reach``; ``radius`` is that of the cells (-1: empty)."""
        apart = distances(self.net, self.net)
        left = None
        for k in range(self.paths.shape[1]):
            node = self.paths[:, k]
            cover = np.full(len(self.net), -np.inf)
            np.maximum.at(cover, node, np.where(radius < 0, -np.inf, apart[node, np.arange(len(node))] + radius))
            if left is None:
                left = np.ones((1, 1), bool)
                at = np.zeros(len(node), int)
            nodes, now = np.unique(node, return_inverse=True)
            above = at[nodes]  # position of every node's parent in the level above
            close = apart[np.ix_(nodes, nodes)] - cover[nodes][:, None] - cover[nodes][None, :] <= reach + SLACK
            left = left[np.ix_(above, above)] & close
            at = now
        return left


def grove(points: np.ndarray, cells: np.ndarray, reach: float):
    """Levels below the cells of one group: (order, ends of leaves, levels), a level being (centres, radii, parents)."""
    order = np.argsort(cells, kind="stable")
    cuts = np.flatnonzero(np.diff(cells[order])) + 1
    nodes, parents, levels = np.split(order, cuts), None, []
    while True:
        centres = points[[n[0] for n in nodes]]
        away = [distances(points[n[:1]], points[n])[0] for n in nodes]
        radii = np.array([a.max() for a in away])
        levels.append((centres, radii, parents))
        below, parents = [], []
        for number, (node, near, r) in enumerate(zip(nodes, away, radii)):
            parts = halved(points, node, near, r) if len(node) > LEAF and r > reach / 4 else [node]
            below += parts
            parents += [number] * len(parts)
        if len(below) == len(nodes):
            return np.concatenate(nodes), np.cumsum([len(n) for n in nodes]), levels
        nodes, parents = below, np.array(parents)


def halved(points: np.ndarray, node: np.ndarray, near: np.ndarray, radius: float) -> list[np.ndarray]:
    """The children of a node: a net of half the radius, farthest points first; the node itself where it has no such net of
    less than an eighth of its points, as there is nothing to gain."""
    owner, count, near = np.zeros(len(node), int), 1, near.copy()
    while near.max() > radius / 2:
        if count > len(node) // 8:
            return [node]
        away = distances(points[node[near.argmax()]][None, :], points[node])[0]
        closer = away < near
        owner[closer], near[closer] = count, away[closer]
        count += 1
    return [node[owner == c] for c in range(count) if (owner == c).any()]


def traversed(own, other, reach: float):
    """Boolean matrices over (own leaf, other leaf): pairs to compare, pairs that all link."""
    open_ = np.ones((1, 1), bool)
    for k in range(max(len(own), len(other))):
        (a, ra, pa_), (b, rb, pb) = own[min(k, len(own) - 1)], other[min(k, len(other) - 1)]
        rows = np.arange(len(a)) if k >= len(own) else np.zeros(len(a), int) if pa_ is None else pa_
        columns = np.arange(len(b)) if k >= len(other) else np.zeros(len(b), int) if pb is None else pb
        apart = distances(a, b)
        open_ = open_[np.ix_(rows, columns)] & (apart - ra[:, None] - rb[None, :] <= reach + SLACK)
    sure = open_ & (apart + ra[:, None] + rb[None, :] <= reach - SLACK)
    return open_ & ~sure, sure


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of ``i`` and ``j`` pairwise; ``parent`` points at the least member before and after."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


class Group:
    """The vectors that a task holds, with their levels."""

    def __init__(self, x: np.ndarray, cells: np.ndarray, keys: np.ndarray, copies: np.ndarray, threshold: float):
        self.threshold, self.reach = threshold, np.sqrt(max(0.0, 2 - 2 * threshold))
        order, self.ends, self.levels = grove(x, cells, self.reach)
        self.x, self.keys, self.copies = x[order], keys[order], copies[order]
        self.single = self.x.astype(np.float32)
        self.margin = 2e-7 * x.shape[1] + 1e-6

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]])

    def links(self, other: Group):
        """Yields index arrays (own, other) of linked pairs, tile by tile."""
        compare, sure = traversed(self.levels, other.levels, self.reach)
        dense = compare.mean() > 0.3
        for i in range(0, len(self.x), TILE) if dense else ():
            yield from self.compared(other, np.arange(i, min(i + TILE, len(self.x))), None)
        if dense:
            return
        mine, theirs = self.starts(), other.starts()
        for leaf in np.flatnonzero(compare.any(1) | sure.any(1)):
            rows = np.arange(mine[leaf], self.ends[leaf])
            for chosen, known in ((compare[leaf], False), (sure[leaf], True)):
                if not chosen.any():
                    continue
                columns = np.concatenate([np.arange(theirs[c], other.ends[c]) for c in np.flatnonzero(chosen)])
                for at in range(0, len(rows), TILE):
                    part = rows[at:at + TILE]
                    if known:
                        yield np.repeat(part, len(columns)), np.tile(columns, len(part))
                    else:
                        yield from self.compared(other, part, columns)

    def compared(self, other: Group, rows: np.ndarray, columns: np.ndarray | None):
        """Single precision decides what is clear; what lies within its error of the threshold is computed in double."""
        right = other.single if columns is None else other.single[columns]
        cosine = self.single[rows[0]:rows[-1] + 1] @ right.T
        i, j = np.nonzero(cosine >= self.threshold - self.margin)
        if not len(i):
            return
        close = cosine[i, j] < self.threshold + self.margin
        i, j = rows[i], j if columns is None else columns[j]
        good = np.ones(len(i), bool)
        good[close] = np.einsum("ij,ij->i", self.x[i[close]], other.x[j[close]]) >= self.threshold
        if good.any():
            yield i[good], j[good]


def links_of_pairs(tasks: DataFrame, threshold: float) -> DataFrame:
    """(sid, root, links) for every vector with links inside its pair of groups."""
    schema = "sid binary, root binary, links bigint"
    arrow = arrow_schema(schema)
    keys = ["dim", "a", "b"]

    def loaded(parts, dim) -> Group:
        x = unit(np.frombuffer(b"".join(p["v"] for p in parts), np.float64).reshape(-1, dim))
        return Group(x, np.frombuffer(b"".join(p["cell"] for p in parts), np.int32),
                     np.frombuffer(b"".join(p["sid"] for p in parts), "S16"),
                     np.frombuffer(b"".join(p["copies"] for p in parts), np.int64), threshold)

    def emitted(group: Group, counts, roots) -> pa.RecordBatch:
        at = np.flatnonzero(counts)
        # numpy drops trailing zero bytes of "S16" items: cut the keys from the raw bytes
        raw = group.keys.tobytes()
        return pa.RecordBatch.from_arrays([
            pa.array([raw[16 * i:16 * i + 16] for i in at], pa.binary()), pa.array([roots[i] for i in at], pa.binary()),
            pa.array(counts[at].astype(np.int64))], schema=arrow)

    def run(batches):
        parts, own, current = [], None, None
        counts = parent = None

        def name(i):
            return own.keys.tobytes()[16 * i:16 * i + 16]

        def started():
            nonlocal own, counts, parent
            own = loaded(parts, current[0])
            counts, parent = np.zeros(len(own.x), np.int64), np.arange(len(own.x))

        def ended():
            raw = own.keys.tobytes()
            hit = np.flatnonzero(counts)
            return emitted(own, counts, {i: raw[16 * parent[i]:16 * parent[i] + 16] for i in hit})

        def inner():
            for i, j in own.links(own):
                apart = i != j
                i, j = i[apart], j[apart]
                counts[:] += np.bincount(i, own.copies[j], len(counts)).astype(np.int64)
                unite(parent, i, j)

        for key, some in by_key(batches, keys):
            if key != current:
                if current is not None:
                    if own is None:
                        started()
                    if current[1] == current[2]:
                        inner()
                    yield ended()
                parts, own, current = [], None, key
            for row in some.to_pylist():
                if not row["visits"]:
                    parts.append(row)
                    continue
                if own is None:
                    started()
                other = loaded([row], key[0])
                n = len(own.x)
                seen, both = np.zeros(len(other.x), np.int64), np.concatenate([parent, n + np.arange(len(other.x))])
                for i, j in own.links(other):
                    counts += np.bincount(i, other.copies[j], n).astype(np.int64)
                    seen += np.bincount(j, own.copies[i], len(seen)).astype(np.int64)
                    unite(both, i, n + j)
                parent = both[:n].copy()
                if seen.any():
                    raw = own.keys.tobytes()
                    yield emitted(other, seen, {j: raw[16 * both[n + j]:16 * both[n + j] + 16] for j in np.flatnonzero(seen)})
        if current is not None:
            if own is None:
                started()
            if current[1] == current[2]:
                inner()
            yield ended()

    return tasks.repartition(*keys).sortWithinPartitions(*keys, "visits").mapInArrow(run, schema)


def sampled_levels(vectors: DataFrame, reach: float) -> dict[int, Levels]:
    """Upper levels by vector length, from the ``SAMPLE`` vectors of least key."""
    rows = vectors.select("sid", "embedding").distinct().orderBy("sid").limit(SAMPLE).select("embedding").collect()
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r[0]), []).append(r[0])
    return {d: Levels(unit(np.array(v, np.float64)), reach / 4) for d, v in by_length.items()}


def in_cells(sets: DataFrame, levels: dict[int, Levels]) -> DataFrame:
    """(dim, cell, far, sid, copies, least_id, v): every vector with its nearest cell and the distance to its centre."""
    schema = "dim int, cell int, far double, sid binary, copies bigint, least_id bigint, v array<double>"
    arrow = arrow_schema(schema)
    nets = {d: x.net for d, x in levels.items()}

    def run(batches):
        for batch in batches:
            lengths = np.asarray(batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False))
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                v = part.column("embedding")
                # a length that the sample does not have is one cell around the first axis
                net = nets.get(int(d), np.eye(1, int(d)))
                x = matrix(v)
                for at in range(0, len(x), 4096):
                    some = part.slice(at, 4096)
                    apart = distances(unit(x[at:at + 4096]), net)
                    cell = apart.argmin(1)
                    flat = pa.array(x[at:at + 4096].ravel())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(cell), d, np.int32)), pa.array(cell.astype(np.int32)),
                        pa.array(apart[np.arange(len(cell)), cell]), some.column("sid"), some.column("copies"), some.column("least_id"),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(cell) + 1, dtype=np.int32) * int(d)), flat)
                        .cast(arrow.field("v").type)], schema=arrow)

    return sets.select("sid", "copies", "least_id", "embedding").mapInArrow(run, schema)


def pairs_of_groups(cells: list, levels: dict[int, Levels], reach: float):
    """Rows (dim, cell, first, rows, total, groups) and pairs (dim, a, b) of groups that the upper levels leave."""
    places, pairs = [], []
    for dim in sorted({c["dim"] for c in cells}):
        own = sorted((c for c in cells if c["dim"] == dim), key=lambda c: c["cell"])
        total = sum(c["rows"] for c in own)
        groups = max(min(GROUPS, -(-total // 1024)), -(-total // GROUP))
        first, lows, highs = 0, np.full(groups, 1 << 30), np.full(groups, -1)
        for c in own:
            places.append((dim, c["cell"], first, c["rows"], total, groups))
            a, b = first * groups // total, (first + c["rows"] - 1) * groups // total
            lows[a:b + 1] = np.minimum(lows[a:b + 1], c["cell"])
            highs[a:b + 1] = np.maximum(highs[a:b + 1], c["cell"])
            first += c["rows"]
        if dim in levels:
            radius = np.full(len(levels[dim].net), -1.0)
            radius[[c["cell"] for c in own]] = [c["far"] for c in own]
            left = levels[dim].surviving(radius, reach)
        else:
            left = np.ones((1, 1), bool)
        sums = np.zeros((len(left) + 1, len(left) + 1), np.int64)
        sums[1:, 1:] = left.cumsum(0).cumsum(1)
        lo, hi = lows[:, None], highs[:, None] + 1
        found = sums[hi, hi.T] - sums[lo, hi.T] - sums[hi, lo.T] + sums[lo, lo.T]
        a, b = np.nonzero(np.triu(found > 0) | np.eye(groups, dtype=bool))
        pairs.append((dim, a, b))
    return places, pairs


def join(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    spark, reach = vectors.sparkSession, float(np.sqrt(2 - 2 * threshold))
    sound = finite("embedding") & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding").withColumn("_ok", sound)
    alone = rows.filter(~F.col("_ok")).select("vec_id")
    keyed = rows.filter("_ok").select("vec_id", "embedding", content_key("embedding").alias("sid"))
    levels = sampled_levels(keyed, reach)
    sets = keyed.groupBy("sid").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"),
                                    F.any_value("embedding").alias("embedding"))
    placed = materialise(in_cells(sets, levels), "cells")
    cells = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("rows"), F.max("far").alias("far")).collect()
    places, pairs = pairs_of_groups(cells, levels, reach)
    place = F.broadcast(spark.createDataFrame(places, "dim int, cell int, first bigint, rows bigint, total bigint, groups bigint"))
    share = F.pmod(F.xxhash64("sid", F.lit(5)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # at most the last row of a cell: rounding never reaches the next one
    at = F.col("first") + F.least(F.floor(share * F.col("rows")), F.col("rows") - 1)
    grouped = placed.join(place, ["dim", "cell"]).withColumn("grp", F.floor(at * F.col("groups") / F.col("total")).cast("int"))
    packs = materialise(packed_rows(grouped, ["dim", "grp"], {"sid": "raw", "copies": "int64", "cell": "int32"}, ["cell"]), "packs")
    listed = spark.createDataFrame([(d, int(x), int(y)) for d, a, b in pairs for x, y in zip(a, b)], "dim int, a int, b int")
    own = listed.join(packs, (listed["dim"] == packs["dim"]) & (listed["a"] == packs["grp"])).withColumn("visits", F.lit(False))
    guests = (listed.filter("a < b").join(packs, (listed["dim"] == packs["dim"]) & (listed["b"] == packs["grp"]))
              .withColumn("visits", F.lit(True)))
    columns = [listed["dim"], "a", "b", "visits", "v", "sid", "copies", "cell"]
    found = materialise(links_of_pairs(own.select(*columns).unionByName(guests.select(*columns)), threshold), "links")
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    labels = components(found.filter("sid <> root").select("sid", "root"))
    sizes = placed.select("sid", "copies", "least_id")
    linked = labels.join(sizes, "sid").join(links, "sid", "left")
    least = linked.groupBy("label").agg(F.min("least_id").alias("component_id"))
    known = (linked.join(least, "label").select("sid", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
             .unionByName(sizes.filter("copies > 1").join(labels, "sid", "left_anti")
                          .select("sid", F.col("least_id").alias("component_id"), (F.col("copies") - 1).alias("n_links"))))
    known = materialise(known.withColumn("_known", F.lit(True)), "known")
    out = keyed.select("vec_id", "sid").join(known, "sid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    out = out.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def oracle_sql() -> str:
    return f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS MATERIALIZED (SELECT r, vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (SELECT a.r AS r, b.r AS s FROM ok a JOIN ok b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
c AS (SELECT r, s FROM p UNION SELECT c.r, p.s FROM c JOIN p ON c.s = p.r),
m AS (SELECT c.r, min(b.vec_id) AS least FROM c JOIN v b ON b.r = c.s GROUP BY c.r),
n AS (SELECT r, count(*) AS n FROM p GROUP BY r)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, CASE WHEN m.r IS NULL THEN v.vec_id ELSE m.least END AS component_id,
  v.vec_id IS NOT DISTINCT FROM CASE WHEN m.r IS NULL THEN v.vec_id ELSE m.least END AS kept
FROM v LEFT JOIN n USING (r) LEFT JOIN m USING (r)"""
