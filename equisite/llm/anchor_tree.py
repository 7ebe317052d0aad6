"""Hard negatives by spanning-tree bounds over anchors, exact in whole numbers.

Anchors are put into blocks of near ones; the minimum spanning tree of a block has the distance to the parent on every
edge. For a candidate y, the score at an anchor c lies within edge(c) * |y| of the score at its parent, as
<c, y> - <parent, y> = <c - parent, y>; intervals add up along edges that were not rescored. Only candidates whose
interval meets the anchor's window are rescored: for positives what may still be among the best, for negatives the
span from 80 % of the least positive score to the greatest one.

Candidates are dealt by hash to groups of at most ``GROUP`` vectors, which a task holds, while packed blocks of anchors
stream past. What leaves is the best few of every (group, anchor), merged by a window of groups times a few rows. So
neither a label nor a group of equal vectors is ever a key, and nothing but the pivots of the blocks (``PIVOTS`` vectors at
most) passes the driver.

Where anchors are far apart, as independent directions are, bounds cut little and the work is anchors times candidates in
matrix products.

Defined cases: rows with a null label, a null or empty vector or a null or non-finite component take no part; vectors of
different lengths have no score. Rows that are equal in id, label and vector are one row; of an id on several rows each
is a row. A null vec_id takes part as a candidate, after all others in a tie (as the greatest id). Equal scores go by
vec_id. An anchor without a positive, and a positive without a negative in its window, give no rows. Scores are exact
while products stay below 2^53. Empty table: empty result. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from equisite.llm.base import arrow_schema
from equisite.llm.vectors import by_key, content_key, finite, matrix, packed_rows
from equisite.plans.session import materialise

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
"""The window of negatives, in per cent of the positive score."""

GROUP = 65_536
GROUPS = 12
PIVOTS = 256
BLOCK = 256
"""Anchors that a pivot has on average, up to ``PIVOTS`` pivots."""

TILE = 4096
NO_ID = (1 << 63) - 1


def scored_rows(vectors: DataFrame) -> DataFrame:
    """(sid, vec_id, label, v): the distinct rows that take part, in whole numbers; the moved labels stand already."""
    sound = vectors.filter(F.col("label").isNotNull() & finite("embedding")).select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    own = sound.select(content_key("vec_id", "label", "embedding").alias("sid"), "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    whole = F.transform("embedding", lambda x: F.floor(x * 256.0).cast("double"))
    return (own.groupBy("sid").agg(F.any_value("vec_id").alias("vec_id"), F.any_value("label").alias("label"),
                                   F.any_value("embedding").alias("embedding"))
            .select("sid", "vec_id", moved.alias("label"), F.size("embedding").alias("dim"), whole.alias("v")))


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of the minimum spanning tree from the first point; parents come before children."""
    n = len(points)
    square = (points * points).sum(1)
    order, parent, edge = np.zeros(n, int), np.zeros(n, int), np.zeros(n)
    near, via = np.full(n, np.inf), np.zeros(n, int)
    outside = np.ones(n, bool)
    now = 0
    for k in range(n):
        order[k], parent[now], edge[now] = now, via[now], 0.0 if k == 0 else near[now]
        outside[now] = False
        away = np.sqrt(np.maximum(square + square[now] - 2 * (points @ points[now]), 0))
        closer = outside & (away < near)
        near[closer], via[closer] = away[closer], now
        now = int(np.where(outside, near, np.inf).argmin())
    return order, parent, edge


def blocks_of(rows: DataFrame) -> DataFrame:
    """Packed blocks of near anchors: block, dim, m, v, ids, labels and keys."""
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    pivots: dict[int, list] = {}
    count = anchors.count()
    for r in anchors.orderBy("sid").limit(min(PIVOTS, -(-count // BLOCK))).select("v").collect():
        pivots.setdefault(len(r[0]), []).append(r[0])
    centres = {d: np.array(v) for d, v in pivots.items()}

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column("v"):
                x = np.array(v.as_py())
                near = centres.get(len(x))
                out.append(0 if near is None else int(((near - x) ** 2).sum(1).argmin()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "pivot"])

    schema = "sid binary, vec_id bigint, label bigint, dim int, v array<double>, pivot int"
    near = anchors.select("sid", "vec_id", "label", "dim", "v").mapInArrow(run, schema)
    packed = packed_rows(near, ["dim", "pivot"], {"sid": "raw", "vec_id": "int64", "label": "int64"}, ["sid"])
    return materialise(packed.withColumn("block", F.monotonically_increasing_id()), "anchors")


class Held:
    """Rows of a group, or the anchors of a block."""

    def __init__(self, packs: list[dict]):
        raw = {k: b"".join(p[k] for p in packs) for k in ("v", "vec_id", "label", "sid")}
        self.ids, self.labels = np.frombuffer(raw["vec_id"], np.int64), np.frombuffer(raw["label"], np.int64)
        self.v = np.frombuffer(raw["v"], np.float64).reshape(len(self.ids), -1)
        self.keys = np.frombuffer(raw["sid"], np.int64).reshape(-1, 2)
        self.norms = np.sqrt((self.v * self.v).sum(1))


class Tree:
    """Spanning tree of a block, by depth."""

    def __init__(self, points: np.ndarray):
        order, self.parent, self.edge = spanning_tree(points)
        depth = np.zeros(len(points), int)
        for i in order[1:]:
            depth[i] = depth[self.parent[i]] + 1
        self.floors = [np.flatnonzero(depth == d) for d in range(depth.max() + 1)]

    def rescored(self, points, tile, norms, allowed, low, high):
        """(scores, exact): scores of the candidates whose interval meets [low, high] of an anchor, and which those are."""
        scores, width = np.empty((len(points), len(tile))), np.zeros((len(points), len(tile)))
        exact = np.zeros((len(points), len(tile)), bool)
        for at, rows in enumerate(self.floors):
            if at:
                middle, half = scores[self.parent[rows]], width[self.parent[rows]] + self.edge[rows][:, None] * norms[None, :] * (1 + 1e-9)
                wanted = allowed[rows] & (middle + half >= low[rows][:, None] - 1e-3) & (middle - half <= high[rows][:, None] + 1e-3)
            if not at or wanted.mean() > 0.2:
                scores[rows], exact[rows] = points[rows] @ tile.T, True
                continue
            scores[rows], width[rows] = middle, half
            i, j = np.nonzero(wanted)
            scores[rows[i], j] = np.einsum("ij,ij->i", points[rows[i]], tile[j])
            width[rows[i], j], exact[rows[i], j] = 0, True
        return scores, exact


def best_of(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` first by falling score, then id."""
    if len(scores) > 8 * most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:most]]
    return np.lexsort((ids, -scores))[:most]


def positives_of(block: Held, tree: Tree, wants, group: Held):
    """(anchor, 0, id, score) of the best same-label rows of the group."""
    n = len(block.ids)
    best = [(np.empty(0), np.empty(0, np.int64))] * n
    low, high = np.full(n, -np.inf), np.full(n, np.inf)
    for at in range(0, len(group.ids), TILE):
        cut = slice(at, at + TILE)
        allowed = block.labels[:, None] == group.labels[None, cut]
        scores, exact = tree.rescored(block.v, group.v[cut], group.norms[cut], allowed, low, high)
        keys, ids = group.keys[cut], group.ids[cut]
        for a in range(n):
            j = np.flatnonzero(allowed[a] & exact[a] & (scores[a] >= low[a]) & (keys != block.keys[a]).any(1))
            s, k = np.concatenate([best[a][0], scores[a][j]]), np.concatenate([best[a][1], ids[j]])
            top = best_of(s, k, POSITIVES)
            best[a] = s[top], k[top]
            if len(top) == POSITIVES:
                low[a] = s[top[-1]]
    return [(a, 0, int(k), int(s)) for a in range(n) for s, k in zip(*best[a])]


def negatives_of(block: Held, tree: Tree, wants, group: Held):
    """(anchor, positive score, id, score) of the best rows of the group inside the windows."""
    n = len(block.ids)
    asked: list[list[int]] = [[] for _ in range(n)]
    for w in wants:
        asked[w["anchor"]].append(w["score"])
    low = np.array([min(-(-LOW * p // 100) for p in x) if x else np.inf for x in asked])
    high = np.array([max(x) if x else -np.inf for x in asked])
    best: dict = {(a, p): (np.empty(0), np.empty(0, np.int64)) for a in range(n) for p in asked[a]}
    for at in range(0, len(group.ids), TILE):
        cut = slice(at, at + TILE)
        allowed = block.labels[:, None] != group.labels[None, cut]
        scores, exact = tree.rescored(block.v, group.v[cut], group.norms[cut], allowed, low, high)
        ids = group.ids[cut]
        for a in range(n):
            j = np.flatnonzero(allowed[a] & exact[a] & (scores[a] >= low[a]) & (scores[a] <= high[a]))
            for p in set(asked[a]) if len(j) else ():
                inside = j[(scores[a][j] <= p) & (100 * scores[a][j] >= LOW * p)]
                s, k = np.concatenate([best[a, p][0], scores[a][inside]]), np.concatenate([best[a, p][1], ids[inside]])
                top = best_of(s, k, NEGATIVES)
                best[a, p] = s[top], k[top]
    return [(a, p, int(k), int(s)) for (a, p), found in best.items() for s, k in zip(*found)]


def met(blocks: DataFrame, packs: DataFrame, groups: int, find) -> DataFrame:
    """(block, anchor, anchor_id, at, id, score): what ``find`` says for every block of anchors and every group."""
    schema = "block bigint, anchor int, anchor_id bigint, at bigint, id bigint, score bigint"
    arrow = arrow_schema(schema)

    def run(batches):
        packs, group, current = [], None, None
        for key, some in by_key(batches, ["dim", "grp"]):
            if key != current:
                packs, group, current = [], None, key
            for row in some.to_pylist():
                if row["block"] is None:
                    packs.append(row)
                    continue
                if group is None and packs:
                    group = Held(packs)
                if group is None:
                    continue
                block = Held([row])
                found = find(block, Tree(block.v), row["wants"] or [], group)
                a, at, ids, score = (list(x) for x in zip(*found)) if found else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
                    ([row["block"]] * len(a), a, block.ids[a].tolist() if a else [], at, ids, score), arrow)], schema=arrow)

    wants = blocks if "wants" in blocks.columns else blocks.withColumn("wants", F.lit(None).cast("array<struct<anchor:int,score:bigint>>"))
    columns = ["dim", "grp", "block", "wants", "v", "vec_id", "label", "sid"]
    guests = wants.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    held = packs.withColumn("block", F.lit(None).cast("long")).withColumn("wants", F.lit(None).cast(wants.schema["wants"].dataType))
    return (held.select(*columns).unionByName(guests.select(*columns)).repartition("dim", "grp")
            .sortWithinPartitions("dim", "grp", F.asc_nulls_first("block")).mapInArrow(run, schema))


def mine(vectors: DataFrame) -> DataFrame:
    """The hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id and both scores."""
    rows = materialise(scored_rows(vectors), "scored")
    total = rows.count()
    groups = max(1, min(GROUPS, -(-total // 1024)), -(-total // GROUP))
    rows = rows.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID)))
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("sid", F.lit(3)), F.lit(groups)).cast("int"))
    packs = materialise(packed_rows(dealt, ["dim", "grp"], {"sid": "raw", "vec_id": "int64", "label": "int64"}, ["sid"]), "groups")
    blocks = blocks_of(rows.filter(F.col("vec_id") != NO_ID))
    first = W.partitionBy("block", "anchor").orderBy(F.desc("score"), "id")
    positives = materialise(met(blocks, packs, groups, positives_of).withColumn("_r", F.row_number().over(first))
                            .filter(F.col("_r") <= POSITIVES).drop("_r", "at"), "positives")
    # a block has few anchors, an anchor few positives
    wants = positives.groupBy("block").agg(F.collect_list(F.struct("anchor", "score")).alias("wants"))
    near = W.partitionBy("block", "anchor", "at").orderBy(F.desc("score"), "id")
    negatives = (met(blocks.join(wants, "block"), packs, groups, negatives_of).withColumn("rank", F.row_number().over(near))
                 .filter(F.col("rank") <= NEGATIVES)
                 .select("block", "anchor", F.col("at").alias("positive_score"), "rank", F.col("id").alias("_n"),
                         F.col("score").alias("negative_score")))
    known = positives.select("block", "anchor", "anchor_id", F.col("id").alias("_p"), F.col("score").alias("positive_score"))
    named = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("_p", "positive_id"), ("_n", "negative_id"))]
    return known.join(negatives, ["block", "anchor", "positive_score"]).select(
        "anchor_id", named[0], F.col("rank").cast("int").alias("rank"), named[1], "positive_score", "negative_score")


def oracle_sql() -> str:
    return f"""
WITH v AS MATERIALIZED (SELECT DISTINCT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
t AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(e, lambda x: floor(256 * x)) AS e FROM v),
s AS MATERIALIZED (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
  list_dot_product(a.e, b.e)::BIGINT AS score FROM t a JOIN t b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (SELECT a, anchor_id, b AS p, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST) <= {POSITIVES})
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.a, p ORDER BY score DESC, id NULLS LAST)::INT AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT same AND {LOW} * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= {NEGATIVES}"""
