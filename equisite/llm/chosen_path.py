"""Similarity join of documents on word shingles by chosen paths.

A run starts with all sets in one node. A node draws one or two minwise hash functions (1 / threshold on average) and
splits its sets by their sampled token, the shingle with the least hash: two sets of similarity s share it with
probability s. Nodes with few sets are solved by brute force on the exact sets; larger ones are split again, up to
``DEPTH`` times, and what is then still large (sets that resemble each other throughout) is solved by brute force in
blocks. Independent runs are repeated until a pair at the threshold is found with the wanted probability; the number
of runs follows from the branching process (``runs_for``).

No node is cut or dropped. A large node is spread over pairs of blocks of bounded size, and pairs of documents never
become rows: a node gives a spanning forest of its links, forests are joined to classes by iterated minima, and the
links of a class are counted inside blocks. Equal sets are one set with a number of copies from the start.

Everything that is read twice is written to the shared folder, so a lost executor costs its tasks only.

Defined cases: a null or empty text has no shingle and no link, it is a class of its own row; a text of one to four
words has itself as its only shingle; texts with the same set are copies (similarity 1); a row is known by its doc_id and
its text, so rows without an id and ids that stand on several texts take part like others (class_id is the least id of a
class, null if none has one); rows that repeat count as copies; long texts are read whole; an empty table gives an empty
result. Only doc_id and text are read, extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from equisite.llm.base import WORD, arrow_schema, map_batches
from equisite.llm.vectors import content_key
from equisite.plans.session import materialise

SHINGLE = 5
THRESHOLD = (4, 5)
"""Least similarity, as a fraction: compared in whole numbers."""

TARGET_RECALL = 0.999
DEPTH = 3
SMALL = 256
"""Sets of a node that is solved at once."""

BLOCK_SHINGLES = 1_000_000
"""Shingles of a block when a large group is solved in pairs of blocks."""

BLOCK_SETS = 1500
"""Sets of such a block."""

NO_ID = (1 << 63) - 1
"""Stands for a null doc_id: after all others."""

CACHE_WORDS = 300_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def survival(depth: int, s: float = THRESHOLD[0] / THRESHOLD[1]) -> float:
    """Probability that a pair of similarity ``s`` still shares a node after ``depth`` splits of one run."""
    q = 1.0
    for _ in range(depth):
        q = 0.75 * s * q + 0.25 * (1 - (1 - s * q) ** 2)
    return q


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has been found with probability ``recall``, in whole fours."""
    runs = int(np.ceil(np.log(1 - recall) / np.log(1 - survival(depth))))
    return -(-runs // 4) * 4


def mixed(x: np.ndarray, seed) -> np.ndarray:
    """A 64-bit hash of 64-bit values, another one for every seed."""
    x = (x ^ seed) * MIX
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Shingles:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self):
        import xxhash
        self.digest, self.known = xxhash.xxh3_64_intdigest, {}

    def of(self, text: str | None) -> np.ndarray:
        words = WORD.findall(text or "")
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = self.digest(w)
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(ids) - SHINGLE + 1
        if n < 1:
            return mixed(np.bitwise_xor.reduce(mixed(ids, np.arange(len(ids), dtype=np.uint64)), keepdims=True),
                         np.uint64(len(ids)))
        out = np.zeros(n, np.uint64)
        for j in range(SHINGLE):
            out = mixed(out + ids[j:j + n], np.uint64(j + 1))
        return np.unique(out)


def set_id(shingles: np.ndarray) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(shingles.tobytes())


def root_seeds(runs: int) -> np.ndarray:
    """Hash functions of the roots: run after run one function, every fourth run two."""
    count = sum(2 if r % 4 == 3 else 1 for r in range(runs))
    return mixed(np.arange(count, dtype=np.uint64), np.uint64(0x5EED))


def with_row_key(docs: DataFrame) -> DataFrame:
    """Adds what a row is known by: ``_d`` (doc_id, null last) and ``_t`` (16 bytes of the text's content)."""
    return docs.withColumn("_d", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("_t", content_key("text"))


def sets_of(docs: DataFrame, runs: int) -> DataFrame:
    """(_d, _t, sid, n, nodes): set id (null: no words), number of shingles, node of every root function."""
    def make():
        shingles, seeds = Shingles(), root_seeds(runs)[:, None]

        def step(batch):
            out = {"_d": batch["_d"], "_t": batch["_t"], "sid": [], "n": [], "nodes": []}
            for text in batch["text"]:
                s = shingles.of(text)
                out["n"].append(len(s))
                out["sid"].append(set_id(s) if len(s) else None)
                # piece by piece, so that a very long text needs no large matrix
                least = np.min([mixed(s[i:i + 50_000], seeds).min(1) for i in range(0, len(s), 50_000)], 0) if len(s) else s
                out["nodes"].append(mixed(least, seeds[:, 0]).view(np.int64).tolist() if len(s) else [])
            return out
        return step

    rows = with_row_key(docs.select("doc_id", "text")).select("_d", "_t", "text")
    return map_batches(rows, "_d bigint, _t binary, sid binary, n bigint, nodes array<bigint>", make)


def shingle_sets(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(sid, n, shingles) for the (sid, _d, _t) in ``wanted``; shingles as bytes of sorted 64-bit numbers.

    A row that is repeated is read once; rows without an id are first made one per text, which may stand on very many.
    """
    def make():
        shingles = Shingles()

        def step(batch):
            out = {"sid": [], "n": [], "shingles": []}
            for sid, text in zip(batch["sid"], batch["text"]):
                s = shingles.of(text)
                out["sid"].append(sid)
                out["n"].append(len(s))
                out["shingles"].append(s.tobytes())
            return out
        return step

    rows = with_row_key(docs.select("doc_id", "text")).select("_d", "_t", "text")
    nameless = rows.filter(F.col("_d") == NO_ID).groupBy("_d", "_t").agg(F.any_value("text").alias("text"))
    found = rows.filter(F.col("_d") != NO_ID).unionByName(nameless).join(wanted, ["_d", "_t"]).dropDuplicates(["_d", "_t"]).select("sid", "text")
    return map_batches(found, "sid binary, n bigint, shingles binary", make)


def shared(nodes: DataFrame, small: int, last: bool) -> DataFrame:
    """(node, sid, members) of the nodes with at least two sets.

    Nodes that are solved as they are give the same links if they have the same members: of these one is enough. A large
    node that is still to be split stays, whatever others hold: it draws functions of its own, and the recall counts on
    these repetitions.
    """
    h = F.xxhash64("sid")
    own = F.lit(None).cast("long") if last else F.when(F.col("members") > small, F.col("node"))
    stats = (nodes.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(h).alias("_x"),
                                       F.sum(F.shiftright(h, 32)).alias("_y")).filter("members > 1")
             .groupBy("members", "_x", "_y", own.alias("_own")).agg(F.min("node").alias("node")).select("node", "members"))
    return nodes.join(stats, "node")


def split(large: DataFrame, sets: DataFrame, level: int) -> DataFrame:
    """(node, sid): the children of large nodes; a node's hash functions follow from its number."""
    def make():
        def step(batch):
            out = {"node": [], "sid": []}
            for node, sid, raw in zip(batch["node"], batch["sid"], batch["shingles"]):
                s = np.frombuffer(raw, np.uint64)
                own = mixed(np.array([node], np.int64).view(np.uint64), np.uint64(level))
                for j in range(2 if own[0] % np.uint64(4) == 3 else 1):
                    seed = mixed(own, np.uint64(100 + j))
                    out["node"].append(int(mixed(mixed(s, seed).min(keepdims=True), seed).view(np.int64)[0]))
                    out["sid"].append(sid)
            return out
        return step

    return map_batches(large.join(sets, "sid").select("node", "sid", "shingles"), "node bigint, sid binary", make).distinct()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of common shingles."""
    sizes = np.array([len(s) for s in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    keep = df[column] > 1
    row, column = row[keep], column[keep]
    _, column = np.unique(column, return_inverse=True)
    width = max(1, 20_000_000 // len(sets))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32 if sizes.max() < 1 << 24 else np.float64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        has = np.zeros((len(sets), min(width, int(column[-1]) + 1 - at)), total.dtype)
        has[row[lo:hi], column[lo:hi] - at] = 1
        total += has @ has.T
    return total.astype(np.int64)


def links(sets: list[np.ndarray]) -> np.ndarray:
    """Boolean matrix of the pairs at or above the threshold, without the diagonal."""
    sizes = np.array([len(s) for s in sets], np.int64)
    common = overlaps(sets)
    union = sizes[:, None] + sizes[None, :] - common
    out = THRESHOLD[1] * common >= THRESHOLD[0] * union
    np.fill_diagonal(out, False)
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """For every row the least row of its component."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            reached = np.zeros(len(linked), bool)
            front = reached.copy()
            front[i] = True
            while front.any():
                reached |= front
                front = linked[front].any(0) & ~reached
            root[reached] = i
    return root


def by_group(rows: DataFrame, key: list[str], columns: list[str], schema: str, solve) -> DataFrame:
    """Calls ``solve(group as dict of lists)`` for every run of equal keys; groups are bounded by construction.

    A set that comes twice (its document's row is repeated) counts once.
    """
    arrow = arrow_schema(schema)

    def run(batches):
        held, current = {c: [] for c in columns}, None
        out = {f.name: [] for f in arrow}

        def flush():
            first = list({sid: i for i, sid in reversed(list(enumerate(held["sid"])))}.values())[::-1]
            for name, values in solve({c: [v[i] for i in first] for c, v in held.items()}).items():
                out[name] += values

        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            keys = list(zip(*(batch.column(at[k]).to_pylist() for k in key)))
            values = [batch.column(at[c]).to_pylist() for c in columns]
            for i, k in enumerate(keys):
                if k != current:
                    if current is not None:
                        flush()
                    held, current = {c: [] for c in columns}, k
                for c, v in zip(columns, values):
                    held[c].append(v[i])
            if len(out[arrow.names[0]]) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
                out = {f.name: [] for f in arrow}
        if current is not None:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return rows.select(*dict.fromkeys([*key, *columns])).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def brute_force(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(sid, root): spanning forests of the links inside small nodes."""
    def solve(group):
        ids, parsed = group["sid"], [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        root = forest(links(parsed))
        hit = [i for i, r in enumerate(root.tolist()) if r != i]
        return {"sid": [ids[i] for i in hit], "root": [ids[root[i]] for i in hit]}

    return by_group(nodes.join(sets, "sid"), ["node"], ["sid", "shingles"], "sid binary, root binary", solve)


def block_pairs(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, _a, _b, sid, block, copies, shingles): groups dealt to pairs of blocks of bounded size.

    A group is cut by the hash of its sets into as many blocks as its shingles need; every set goes to the pairs that
    its block is part of.
    """
    rows = groups.join(sets, "sid")
    blocks = rows.groupBy("node").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_SETS))
                                      .cast("int").alias("_blocks"))
    cut = rows.join(blocks, "node").withColumn("block", F.pmod(F.xxhash64("sid", F.lit(7)), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return cut.withColumn("_o", other).select(
        "node", F.least("block", "_o").alias("_a"), F.greatest("block", "_o").alias("_b"), "sid", "block", "copies", "shingles")


def of_pair(group) -> np.ndarray:
    """Links that count for a pair of blocks: between the two, or inside if both are one."""
    parsed = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
    linked = links(parsed)
    if group["_a"][0] != group["_b"][0]:
        block = np.array(group["block"])
        linked &= block[:, None] != block[None, :]
    return linked


def brute_force_blocks(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(sid, root): as ``brute_force``, for nodes of any size."""
    def solve(group):
        root, ids = forest(of_pair(group)), group["sid"]
        hit = [i for i, r in enumerate(root.tolist()) if r != i]
        return {"sid": [ids[i] for i in hit], "root": [ids[root[i]] for i in hit]}

    cut = block_pairs(nodes.withColumn("copies", F.lit(1)), sets)
    return by_group(cut, ["node", "_a", "_b"], ["_a", "_b", "sid", "block", "shingles"], "sid binary, root binary", solve)


def count_links(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(sid, links): for every set of a class the documents, with their copies, that its documents link to."""
    def solve(group):
        counts = of_pair(group) @ np.array(group["copies"], np.int64)
        return {"sid": group["sid"], "links": counts.tolist()}

    cut = block_pairs(classes, sets)
    found = by_group(cut, ["node", "_a", "_b"], ["_a", "_b", "sid", "block", "copies", "shingles"],
                     "sid binary, links bigint", solve)
    return found.groupBy("sid").agg(F.sum("links").alias("links"))


def components(edges: DataFrame, label: str = "label") -> DataFrame:
    """(sid, label): the least set id of every component.

    Every round each set takes the least label around it, and labels take the label of their own set (pointer
    jumping), until no label changes. Minima are combined before they are shuffled; a set with very many links never
    gathers them.
    """
    both = edges.select("sid", F.col("root").alias("other")).unionByName(
        edges.select(F.col("root").alias("sid"), F.col("sid").alias("other"))).distinct()
    both = materialise(both, "links")
    now = materialise(both.groupBy("sid").agg(F.least(F.col("sid"), F.min("other")).alias(label)), "labels")
    while True:
        around = (both.join(now.select(F.col("sid").alias("other"), label), "other").groupBy("sid")
                  .agg(F.min(label).alias("_around")))
        nearer = now.join(around, "sid", "left").select("sid", F.col(label).alias("_old"),
                                                        F.least(label, "_around").alias("_mid"))
        jump = now.select(F.col("sid").alias("_mid"), F.col(label).alias("_far"))
        new = materialise(nearer.join(jump, "_mid", "left").select(
            "sid", "_old", F.least("_mid", "_far").alias(label)), "labels")
        if new.filter(F.col("_old") != F.col(label)).isEmpty():
            return new.select("sid", label)
        now = new.select("sid", label)


def classified(docs: DataFrame, recall: float, depth: int, small: int) -> DataFrame:
    """One row per document: _d, _t, sid, and of sets with a copy or a link copies, links and the first row of the class (head)."""
    ids = materialise(sets_of(docs, runs_for(recall, depth)), "set-ids")
    copies = (ids.filter("sid IS NOT NULL").groupBy("sid")
              .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("_d", "_t")).alias("head")))
    nodes = ids.filter("sid IS NOT NULL").select("sid", F.explode("nodes").alias("node")).distinct()
    level = materialise(shared(nodes, small, depth == 1), "nodes")
    wanted = level.select("sid").distinct().join(copies, "sid").select("sid", "head._d", "head._t")
    sets = materialise(shingle_sets(wanted, docs), "sets")
    edges = brute_force(level.filter(F.col("members") <= small), sets)
    for number in range(1, depth):
        large = level.filter(F.col("members") > small)
        if large.isEmpty():
            break
        level = materialise(shared(split(large, sets, number), small, number == depth - 1), "nodes")
        edges = edges.unionByName(brute_force(level.filter(F.col("members") <= small), sets))
    else:
        edges = edges.unionByName(brute_force_blocks(level.filter(F.col("members") > small), sets))
    labels = components(materialise(edges, "edges"))
    linked = labels.join(copies, "sid")
    counted = count_links(linked.select(F.col("label").alias("node"), "sid", "copies"), sets)
    heads = linked.groupBy("label").agg(F.min("head").alias("_head"))
    near = (linked.join(heads, "label").join(counted, "sid").select("sid", F.col("_head").alias("head"), "copies", "links"))
    alone = copies.filter("copies > 1").join(labels, "sid", "left_anti").select(
        "sid", "head", "copies", F.lit(0).cast("long").alias("links"))
    known = materialise(near.unionByName(alone), "classes")
    # only sets with a copy or a link are looked up; a join that is skewed by copies can be split
    return ids.select("_d", "_t", "sid").join(known, "sid", "left")


def join(docs: DataFrame, recall: float = TARGET_RECALL, depth: int = DEPTH, small: int = SMALL) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of the class), n_links, n_copies."""
    def named(column: str):
        return F.when(F.col(column) != NO_ID, F.col(column))

    return classified(docs, recall, depth, small).select(
        named("_d").alias("doc_id"), F.when(F.col("copies").isNull(), named("_d")).otherwise(named("head._d")).alias("class_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"))


def one_of_each(docs: DataFrame, recall: float = TARGET_RECALL, depth: int = DEPTH, small: int = SMALL) -> DataFrame:
    """The documents table with one row of each class: the first by doc_id (nulls last), then by a hash of the text; of
    equal rows of that id and text the one with the least lang and source. Rows without words are classes of their own and stay."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    found = classified(docs, recall, depth, small).filter("sid IS NOT NULL")
    kept = found.filter(F.col("copies").isNull() | (F.struct("_d", "_t") == F.col("head"))).select("_d", "_t").distinct()
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = W.partitionBy("_d", "_t").orderBy("lang", "source", "n_chars")
    rows = with_row_key(docs.select(*columns).filter(~wordless)).join(kept, ["_d", "_t"])
    return (rows.withColumn("_r", F.row_number().over(first)).filter("_r = 1").select(*columns)
            .unionByName(docs.select(*columns).filter(wordless)))
