"""Cover-tree join, conversation repair and hard negatives against SQL and brute force, edge cases included."""

import itertools
import random

import duckdb
import numpy as np
import pytest

from equisite.llm import anchor_tree, conversation, cover_tree
from suite import check

INF, NAN = float("inf"), float("nan")
VECTORS = "vec_id bigint, embedding array<double>, label int, sid string, v int, cell int, dim int, grp string, block int, n_links int"


def compared(spark, path, table, df, query, oracle):
    """What the query gives on the written rows, after it was held against the SQL."""
    df.write.mode("overwrite").parquet(f"{path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    result = check.compare(spark, con, str(path), lambda s, d: query(s.read.parquet(f"{d}/{table}.parquet")), oracle)
    assert result.startswith("ok"), result
    return query(spark.read.parquet(f"{path}/{table}.parquet"))


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1, 2, 3, "y", 4, 5) for i, v, k in rows], VECTORS).repartition(3)


def clustered(count, dim, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, count // 20), dim))
    return (centres[rng.integers(0, len(centres), count)] * rng.uniform(0.5, 3, (count, 1))
            + rng.normal(size=(count, dim)) * spread * np.sqrt(dim))


ODD = [(1, [1.0, 0.0], 1), (2, [2.0, 0.001], 1), (3, [0.0, 0.0], 2), (4, None, 2), (5, [1.0, None], 2), (6, [NAN, 1.0], 3),
       (7, [INF, 1.0], 3), (8, [], 3), (9, [1.0, 0.0, 0.0], 4), (10, [1.0, 0.0], 4), (10, [1.0, 0.0], 4), (None, [1.0, 0.0], 5),
       (None, [0.0, 1.0], 5), (None, [0.0, 1.1], None), (11, [-1.0, 0.0], 5), (100, [0.9, 0.1], 1), (200, [1.0, 0.0, 0.1], None),
       (300, [1e-300, 1e-300], 5), (0, [0.5, 0.5], 4), (400, [1.0, 0.0], 1), (14, [0.8, 0.0], 0)]


@pytest.fixture
def few_to_a_group(monkeypatch):
    for module in (cover_tree, anchor_tree):
        monkeypatch.setattr(module, "GROUP", 150)
    monkeypatch.setattr(cover_tree, "SAMPLE", 100)


class TestCoverTree:
    def test_odd_rows(self, spark, tmp_path):
        got = compared(spark, tmp_path, "embeddings", vectors(spark, ODD), cover_tree.join, cover_tree.oracle_sql())
        rows = {r.vec_id: r for r in got.collect()}
        assert got.count() == len(ODD)
        assert rows[10].n_links == 7 and rows[10].component_id == 1 and not rows[10].kept
        assert rows[3].n_links == rows[5].n_links == rows[9].n_links - 1 == 0 and rows[3].kept

    def test_empty(self, spark, tmp_path):
        assert cover_tree.join(vectors(spark, ODD).limit(0)).count() == 0
        assert cover_tree.join(vectors(spark, [(3, [0.0], 1), (4, None, 1)])).count() == 2

    @pytest.mark.parametrize("count, dim, spread", [(900, 6, 0.1), (900, 24, 0.02), (600, 3, 0.3), (500, 40, 1.0)])
    def test_many_groups(self, spark, tmp_path, few_to_a_group, count, dim, spread):
        rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered(count, dim, dim, spread))]
        rows += [(count + i, rows[0][1], 0) for i in range(300)]  # copies: a third of a table
        compared(spark, tmp_path, "embeddings", vectors(spark, rows), cover_tree.join, cover_tree.oracle_sql())

    def test_bounds(self):
        points = cover_tree.unit(clustered(400, 5, 3))
        levels = cover_tree.Levels(points[:60], 0.1)
        cell = cover_tree.distances(points, levels.net).argmin(1)
        radius = np.full(len(levels.net), -1.0)
        np.maximum.at(radius, cell, cover_tree.distances(points, levels.net)[np.arange(400), cell])
        reach = np.sqrt(0.2)
        close = cover_tree.distances(points, points) <= reach
        left = levels.surviving(radius, reach)
        i, j = np.nonzero(close)
        assert left[cell[i], cell[j]].all() and left.mean() < 0.9
        group = cover_tree.Group(points, cell.astype(np.int32), np.zeros(400, "S16"), np.ones(400, int), 0.9)
        found = [np.stack(x) for x in group.links(group)]
        assert sum(x.shape[1] for x in found) == (group.x @ group.x.T >= 0.9).sum()
        compare, sure = cover_tree.traversed(group.levels, group.levels, reach)
        assert compare.mean() < 0.7 and sure.any()

    def test_levels_halve(self):
        levels = cover_tree.Levels(cover_tree.unit(clustered(200, 8, 5)), 0.05)
        for k in range(levels.paths.shape[1] - 1):
            net = np.unique(levels.paths[:, k])
            assert set(net) <= set(levels.paths[:, k + 1])  # nested
            if k and len(net) > 1:
                apart = cover_tree.distances(levels.net[net], levels.net[net])[~np.eye(len(net), dtype=bool)]
                assert apart.min() >= 2 / 2 ** k - 1e-9  # separated by the level's radius


class TestHardNegatives:
    def test_odd_rows(self, spark, tmp_path):
        got = compared(spark, tmp_path, "embeddings", vectors(spark, ODD), anchor_tree.mine, anchor_tree.oracle_sql())
        assert {r.anchor_id for r in got.collect()} <= {0, 100, 300, 400} and got.count() > 0

    def test_empty(self, spark):
        assert anchor_tree.mine(vectors(spark, ODD).limit(0)).count() == 0
        assert anchor_tree.mine(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0

    @pytest.mark.parametrize("spread", [0.02, 1.0])
    def test_many_groups_and_ties(self, spark, tmp_path, few_to_a_group, monkeypatch, spread):
        monkeypatch.setattr(anchor_tree, "ANCHOR_EVERY", 5)
        monkeypatch.setattr(anchor_tree, "BLOCK", 20)
        sql = anchor_tree.oracle_sql()
        rows = [(i, v.tolist(), i % 3) for i, v in enumerate(clustered(500, 6, 8, spread))]
        rows += [(500 + i, rows[0][1], i % 2) for i in range(250)]
        compared(spark, tmp_path, "embeddings", vectors(spark, rows), anchor_tree.mine, sql)

    def test_bounds_spare_work(self):
        points = np.floor(256 * clustered(300, 8, 2, 0.01))
        tree = anchor_tree.Tree(points[:40])
        exact = points[:40] @ points.T
        low, high = np.quantile(exact, 0.97, axis=1), np.full(40, np.inf)
        scores, known = tree.rescored(points[:40], points, np.sqrt((points ** 2).sum(1)), np.ones((40, 300), bool), low, high)
        assert (scores[known] == exact[known]).all() and known[exact >= low[:, None]].all() and known.mean() < 0.8

    def test_spanning_tree_is_least(self):
        points = np.random.default_rng(0).normal(size=(6, 3))
        _, parent, edge = anchor_tree.spanning_tree(points)
        apart = cover_tree.distances(points, points)
        trees = [t for t in itertools.product(range(6), repeat=5) if all(t[i] != i + 1 for i in range(5))]

        def rooted(t):
            for i in range(1, 6):
                at, hops = i, 0
                while at and hops < 6:
                    at, hops = t[at - 1], hops + 1
                if at:
                    return False
            return True

        assert edge.sum() == pytest.approx(min(sum(apart[i + 1, t[i]] for i in range(5)) for t in trees if rooted(t)))


ROLES = ["user", "assistant", "system", "tool", "usher", "", None]
TALK = "conv_id bigint, turn bigint, role string, text string, n int, initial string, _k string, blank string, part int, seq int"


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", "z", 2, 3) for r in rows], TALK).repartition(4)


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.05 else t if rng.random() < 0.9 else rng.randint(0, 2 * longest)
            text = rng.choice(["Yes.", "No?", "Well then", "It is so!\n", " \t", "", None, f"Line {rng.randint(0, 99)}.", f"cut {t}", "a.b, c"])
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.7 else rng.choice(ROLES)
            yield c if c else None, turn, role, text


class TestRepair:
    def test_random_rows(self, spark, tmp_path):
        got = compared(spark, tmp_path, "conversations", talk(spark, list(random_rows(1, 150, 12))), conversation.repair, conversation.oracle_sql())
        assert len({r.audit for r in got.collect()}) > 50

    @pytest.mark.parametrize("block", [4, 16])
    def test_long_conversation(self, spark, tmp_path, block):
        rows = [(7, t, r, x) for _, t, r, x in random_rows(5, 60, 14)]
        rows = [(7, i, r, f"{x} {i}." if x and i % 3 else x) for i, (_, _, r, x) in enumerate(rows)] + list(random_rows(6, 40, 5))
        rows += [(7, 3, "user", "the same again.")] * 300
        compared(spark, tmp_path, "conversations", talk(spark, rows), lambda d: conversation.repair(d, block), conversation.oracle_sql())

    def test_odd_tables(self, spark):
        assert conversation.repair(talk(spark, [(1, 1, "user", "a.")]).limit(0)).count() == 0
        gone = next(t for t in range(200) if __import__("zlib").crc32(f"1:{t}".encode()) % 20 == 0)
        row = conversation.repair(talk(spark, [(1, gone, "user", "Gone.")])).collect()[0].asDict()
        assert row == {"conv_id": 1, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                       "repaired_sha256": conversation.EMPTY_HASH}
        long = "word. " * 200_000
        assert conversation.repair(talk(spark, [(1, t, "user", long + str(t)) for t in range(1, 30)])).count() == 1

    def test_lattice_against_all_edits(self):
        rng = random.Random(4)
        for _ in range(60):
            steps = [(rng.choice("suat"), rng.random() < 0.3, 0 if rng.random() < 0.8 else rng.randint(1, 2)) for _ in range(rng.randint(0, 4))]
            lattice = conversation.Lattice(steps, conversation.BEHIND)
            cost = lattice.auction(conversation.START)
            audit, ends = lattice.traced([conversation.START], lattice.alive())
            found = []
            self.every_edit(steps, 0, "", "", 0, 0, found)
            assert (cost, audit + conversation.tail_of(ends)) == min(found)

    def every_edit(self, steps, place, letters, out, cost, inserts, found):
        import re
        if place == len(steps) and re.fullmatch("(s?(ua)+)?", out):
            found.append((cost, letters))
        if inserts < 3:
            for x in "ua":
                self.every_edit(steps, place, letters + "I", out + x, cost + 5, inserts + 1, found)
        if place == len(steps):
            return
        initial, cut, count = steps[place]
        self.every_edit(steps, place + 1, letters + "D" * max(1, count), out, cost + 2 * max(1, count), inserts, found)
        if not count:
            self.every_edit(steps, place + 1, letters + "K", out + initial, cost + 5 * cut, inserts, found)
            for x in "ua":
                self.every_edit(steps, place + 1, letters + "R", out + x, cost + 1 + 5 * cut, inserts, found)

    def test_blocks_agree_with_the_whole(self):
        rng = random.Random(9)
        for _ in range(30):
            steps = [(rng.choice("suuaa"), rng.random() < 0.2, 0 if rng.random() < 0.8 else 1) for _ in range(rng.randint(2, 20))]
            whole = conversation.Lattice(steps, conversation.BEHIND)
            cost, at = whole.auction(conversation.START), rng.randint(1, len(steps) - 1)
            ways = conversation.between(steps[at:])
            behind = [min(ways[4 * a + b] + conversation.BEHIND[b] for b in range(4)) for a in range(4)]
            assert conversation.Lattice(steps[:at], behind).auction(conversation.START) == cost
