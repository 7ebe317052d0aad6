"""The split ranks equal the plain windows, with hot values and few or many distinct ones."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equisite.operators import ranking as rk


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(600):
        value = 500 if i % 3 == 0 else rng.randrange(0, 3000)  # one value holds a third of the rows
        data.append((("a", "b")[i % 2], i, value))
    return spark.createDataFrame(data, "k string, unit_id long, value long").persist()


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("width", [40, 1_000_000])
def test_ranks_equal_the_windows(rows, width):
    up, down = Window.partitionBy("k").orderBy("value"), Window.partitionBy("k").orderBy(F.col("value").desc())
    want = rows_of(rows.select("k", "unit_id", F.rank().over(down)))
    assert rows_of(rk.rank_desc(rows, ["k"], "value", "r", width=width).select("k", "unit_id", "r")) == want
    want = rows_of(rows.select("k", "unit_id", F.row_number().over(down.orderBy(F.col("value").desc(), "unit_id"))))
    assert rows_of(rk.order_rank(rows, ["k"], "value", "unit_id", "r", width=width).select("k", "unit_id", "r")) == want
    got = rk.percent_rank_e9(rows, ["k"], "value", "p", width=width).withColumn("q", F.percent_rank().over(up))
    assert got.count() == rows.count() and got.filter(F.abs(F.col("p") / 1e9 - F.col("q")) > 2e-9).count() == 0


@pytest.mark.parametrize("width", [40, 1_000_000])
def test_ranks_of_several_levels_equal_the_windows(rows, width):
    zoned = rows.withColumn("z", F.col("unit_id") % 5)
    whole, group = Window.partitionBy("k"), Window.partitionBy("k", "z")
    down = F.col("value").desc()
    want = rows_of(zoned.select("k", "z", "unit_id", F.rank().over(whole.orderBy(down)), F.count("*").over(whole), F.sum("value").over(whole),
                                F.rank().over(group.orderBy(down)), F.count("*").over(group), F.sum("value").over(group)))
    got = rk.ranks_in_levels(zoned, {"a": ["k"], "b": ["k", "z"]}, "value", width=width)
    assert rows_of(got.select("k", "z", "unit_id", "a_rank", "a_size", "a_sum", "b_rank", "b_size", "b_sum")) == want


def test_percent_rank_without_broadcast(rows, monkeypatch):
    want = rows_of(rk.percent_rank_e9(rows, ["k"], "value", "p"))
    monkeypatch.setattr(rk, "BROADCAST_ROWS", 3)
    assert rows_of(rk.percent_rank_e9(rows, ["k"], "value", "p", width=64)) == want


def test_keep_first(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, "z")], "k int, line int, v string")
    assert {tuple(r) for r in rk.keep_first(df, ["k"], "line").collect()} == {(1, 1, "a"), (2, 9, "z")}


def test_top_k_limits_before_the_shuffle(rows):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        rk.top_k_per_group(rows, ["k"], "value", 3, "unit_id").explain()
    assert "WindowGroupLimit" in out.getvalue()
