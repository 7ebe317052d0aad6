"""How far the ranking and the allocation survive sampled weights.

Units stay wide (one row, one column per indicator) and the weight draws are a small broadcast
relation. Packs of units meet packs of draws as matrices (``functions/reweighted.py``); what leaves a task are sums, extremes
and the few units that can be picked, so units x draws are neither rows nor shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from equisite.functions import reweighted as rw
from equisite.functions.classify import stability
from equisite.functions.numbers import E9, div
from equisite.operators.allocation import conditions, optimal
from equisite.operators.index import need_by_vector
from equisite.plans.bounds import broadcast_if_small
from equisite.plans.session import materialise, setting

PPM = 1_000_000


def _uniform(seed: int, *parts: str) -> str:
    """A reproducible uniform in (0,1) from the first 52 bits of an md5 over the parts, as SQL text."""
    key = f"concat_ws('|', '{seed}', " + ", ".join(f"cast({p} as string)" for p in parts) + ")"
    return f"((cast(conv(substring(md5({key}), 1, 13), 16, 10) as double) + 0.5D) / {2 ** 52}D)"


def _normalised(draws: DataFrame, ids: Sequence[int]) -> DataFrame:
    total = " + ".join(f"g{i}" for i in ids)
    return draws.selectExpr("draw", *[f"floor(g{i} / ({total}) * {PPM} + 0.5D) AS w{i}" for i in ids])


def uniform_draws(draw_ids: DataFrame, ids: Sequence[int], seed: int) -> DataFrame:
    """Uniform over the simplex (flat Dirichlet, alpha 1), a pure function of (seed, draw)."""
    g = [f"-ln({_uniform(seed, 'draw', str(i))}) AS g{i}" for i in ids]
    return _normalised(draw_ids.selectExpr("draw", *g), ids)


def centred_draws(draw_ids: DataFrame, ids: Sequence[int], alphas: Sequence[int], seed: int) -> DataFrame:
    """Dirichlet around a base vector; whole alphas are sums of exponentials, so no Python runs."""
    g = [f"aggregate(sequence(1, {a}), 0.0D, (s, j) -> s - ln({_uniform(seed, 'draw', str(i), 'j')})) AS g{i}"
         for i, a in zip(ids, alphas)]
    return _normalised(draw_ids.selectExpr("draw", *g), ids)


TRIES = 40
"""Tries of one gamma sample. Each is accepted with more than 95 %, so none is left in 1 of 1e52 samples; that fails the query."""


def _gamma(alpha: float, seed: int, i: int) -> str:
    """A gamma sample as SQL text, by rejection (Marsaglia and Tsang) over numbered uniforms.

    A try squeezes a normal deviate z through d (1 + c z)^3. Below alpha 1 the sample for alpha + 1 is scaled by a power of
    one more uniform.
    """
    d = (alpha if alpha >= 1 else alpha + 1) - 1 / 3
    c = 1 / (3 * d ** 0.5)
    u1, u2, u3 = (_uniform(seed, "draw", str(i), "j", f"'{k}'") for k in "abc")
    z = f"sqrt(-2.0D * ln({u1})) * cos({2 * 3.141592653589793!r}D * {u2})"
    made = f"named_struct('z', {z}, 'v', power(1.0D + {c!r}D * {z}, 3.0D))"
    good = f"t.v > 0 AND ln({u3}) < 0.5D * t.z * t.z + {d!r}D - {d!r}D * t.v + {d!r}D * ln(t.v)"
    # the inner transform names a try's value once; tries after the accepted one are not made
    tried = f"element_at(transform(array({made}), t -> CASE WHEN {good} THEN {d!r}D * t.v END), 1)"
    sample = f"aggregate(sequence(1, {TRIES}), CAST(NULL AS DOUBLE), (g, j) -> CASE WHEN g IS NULL THEN {tried} ELSE g END)"
    sample = f"coalesce({sample}, raise_error('no gamma sample accepted'))"
    if alpha >= 1:
        return sample
    return f"{sample} * power({_uniform(seed, 'draw', str(i), repr('boost'))}, {1 / alpha!r}D)"


def gamma_draws(draw_ids: DataFrame, ids: Sequence[int], alphas: Sequence[float], seed: int) -> DataFrame:
    """Dirichlet with any positive alphas: a pure function of (seed, draw, indicator), as a row expression."""
    if min(alphas) <= 0:
        raise ValueError("alphas must be positive")
    g = [f"{_gamma(a, seed, i)} AS g{i}" for i, a in zip(ids, alphas)]
    return _normalised(draw_ids.selectExpr("draw", *g), ids)


def spread(base: DataFrame) -> DataFrame:
    """Units over all shuffle partitions before each row is repeated per draw.

    A few thousand units would otherwise be coalesced into one task, which would then make and
    sort units x draws rows alone.
    """
    partitions = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return base.repartition(partitions, "unit_id")


def sample_draws(draws: DataFrame, runs: int, seed: int) -> DataFrame:
    """A reproducible sample of draws without replacement."""
    return draws.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("draw").cast("string"))), "draw").limit(runs)


@dataclass(frozen=True)
class Dealt:
    """Every unit under every draw, as the two relations this is the product of. ``rows`` spells it out."""

    base: DataFrame
    draws: DataFrame
    ids: Sequence[int]
    objective: str = "gain_neutral"

    @property
    def divisor(self) -> str:
        """What need times the people served is divided by."""
        by = {"gain_neutral": "catchment_norm", "gain_population": f"{E9}L"}
        if self.objective not in by:
            raise ValueError(f"unknown objective: {self.objective}")
        return by[self.objective]

    def rows(self) -> DataFrame:
        """One row per unit and draw, dealt by draw."""
        need = need_by_vector(spread(self.base), self.draws, self.ids, keep=["grp", "zone", "catchment_norm", "rural_population"])
        gain = f"need_e9 * least(catchment_norm, rural_population) div {self.divisor}"
        return need.selectExpr("draw", "unit_id", "grp", "zone", "need_e9", f"{gain} AS gain").repartition("draw")


def dealt_by_draw(base: DataFrame, draws: DataFrame, ids: Sequence[int], objective: str = "gain_neutral") -> Dealt:
    """Every unit under every draw; ranks, picks and reports share it. A draw's number stands once."""
    dealt = Dealt(base, draws, ids, objective)
    _ = dealt.divisor
    return dealt


def _tasks(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


def _packed(df: DataFrame, columns: Sequence, n: int, name: str, by: Sequence[str]) -> DataFrame:
    """``n`` rows at most, by a hash of ``by``: ``name`` holds the packed rows, ``name``_pack their number."""
    pack = F.pmod(F.xxhash64(*by), F.lit(n)).cast("int").alias(f"{name}_pack")
    return (df.select(pack, F.struct(*columns).alias("_r")).repartition(min(n, _tasks(df.sparkSession)), f"{name}_pack")
            .groupBy(f"{name}_pack").agg(F.collect_list("_r").alias(name)))


def _packed_draws(draws: DataFrame, ids: Sequence[int], size: int | None = None) -> DataFrame:
    """Draws in packs of about ``size``, or all in one."""
    columns = [F.col("draw").cast("long").alias("draw"), *[F.col(f"w{i}").cast("long").alias(f"w{i}") for i in ids]]
    return _packed(draws, columns, 1 if size is None else max(1, -(-draws.count() // size)), "vectors", ["draw"])


def _percentiles(ids: Sequence[int]) -> list[Column]:
    return [F.col(f"p{i}").cast("long").alias(f"p{i}") for i in ids]


def _field(rows: pa.StructArray, name: str) -> np.ndarray:
    return rows.field(name).fill_null(0).to_numpy(zero_copy_only=False)


def _there(rows: pa.StructArray, name: str) -> np.ndarray:
    return rows.field(name).is_valid().to_numpy(zero_copy_only=False)


def _matrix(rows: pa.StructArray, ids: Sequence[int], letter: str) -> np.ndarray:
    return np.stack([_field(rows, f"{letter}{i}") for i in ids], axis=1)


def _units(rows: pa.StructArray, ids: Sequence[int], order: np.ndarray | slice = slice(None)) -> rw.Units:
    has = np.stack([_there(rows, f"p{i}") for i in ids], axis=1)
    return rw.Units(_matrix(rows, ids, "p")[order], has[order])


def _met(units: DataFrame, draws: DataFrame, made: Callable, schema: str) -> DataFrame:
    """``made(units, vectors)`` of every pack of units and every pack of draws, as rows of ``schema``."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                for columns in made(batch.column("units")[i].values, batch.column("vectors")[i].values):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)
    both = units.crossJoin(F.broadcast(draws))
    return both.repartition(_tasks(units.sparkSession), "units_pack", "vectors_pack").select("units", "vectors").mapInArrow(run, schema)


PACK, DRAWS_OF_A_PACK = 32_768, 500
"""Units and draws that a task meets at once."""


def _unit_packs(dealt: Dealt) -> DataFrame:
    columns = ["unit_id", "grp", "zone", *_percentiles(dealt.ids), F.expr("least(catchment_norm, rural_population)").cast("long").alias("served"),
               F.expr(dealt.divisor).cast("long").alias("by")]
    return _packed(dealt.base, columns, max(1, -(-dealt.base.count() // PACK)), "units", ["unit_id"])


def _id_order(rows: pa.StructArray, first: np.ndarray | None = None) -> np.ndarray:
    """Places of units by id (missing ones first), inside ``first`` if given."""
    keys = [_field(rows, "unit_id"), _there(rows, "unit_id")]
    return np.lexsort(keys if first is None else [*keys, first])


def ranked_by_draw(dealt: Dealt) -> DataFrame:
    """Unique 1-based rank per draw; rank 1 is the highest need, ties in unit order."""
    place = F.row_number().over(Window.partitionBy("draw").orderBy(F.col("need_e9").desc(), "unit_id"))
    return dealt.rows().withColumn("rank", place.cast("long"))


def best_of_groups(dealt: Dealt, cap: int) -> DataFrame:
    """The units that can be among the ``cap`` best of their group under a draw: those that are it in their pack."""
    ids, kind = list(dealt.ids), dict(dealt.base.dtypes)["unit_id"]

    def made(rows, vectors):
        codes = rows.field("grp").dictionary_encode(null_encoding="encode").indices.to_numpy()
        order = _id_order(rows, codes)
        starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
        units, served, by = _units(rows, ids, order), _field(rows, "served")[order], _field(rows, "by")[order]
        known = (_there(rows, "served") & _there(rows, "by"))[order]
        w, draw = _matrix(vectors, ids, "w"), _field(vectors, "draw")
        for part in rw.vector_blocks(w, units.n):
            need = units.needs(w[part])
            gain = rw.gains(need, served, by, known)
            row, place = rw.best_of_groups(gain, starts, cap)
            found = [rows.field(c).take(pa.array(order[place])) for c in ("unit_id", "grp", "zone")]
            need, gain = need[row, place], gain[row, place]
            yield [draw[part][row], *found, pa.array(need, mask=need == rw.NONE), pa.array(gain, mask=gain == rw.NONE)]
    return _met(_unit_packs(dealt), _packed_draws(dealt.draws, ids, DRAWS_OF_A_PACK), made,
                f"draw long, unit_id {kind}, grp string, zone string, need_e9 long, gain long").repartition("draw")


def picked_by_draw(dealt: Dealt, base: DataFrame, budget: int, cap: int, floor: int) -> DataFrame:
    """The optimum of every draw, from the best ``cap`` per group of every pack of units: a pack sends no others.

    Whether the problem is feasible depends on the candidates alone, so it is decided once for all draws.
    """
    return optimal(best_of_groups(dealt, min(cap, budget)), budget, cap, floor, keys=["draw"], facts=conditions(base, budget, cap, floor, ()))


def per_draw(dealt: Dealt, picks: DataFrame, top_n: int) -> DataFrame:
    """One row per draw: extremes and mean of need, the top's ids by place, number, gain and ids of the picks.

    Packs of units send sums, extremes and their own top; a draw's top is that of all packs' tops.
    """
    ids, kind = list(dealt.ids), dict(dealt.base.dtypes)["unit_id"]

    def made(rows, vectors):
        order = _id_order(rows)
        units, w, draw = _units(rows, ids, order), _matrix(vectors, ids, "w"), _field(vectors, "draw")
        unit_ids = rows.field("unit_id").take(pa.array(order))
        for part in rw.vector_blocks(w, units.n):
            need = units.needs(w[part])
            there = need != rw.NONE
            none = ~there.any(1)
            keys, mask = rw.order_keys(need)
            first = min(top_n, units.n)
            at = (np.partition(keys, first - 1, axis=1)[:, :first] if first < units.n else keys) & mask
            flat = np.take_along_axis(need, at, 1).ravel()
            tops = pa.StructArray.from_arrays([pa.array(flat, mask=flat == rw.NONE), unit_ids.take(pa.array(at.ravel()))], ["need_e9", "unit_id"])
            yield [draw[part], np.full(len(need), units.n), pa.array(np.where(there, need, rw.LIMIT).min(1), mask=none),
                   pa.array(need.max(1), mask=none), pa.array(np.where(there, need, 0).sum(1), mask=none),
                   pa.ListArray.from_arrays(np.arange(len(need) + 1, dtype=np.int32) * first, tops)]
    parts = _met(_unit_packs(dealt), _packed_draws(dealt.draws, ids, DRAWS_OF_A_PACK), made,
                 f"draw long, n long, least long, most long, total long, tops array<struct<need_e9:long,unit_id:{kind}>>")
    parts = materialise(parts, "draw-parts")
    need = parts.groupBy("draw").agg(
        F.sum("n").alias("units"), F.min("least").alias("least_need_e9"), F.max("most").alias("most_need_e9"),
        div(F.sum("total"), F.sum("n")).alias("mean_need_e9"))
    place = F.row_number().over(Window.partitionBy("draw").orderBy(F.col("need_e9").desc(), "unit_id"))
    tops = parts.select("draw", F.inline("tops")).withColumn("rank", place.cast("long")).filter(F.col("rank") <= top_n)
    tops = tops.groupBy("draw").agg(F.coalesce(F.sum(F.col("unit_id") * F.col("rank")), F.lit(0)).alias("top_ids"))
    chosen = picks.groupBy("draw").agg(F.count("*").alias("picks"), F.sum("gain").alias("gain"), F.sum("unit_id").alias("picked_ids"))
    return need.join(tops, "draw").join(chosen, "draw", "left")


BAND_PACK = 2048
"""Units whose draws one task goes through, some at a time."""


def need_band(base: DataFrame, draws: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Mean and the 5 % and 95 % quantiles of a unit's need; collapses inside the task that made it.

    A pack of units meets all draws, a few units at a time, so no draw of a unit is shuffled or kept.
    Quantiles are interpolated, so they are kept to six places: the ninth would hang on float rounding.
    """
    ids, kind = list(ids), dict(base.dtypes)["unit_id"]
    vectors = base.groupBy("unit_id", *_percentiles(ids)).agg(F.count("*").alias("copies"))
    n = max(1, -(-base.count() // BAND_PACK), _tasks(base.sparkSession))

    def made(rows, draws_of):
        order = _id_order(rows)
        unit_ids, copies = rows.field("unit_id").take(pa.array(order)), _field(rows, "copies")[order]
        units, w = _units(rows, ids, order), _matrix(draws_of, ids, "w")
        starts = np.flatnonzero(np.r_[True, (np.diff(_field(rows, "unit_id")[order]) != 0) | np.diff(_there(rows, "unit_id")[order])])
        ends = np.r_[starts[1:], units.n]
        for first, last in _runs(starts, ends, max(1, rw.BLOCK // max(1, len(w)))):
            low, high = starts[first], ends[last - 1]
            need = np.ascontiguousarray(units.part(low, high).needs(w).T)
            need.sort(axis=1)
            many, there = copies[low:high], need != rw.NONE
            sums = np.where(there, need, 0).sum(1) * many
            q = [rw.quantiles(need, many, x) for x in (0.05, 0.95)]
            own = starts[first:last] - low
            for k in np.flatnonzero(ends[first:last] - starts[first:last] > 1):  # a unit with several vectors
                mine = slice(own[k], ends[first + k] - low)
                values, weights = need[mine].ravel(), np.repeat(many[mine], len(w))
                at = np.argsort(values, kind="stable")
                at = at[values[at] != rw.NONE]
                for x, out in zip((0.05, 0.95), q):
                    out[own[k]] = rw.quantile_at(values[at], np.cumsum(weights[at]), x) if len(at) else np.nan
            none = np.add.reduceat(there.sum(1), own) == 0
            yield [unit_ids.take(pa.array(starts[first:last])), np.add.reduceat(many, own) * len(w), pa.array(np.add.reduceat(sums, own), mask=none),
                   *[pa.array(x[own], mask=none) for x in q]]
    packs = _packed(vectors, ["unit_id", *[f"p{i}" for i in ids], "copies"], n, "units", ["unit_id"])
    rows = _met(packs, _packed_draws(draws, ids), made, f"unit_id {kind}, draws long, total long, p05 double, p95 double")
    return rows.select("unit_id", "draws", div(F.col("total"), F.col("draws")).alias("mean_need_e9"),
                       F.round(F.col("p05") / 1000).cast("long").alias("p05_need_e6"), F.round(F.col("p95") / 1000).cast("long").alias("p95_need_e6"))


def _runs(starts: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole units with about ``size`` rows together."""
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + size, side="right")))
        yield first, last
        first = last


SKETCH_K = 800
SKETCH_ERROR = 0.015
"""A sketch of this size answers for a rank within 0.4 % of the draws 99 times of 100; the stated bound is four times that."""


def need_band_sketch(need: DataFrame) -> DataFrame:
    """``need_band`` from mergeable quantile sketches over (unit_id, need_e9) rows.

    A unit's draws are not gathered: each task sends a few kilobytes per unit, so draws may be spread over tasks. The
    quantiles are values of the unit whose rank is off by at most ``SKETCH_ERROR``.
    """
    sketch = F.kll_sketch_agg_bigint("need_e9", F.lit(SKETCH_K))

    def at(q: float) -> Column:
        return F.kll_sketch_get_quantile_bigint("_s", F.lit(q))
    return (need.groupBy("unit_id").agg(F.count("*").alias("draws"), div(F.sum("need_e9"), F.count("*")).alias("mean_need_e9"), sketch.alias("_s"))
            .select("unit_id", "draws", "mean_need_e9", at(0.05).alias("p05_need_e9"), at(0.95).alias("p95_need_e9")))


UNITS_OF_A_TASK = 512
"""Units whose sketches one task holds, about 20 KB each."""

FALLBACK_KEY = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
"""Groups beyond which Spark sorts the rows instead of holding the groups' sketches: here it would sort units x draws."""


def needs_by_unit(units: DataFrame, draws: DataFrame, ids: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """Need of every unit under every draw. All rows of a unit are made in one task, so reports by unit shuffle none of them."""
    n = max(1, -(-units.count() // UNITS_OF_A_TASK), _tasks(units.sparkSession))
    return need_by_vector(units.repartition(n, "unit_id"), broadcast_if_small(draws), ids, keep)


def sketched_bands(base: DataFrame, draws: DataFrame, ids: Sequence[int]) -> DataFrame:
    """``need_band_sketch`` of every unit under every draw, written: a task holds its units' sketches and sends one row for each."""
    need = needs_by_unit(base, draws, ids).select("unit_id", "need_e9")
    with setting(base.sparkSession, FALLBACK_KEY, str(16 * UNITS_OF_A_TASK)):
        return materialise(need_band_sketch(need), "bands")


HELD = 8_000_000
"""Units that one task holds (some 80 bytes each) to rank them under its draws."""

DRAWS_OF_A_TASK, SENT = 128, 6 << 30
"""Draws that a task ranks all units under; more of them where the units, sent to every task, and its sums would take more than ``SENT``."""

PIECE = 16_384
"""Units, in the order of their ids, whose sums come from every task as one row."""

ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SUMS = {"top": np.int32, "total": np.int64, "least": np.int32, "most": np.int32}


def _blocks(spark: SparkSession, units: int, unit_bytes: int, draws: int) -> int:
    """Blocks of draws, one for a task: few enough to send the units to each, but one for every core."""
    cores, wanted = spark.sparkContext.defaultParallelism, max(1, -(-draws // DRAWS_OF_A_TASK))
    return min(wanted, max(cores, SENT // max(1, units * unit_bytes) // cores * cores))


def rank_stability(dealt: Dealt, top_n: int) -> DataFrame:
    """Times in the top, mean, best and worst rank of every unit.

    A rank needs all units of a draw. Up to ``HELD`` of them are sent to every block of draws, in packs: fewer bytes by far than
    units x draws. A task ranks them under its draws one by one, in the order of their ids, so that the sums of all blocks
    meet by place, and the sums are written. More units are shuffled by draw.
    """
    ids, kind = list(dealt.ids), dict(dealt.base.dtypes)["unit_id"]
    spark, names = dealt.base.sparkSession, [f"p{i}" for i in ids]
    found = dealt.base.agg(F.count("*").alias("n"), *[F.max(F.abs(p)).alias(f"p{i}") for i, p in zip(ids, _percentiles(ids))]).head()
    n, short = found["n"], max([0, *(found[p] or 0 for p in names)]) < 1 << 31
    if n > HELD:
        sums = ranked_by_draw(dealt).groupBy("unit_id").agg(
            F.count("*").alias("n"), F.count_if(F.col("rank") <= top_n).alias("top"), F.sum("rank").alias("total"),
            F.min("rank").alias("least"), F.max("rank").alias("most"))
        return _rank_report(sums)
    width = 4 if short else 8
    number = np.dtype(f"i{width}")
    vectors = dealt.draws.count()
    blocks = _blocks(spark, n, 8 + width * len(ids) + 8 + sum(np.dtype(t).itemsize for t in _SUMS.values()), vectors)
    size = max(1, -(-vectors // blocks))
    schema = f"piece long, unit_id array<{kind}>, n long, {', '.join(f'{c} binary' for c in _SUMS)}"
    arrow, out = (to_arrow_schema(StructType.fromDDL(x)) for x in (schema, f"unit_id {kind}, n long, {', '.join(f'{c} long' for c in _SUMS)}"))

    def ranked(batches):
        p, has, unit_ids, w, at = np.empty((len(ids), n), number), None, [], None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("unit_id")[i].values
                to = slice(at, at + len(own))
                unit_ids.append(own.take(pa.array(np.arange(len(own)))))  # a copy: a batch is not kept
                for j, c in enumerate(names):
                    one = batch.column(c)[i].values
                    p[j, to] = one.fill_null(0).to_numpy(zero_copy_only=False)
                    if one.null_count:
                        has = np.ones(p.shape, bool) if has is None else has
                        has[j, to] = one.is_valid().to_numpy(zero_copy_only=False)
                w, at = _matrix(batch.column("vectors")[i].values, ids, "w") if w is None else w, to.stop
        if w is None:
            return
        unit_ids = pa.concat_arrays(unit_ids)
        order = np.lexsort([unit_ids.fill_null(0).to_numpy(zero_copy_only=False), unit_ids.is_valid().to_numpy(zero_copy_only=False)])
        for row in [*p, *([] if has is None else has)]:
            row[:at] = row[order]
        unit_ids = unit_ids.take(pa.array(order))
        del order, batches
        sums = dict(zip(_SUMS, rw.rank_sums(rw.Units.of_rows(p[:, :at], None if has is None else has[:, :at]), w, top_n)))
        for low in range(0, at, PIECE):
            told = unit_ids.slice(low, PIECE)
            parts = [[sums[c][low:low + PIECE].astype(t).tobytes()] for c, t in _SUMS.items()]
            columns = [[low], pa.ListArray.from_arrays([0, len(told)], told), [len(w)], *parts]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, list) else c.cast(t) for c, t in zip(columns, arrow.types)], schema=arrow)

    def merged(table: pa.Table) -> pa.Table:
        unit_ids, parts = table.column("unit_id")[0].values, {c: np.stack([np.frombuffer(x.as_py(), t) for x in table.column(c)]) for c, t in _SUMS.items()}
        drawn = np.full(len(unit_ids), sum(table.column("n").to_pylist()))
        columns = [unit_ids, drawn, parts["top"].sum(0), parts["total"].sum(0), parts["least"].min(0), parts["most"].max(0)]
        return pa.Table.from_arrays([pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, out.types)], schema=out)
    packs = _packed(dealt.base, ["unit_id", *_percentiles(ids)], max(1, -(-n // PACK)), "units", ["unit_id"])
    packs = packs.select("units.unit_id", *[F.col(f"units.{c}").cast(f"array<{'int' if short else 'long'}>").alias(c) for c in names])
    both = packs.crossJoin(F.broadcast(_packed_draws(dealt.draws, ids, size))).repartitionById(max(1, -(-vectors // size)), F.col("vectors_pack"))
    sums = both.select("vectors", "unit_id", *names).mapInArrow(ranked, schema).groupBy("piece").applyInArrow(
        merged, f"unit_id {kind}, n long, {', '.join(f'{c} long' for c in _SUMS)}")
    with setting(spark, ROWS_KEY, "8"):  # a pack is a row of a megabyte
        sums = materialise(sums, "rank-sums")
    return _rank_report(sums.groupBy("unit_id").agg(*[F.sum(c).alias(c) for c in ("n", "top", "total")], F.min("least").alias("least"), F.max("most").alias("most")))


def _rank_report(sums: DataFrame) -> DataFrame:
    return sums.select("unit_id", F.col("top").alias("times_in_top_n"), div(F.col("total") * 100, F.col("n")).alias("mean_rank_centi"),
                       F.col("least").alias("best_rank"), F.col("most").alias("worst_rank"))


def alloc_stability(base: DataFrame, picks: DataFrame) -> DataFrame:
    """Share of solved draws that select each unit, and its class; picks are a budget of rows per draw."""
    times = picks.groupBy("unit_id").agg(F.count("*").alias("times_allocated"))
    runs = picks.select("draw").distinct().agg(F.count("*").alias("runs"))
    joined = base.select("unit_id").join(times, "unit_id", "left").crossJoin(F.broadcast(runs))
    t = F.coalesce("times_allocated", F.lit(0))
    return joined.select("unit_id", "runs", t.alias("times_allocated"), stability(t, F.col("runs")).alias("classification"))


def regime(name: str, base: DataFrame, draws: DataFrame, ids: Sequence[int], top_n: int, budget: int, cap: int,
           floor: int, objective: str = "gain_neutral", runs: int | None = None, seed: int = 42) -> DataFrame:
    """One regime's full table. ``runs`` limits the re-solved draws; by default all are solved."""
    dealt = dealt_by_draw(base, draws, ids, objective)
    solved = dealt if runs is None else dealt_by_draw(base, sample_draws(draws, runs, seed), ids, objective)
    # each is written when it stands, so that the shuffles of one are gone before those of the next
    picks = materialise(picked_by_draw(solved, base, budget, cap, floor).select("draw", "unit_id"), "picks")
    bands = materialise(need_band(base, draws, ids), "bands")
    return (bands.join(rank_stability(dealt, top_n), "unit_id")
            .join(alloc_stability(base, picks), "unit_id").withColumn("regime", F.lit(name)))


def confidence(picks: DataFrame, sens: DataFrame) -> DataFrame:
    """Stored picks with both regimes side by side."""
    def side(name: str, extra=()) -> DataFrame:
        return sens.filter(F.col("regime") == name).select(
            "unit_id", F.col("times_allocated").alias(f"times_allocated_{name}"),
            F.col("times_in_top_n").alias(f"times_in_top_n_{name}"),
            F.col("classification").alias(f"classification_{name}"), *extra)
    out = picks.join(side("centred", ("mean_rank_centi", "best_rank", "worst_rank")), "unit_id", "left")
    return (out.join(side("uniform"), "unit_id", "left")
            .orderBy(F.col("times_allocated_centred").desc_nulls_last(), "unit_id"))


def class_counts(sens: DataFrame, picks: DataFrame) -> DataFrame:
    """Robust, contested and excluded among the allocated units, per regime."""
    return (sens.join(picks.select("unit_id"), "unit_id", "left_semi")
            .groupBy("regime", "classification").agg(F.count("*").alias("n")))


def contested(conf: DataFrame) -> DataFrame:
    return conf.filter(F.col("classification_centred") == "contested")
