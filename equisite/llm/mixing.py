"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame functions.

Every source's documents are shuffled (hash order), laid end to end and cut into blocks of equally many words. Slot i
of the mix has the point ``i * golden ratio mod 1`` (whole-number arithmetic); the cumulative target shares map it to
a source, its rank among the slots of that source picks the block, and after the last block the source starts over.
A source leaves the schedule when its target is reached; its last slot is cut to the word. Slots that a source still
lacks at the end (a handful, the discrepancy of the sequence) are appended.

Hot sources: running totals are taken inside hash buckets of a source and over the (at most ``BUCKETS``) bucket sums,
ranks inside runs of slots and over run counts, so no window holds more than a small share of a source. Only the
relation with one row per source is ordered by a single task: weights are set by hand, source by source.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, last in order; a null
doc_id is a document like others; repeated rows count each; an empty table gives an empty mix. Only doc_id, source and
text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
TOTAL_PCT = 150
MAX_EPOCHS = 2
BLOCK_WORDS = 1024
BUCKETS = 4096
"""Hash buckets of a source: the first three hex digits of the shuffle order."""

RUN = 1 << 14
"""Slots that are ranked together."""

CELLS = 1 << 10
"""Cells of the unit interval by which points meet the shares of the sources."""

POINTS = 1 << 31
GOLDEN = 1_327_217_885
"""POINTS divided by the golden ratio, odd: the points visit every value once."""


def sized(docs: DataFrame, extra: tuple = ()) -> DataFrame:
    """(doc_id, source, size, _order, *extra): size in words, and the place in the shuffled order of the source."""
    words = F.expr(r"coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0)").cast("long")
    seed = F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    return docs.select("doc_id", "source", words.alias("size"), F.md5(seed.cast("binary")).alias("_order"), *extra)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, total_pct: int = TOTAL_PCT, epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``_s`` (number in order), weight, source_size, target.

    "Cut at the bound, share the excess by weight until none is above" has a closed form: with the sources sorted by
    bound / weight, the first k stay at their bound and the others share the rest at one level; k is the least number
    for which the next source fits under its bound.
    """
    base = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("_s", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1)
            .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                               (F.col("_s") % len(weights) + 1).cast("int")))
            .withColumn("_bound", F.col("source_size").cast("double") * epochs))
    whole, rise = W.partitionBy(), W.orderBy(F.col("_bound") / F.col("weight"), "_s")
    before = rise.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0.0)
    rest = F.sum("source_size").over(whole) * (total_pct / 100) - F.coalesce(F.sum("_bound").over(before), zero)
    level = rest / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero))
    ranked = (base.withColumn("_k", F.row_number().over(rise)).withColumn("_level", level)
              .withColumn("_fits", F.col("_level") * F.col("weight") <= F.col("_bound")))
    first = F.min(F.when(F.col("_fits"), F.struct("_k", "_level"))).over(whole)
    target = (F.when(F.col("_first").isNotNull() & (F.col("_k") >= F.col("_first._k")), F.col("_first._level") * F.col("weight"))
              .otherwise(F.col("_bound")))
    return ranked.withColumn("_first", first).select("source", "_s", "weight", "source_size", target.alias("target"))


def placed(sizes: DataFrame, sources: DataFrame, extra: tuple = ()) -> DataFrame:
    """Documents with their interval [_start, _start + size) in the shuffled row of their source."""
    rows = sizes.withColumn("_bucket", F.substring("_order", 1, 3))
    buckets = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (buckets.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
               .drop("_sum").withColumnRenamed("source", "_source").withColumnRenamed("_bucket", "_b"))
    inside = W.partitionBy("source", "_bucket").orderBy("_order", "size", *extra).rowsBetween(W.unboundedPreceding, -1)
    ranked = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (ranked.join(offsets, ranked.source.eqNullSafe(offsets._source) & (ranked._bucket == offsets._b))
            .withColumn("_start", F.col("_offset") + F.col("_inside"))
            .join(sources.withColumnRenamed("source", "_key"), F.col("source").eqNullSafe(F.col("_key")))
            .select("doc_id", "source", "_s", "size", "_start", "source_size", "target", *extra))


def slots(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, _s, _block, _epoch, _from, _upto): the schedule; words [_from, _upto) of the source's row are taken."""
    spark = sources.sparkSession
    need = (sources.withColumn("_goal", F.floor(F.col("target") + 0.5).cast("long"))
            .withColumn("_blocks", F.ceil(F.col("source_size") / block))
            .withColumn("_epochs", F.expr("_goal div greatest(source_size, 1)"))
            .withColumn("_slots", F.expr(f"_epochs * _blocks + ceil((_goal - _epochs * source_size) / {block})"))
            .filter("_goal > 0"))
    total = need.agg(F.sum("_slots"), F.sum("target")).first()
    n, mass = total[0] or 0, total[1] or 1.0
    order = W.orderBy("_s")
    shares = (need.withColumn("_hi", F.floor(F.sum("target").over(order) / mass * POINTS).cast("long"))
              .withColumn("_lo", F.lag("_hi", 1, 0).over(order)).select("_s", "_lo", "_hi"))
    width = POINTS // CELLS
    cells = shares.filter("_hi > _lo").select("*", F.explode(F.sequence(
        F.floor(F.col("_lo") / width), F.floor((F.col("_hi") - 1) / width))).alias("_cell"))
    points = (spark.range(n).withColumn("_p", (F.col("id") % POINTS * GOLDEN) % POINTS)
              .withColumn("_cell", F.floor(F.col("_p") / width)))
    hits = (points.join(cells, "_cell").filter("_p >= _lo AND _p < _hi")
            .select(F.col("id").alias("slot"), "_s", F.floor(F.col("id") / RUN).alias("_run")))
    runs = hits.groupBy("_s", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("_s").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    offsets = runs.select("_s", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    ranked = (hits.withColumn("_in", F.row_number().over(W.partitionBy("_s", "_run").orderBy("slot")) - 1)
              .join(offsets, ["_s", "_run"]).select("slot", "_s", (F.col("_offset") + F.col("_in")).alias("_rank")))
    counts = runs.groupBy("_s").agg(F.sum("_n").alias("_have"))
    lacking = (need.join(counts, "_s", "left").filter("coalesce(_have, 0) < _slots")
               .select("_s", F.explode(F.expr("sequence(coalesce(_have, 0), _slots - 1)")).alias("_rank"))
               .select((F.lit(n) + F.col("_rank")).alias("slot"), "_s", "_rank"))
    return (ranked.unionByName(lacking).join(need.select("_s", "source_size", "_goal", "_blocks", "_slots"), "_s")
            .filter("_rank < _slots")
            .selectExpr("slot", "_s", "_rank % _blocks AS _block", "_rank div _blocks AS _epoch",
                        f"(_rank % _blocks) * {block} AS _from",
                        f"least((_rank % _blocks + 1) * {block}, source_size, "
                        "_goal - (_rank div _blocks) * source_size) AS _upto"))


def pieces(docs: DataFrame, block: int = BLOCK_WORDS, extra: tuple = (), **rules) -> tuple[DataFrame, DataFrame]:
    """The placed documents, one row per block that they touch, and the schedule."""
    sizes = sized(docs, extra)
    sources = targets(sizes, **rules)
    cut = placed(sizes, sources, extra).withColumn("_block", F.explode_outer(F.expr(
        f"if(size > 0, sequence(_start div {block}, (_start + size - 1) div {block}), cast(array() AS array<bigint>))")))
    return cut, slots(sources, block)


def mix(docs: DataFrame, block: int = BLOCK_WORDS, **rules) -> DataFrame:
    """The mix: (slot, source, epoch, doc_id, first_word, n_words), one row per document part, to be read by slot."""
    cut, plan = pieces(docs, block, **rules)
    begin, end = F.greatest("_from", "_start"), F.least("_upto", F.col("_start") + F.col("size"))
    return (cut.join(plan, ["_s", "_block"]).select(
        "slot", "source", F.col("_epoch").alias("epoch"), "doc_id",
        (begin - F.col("_start")).alias("first_word"), (end - begin).alias("n_words")).filter("n_words > 0"))


def taken(docs: DataFrame, block: int = BLOCK_WORDS, extra: tuple = (), **rules) -> DataFrame:
    """One row per document: size, size and target of its source, words that the mix takes from it."""
    cut, plan = pieces(docs, block, extra, **rules)
    overlap = F.least("_upto", F.col("_start") + F.col("size")) - F.greatest("_from", "_start")
    words = F.when(F.col("_from").isNotNull(), F.greatest(overlap, F.lit(0)))
    key = ["doc_id", "_s", "_start", "size", "source_size", "target", *extra]
    # rows of size 0 may share a start, and have no block: they never meet the schedule
    empty = cut.filter("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), *extra)
    return (cut.filter("size > 0").join(plan, ["_s", "_block"], "left").groupBy(*key)
            .agg(F.coalesce(F.sum(words), F.lit(0)).alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken", *extra).unionByName(empty))


def mixed_documents(docs: DataFrame, **rules) -> DataFrame:
    """The mix as rows of the documents table: a document stands as often as the mix takes it.

    The one document of a source that is taken in part stands with its first words, joined by blanks. A row is known by
    two hashes of all that it holds, nulls included, not by its id: rows that are equal throughout share their takings.
    """
    columns = ["doc_id", "text", "lang", "source"]
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in columns])
    row = ("_row_a", "_row_b")
    named = docs.select(*columns, *[F.xxhash64(F.lit(seed), nulls, *columns).alias(c) for seed, c in enumerate(row)])
    # a source has one last document in part, so equal rows have one remainder among them
    got = (taken(named, extra=row, **rules).filter("taken > 0").groupBy(*row, "size")
           .agg(F.expr("sum(taken div size)").alias("_whole"), F.expr("sum(taken % size)").alias("_rest")))
    first = W.partitionBy(*row).orderBy(F.lit(0))
    joined = named.withColumn("_r", F.row_number().over(first)).filter("_r = 1").join(got, list(row))
    copies = joined.withColumn("_n", F.explode(F.expr(
        "concat(array_repeat(size, cast(_whole AS int)), if(_rest > 0, array(_rest), cast(array() AS array<bigint>)))")))
    part = F.expr(r"array_join(slice(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), 1, cast(_n AS int)), ' ')")
    text = F.when(F.col("_n") == F.col("size"), F.col("text")).otherwise(part)
    return copies.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def oracle_sql() -> str:
    """Targets and whole epochs by windows, then the schedule's arithmetic: a source takes whole rows of its shuffled
    documents and the first words of the last round."""
    w = ", ".join(f"{float(x)}" for x in WEIGHTS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5('mix:' || coalesce(doc_id::VARCHAR, '-')) AS ord FROM documents),
a AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM d GROUP BY source),
b AS (SELECT *, [{w}][s % {len(WEIGHTS)} + 1]::DOUBLE AS wt, source_size::DOUBLE * {MAX_EPOCHS} AS bound FROM a),
c AS (SELECT *, row_number() OVER o AS k, (sum(source_size) OVER () * {TOTAL_PCT / 100}::DOUBLE
        - coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
        (sum(wt) OVER () - coalesce(sum(wt) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lvl
      FROM b WINDOW o AS (ORDER BY bound / wt, s)),
f AS (SELECT k AS k0, lvl AS l0 FROM c WHERE lvl * wt <= bound ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN k >= k0 THEN l0 * wt ELSE bound END AS target FROM c LEFT JOIN f ON true),
p AS (SELECT d.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS goal, coalesce(sum(size) OVER (PARTITION BY d.source
        ORDER BY ord, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (CASE WHEN size = 0 THEN 0 ELSE goal // source_size * size
  + least(greatest(goal % source_size - start, 0), size) END)::BIGINT AS taken FROM p"""
