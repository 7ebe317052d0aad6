"""Bottom-k sketches of word shingles, with DataFrame functions only.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a text's shingles of five words. Sketches
of parts merge into the sketch of the whole, and estimate resemblance, containment and the number of distinct
shingles; below ``k`` distinct shingles all three are exact.

Defined cases: a text without words (null, empty, blanks) has the empty sketch; with one to four words its only
shingle is the whole; two empty sketches have resemblance and containment 1. Long texts are read whole. Equal texts
have equal sketches. In ``with_next`` rows follow each other by doc_id (nulls first), rows of one doc_id by text; a
single row follows itself; an empty table stays empty. Internal names start with ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from equisite.llm.base import hashed_below, sample_share

K = 128
WORDS = 5
ROWS, RANGES = 4096, 512
"""Documents of a range when rows are brought together with their successors, until there are so many ranges."""

SAMPLE = 8192
"""Expected number of distinct (id, first characters of the text) that the bounds of the ranges are taken from."""

PREFIX = 32


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of column ``text``; the steps are separate projections, so each is computed once."""
    words = F.expr(rf"transform(regexp_extract_all(`{text}`, '[^\\x20\\x09-\\x0D]+', 0), w -> xxhash64(w))")
    # beyond the end of the array nothing is read: the sequence stops at the last whole shingle
    parts = ", ".join(f"_w[i + {j}]" for j in range(WORDS))
    shingles = F.expr(f"CASE WHEN _w IS NULL OR size(_w) = 0 THEN cast(array() AS array<bigint>) "
                      f"WHEN size(_w) < {WORDS} THEN array(xxhash64(_w)) "
                      f"ELSE transform(sequence(0, size(_w) - {WORDS}), i -> xxhash64({parts})) END")
    return (df.withColumn("_w", words).withColumn("_sh", shingles)
            .withColumn(name, F.slice(F.sort_array(F.array_distinct("_sh")), 1, k)).drop("_w", "_sh"))


def merged(sketches: Column, k: int = K) -> Column:
    """The sketch of the union, from an array of sketches."""
    return F.slice(F.sort_array(F.array_distinct(F.flatten(sketches))), 1, k)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    n = F.size(sketch)
    kth = (F.element_at(sketch, -1).cast("double") + 2.0 ** 63) / 2.0 ** 64
    return F.when(n < k, n.cast("double")).otherwise((k - 1) / kth)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's k smallest hashes that both have."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    return F.when(a == b, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.greatest(F.size(union), F.lit(1)).cast("double"))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    union = distinct_shingles(merged(F.array(a, b), k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def merge_groups(sketches: DataFrame, keys: list[str], name: str, k: int = K) -> DataFrame:
    """Sketches of groups of any size: hash by hash, the smallest k per salted part, then per group."""
    rows = sketches.select(*keys, F.explode(name).alias("_h")).distinct()
    part = W.partitionBy(*keys, "_salt").orderBy("_h")
    whole = W.partitionBy(*keys).orderBy("_h")
    least = (rows.withColumn("_salt", F.pmod(F.xxhash64("_h"), F.lit(64))).withColumn("_r", F.row_number().over(part))
             .filter(F.col("_r") <= k).withColumn("_r", F.row_number().over(whole)).filter(F.col("_r") <= k))
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(name))


def range_bounds(keys: DataFrame) -> list:
    """Bounds (id, prefix) that cut the documents into ranges of about equal size: evenly from a hashed sample."""
    total = keys.count()
    count = min(RANGES, total // ROWS)
    if not count:
        return []
    some = keys.filter(hashed_below(sample_share(total, SAMPLE), "_id", "_prefix")).distinct().collect()
    rows = sorted((tuple(r) for r in some), key=lambda b: (b[0], b[1].encode()))
    return sorted({rows[len(rows) * n // (count + 1)] for n in range(1, count + 1)}, key=rows.index) if rows else []


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text, _fp and the next document's _next_text, _next_fp.

    Documents are dealt by ranges of (doc_id, text), whatever ids there are; ids that are null or stand on very many rows
    are cut by their texts. The first row of every range goes to the range before it, too: a row for a range.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-1 << 62)).alias("_id"))
    keyed = rows.withColumn("_prefix", F.substring("text", 1, PREFIX))
    bounds = range_bounds(keyed.select("_id", "_prefix"))
    key = F.struct("_id", "_prefix")
    below = [F.struct(F.lit(i).cast("long").alias("_id"), F.lit(p).alias("_prefix")) for i, p in bounds]
    number = F.size(F.filter(F.array(*below), lambda b: b <= key)) if below else F.lit(0)
    own = keyed.withColumn("_range", number).drop("_prefix").withColumn("_ghost", F.lit(0))
    firsts = own.groupBy("_range").agg(F.min(F.struct("_id", "text")).alias("_f"))
    # at most one row for a range here
    before = F.coalesce(F.lag("_range").over(W.orderBy("_range")), F.max("_range").over(W.partitionBy()))
    ghosts = firsts.withColumn("_range", before).select(F.lit(None).cast("long").alias("doc_id"), "_f.text", "_f._id", "_range", F.lit(1).alias("_ghost"))
    order = W.partitionBy("_range").orderBy("_ghost", "_id", "text")
    rows = own.unionByName(ghosts).withColumn("_next_text", F.lead("text").over(order)).filter("_ghost = 0")
    return with_sketch(with_sketch(rows, "text", "_fp", k), "_next_text", "_next_fp", k)


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every document and of its edited text (second half from the next document)."""
    rows = (with_next(docs, k).withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("_half", F.floor(F.col("n_chars") / 2).cast("int"))
            .withColumn("_edit", F.expr("concat(left(text, cast(n_chars AS int) - _half), left(_next_text, _half))"))
            .select("doc_id", "n_chars", "_fp", "_next_fp", "_edit"))
    return with_sketch(rows, "_edit", "_efp", k).select(
        "doc_id", "n_chars", F.sha2(F.col("_edit").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_fp")).alias("fingerprint"), as_text(F.col("_efp")).alias("edited_fingerprint"),
        resemblance(F.col("_fp"), F.col("_efp"), k).alias("near_edited"),
        resemblance(F.col("_fp"), F.col("_next_fp"), k).alias("near_next"))
