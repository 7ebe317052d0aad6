"""Exact line deduplication over all documents, with DataFrame functions only.

Keys of lines are hashed to 128 bits; the hashes are written once, so texts are split once. The hashes are
range-partitioned by (hash, document range) and sorted by hash, document (largest first) and position; a window reads this
order as a stream and marks the first line of every document, so that runs give their number of documents and their first
holder. A document range holds ``RANGE`` ids at most, so a line that a third of all documents share is spread over many
partitions; its few runs meet afterwards in a combining aggregate, and lines meet their verdict by (hash, range) too. Only
hashes in ``min_docs`` documents go on. Per text the lines to drop come back as a bitmap of 64-bit words: words without a
dropped line are not stored, and text is never shuffled with the lines.

Defined cases: null or empty text is one empty line, kept. Rows of one doc_id count as one document; every row loses its
own repeated lines only (a bitmap belongs to doc_id and text, equal rows get equal results). A null doc_id is a document
with the least of all ids. Very long texts and lines are read whole. Empty table: empty result. Only doc_id and text are
read, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from equisite.plans.session import materialise

MIN_CHARS = 20
MIN_DOCS = 3
RANGE = 4096
"""Document ids per range: an upper bound for the rows of one hash in one sort run."""

NO_ID = -(1 << 62)
"""Stands for a null doc_id."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\u000b\f\r"


def line_key(line: Column) -> Column:
    """The stripped line with A-Z in lower case; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed(docs: DataFrame) -> DataFrame:
    """Adds what a bitmap belongs to: ``_d`` (doc_id, null as the least) and ``_t`` (hash of the text)."""
    return docs.withColumn("_d", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("_t", F.xxhash64("text"))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_h1, _h2, _range, _d, _t, _pos): one row per line whose key is long enough."""
    lines = keyed(docs.select("doc_id", "text")).select("_d", "_t", F.posexplode(lines_of(F.col("text"))).alias("_pos", "_line"))
    keys = lines.select("_d", "_t", "_pos", line_key(F.col("_line")).alias("_key"))
    return (keys.filter(F.char_length("_key") >= min_chars)
            .select(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"),
                    F.floor(F.col("_d") / RANGE).alias("_range"), "_d", "_t", "_pos"))


def runs_of(hashes: DataFrame) -> DataFrame:
    """(_h1, _h2, _range, _n, _holder): documents and first (largest) document of every run of the sorted hashes."""
    run = ["_h1", "_h2", "_range"]
    inside = [F.desc("_d"), F.asc("_t"), F.asc("_pos")]
    before = F.lag("_d").over(W.partitionBy(*run).orderBy(*inside))
    ranged = hashes.repartitionByRange(*run).sortWithinPartitions(*run, *inside)
    firsts = ranged.withColumn("_new", before.isNull() | (before != F.col("_d"))).filter("_new")
    return firsts.groupBy(*run).agg(F.count(F.lit(1)).alias("_n"), F.max("_d").alias("_holder"))


def repeated_keys(runs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_h1, _h2, _winner, _n_docs) for hashes found in at least ``min_docs`` documents."""
    return (runs.groupBy("_h1", "_h2").agg(F.sum("_n").alias("_n_docs"), F.max("_holder").alias("_winner"))
            .filter(F.col("_n_docs") >= min_docs))


def drop_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, _t, _drops), a null doc_id as ``NO_ID``: map from word number (position div 64) to the bits of its dropped lines."""
    hashes = materialise(hashed_lines(docs, min_chars), "line-hashes")
    runs = runs_of(hashes)
    cells = runs.select("_h1", "_h2", "_range").join(repeated_keys(runs, min_docs), ["_h1", "_h2"])
    losers = hashes.join(cells, ["_h1", "_h2", "_range"]).filter(F.col("_d") != F.col("_winner"))
    # a text that stands in several rows of its document is one bitmap
    bit = F.expr("shiftleft(1L, cast(_pos % 64 AS int))")
    words = (losers.select("_d", "_t", F.floor(F.col("_pos") / 64).cast("int").alias("_word"), bit.alias("_bit"))
             .groupBy("_d", "_t", "_word").agg(F.bit_or("_bit").alias("_bits")))
    return words.groupBy(F.col("_d").alias("doc_id"), "_t").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_drops"))


def with_kept_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with ``_lines`` (all lines) and ``_kept`` (text of the kept lines)."""
    marks = drop_bitmaps(docs, min_chars, min_docs).withColumnRenamed("doc_id", "_d").hint("shuffle_hash")
    joined = keyed(docs).join(marks, ["_d", "_t"], "left").withColumn("_lines", lines_of(F.col("text")))
    kept = F.expr("filter(_lines, (x, i) -> coalesce((shiftrightunsigned(_drops[cast(i div 64 AS int)], "
                  "cast(i % 64 AS int)) & 1L) = 0L, true))")
    return joined.withColumn("_kept_lines", F.when(F.col("_drops").isNull(), F.col("_lines")).otherwise(kept))


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: number of lines, dropped lines and the hash of the text that stays."""
    return with_kept_lines(docs.select("doc_id", "text"), min_chars, min_docs).select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept_lines")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("_kept_lines", "\n").cast("binary"), 256).alias("kept_sha256"))


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents table with the repeated lines taken out of its texts."""
    kept = with_kept_lines(docs.select("doc_id", "text", "lang", "source"))
    text = F.array_join("_kept_lines", "\n")
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def oracle_sql() -> str:
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {NO_ID}) AS d, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
l AS (SELECT r, doc_id, d, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM t),
k AS (SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS key FROM l),
b AS (SELECT key, max(d) AS winner FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key
      HAVING count(DISTINCT d) >= {MIN_DOCS}),
m AS (SELECT k.r, k.doc_id, k.line, k.pos, b.winner IS NOT NULL AND b.winner <> k.d AS gone FROM k LEFT JOIN b USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""
