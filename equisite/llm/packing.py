"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing: every task packs its own pieces best-fit, largest first, and emits the sequences that
are nearly full; the underfull ones travel on as single items. Their partitions are merged ``FAN_IN`` to one and
packed again, until one partition is left, which emits everything. A task works through its rows in portions of
``PORTION`` items and carries underfull bins to its next portion, so its memory is bounded. Between rounds the sizes of
all underfull bins are counted; of a size that fewer others fit beside than there are bins, the bins beyond that number
are emitted as they are: nothing can join them. So what travels on, and the last partition, is bounded by sizes times small
bins also where most documents are longer than half a sequence.

Every round is written to the shared folder: a lost executor costs one task, and tokenising happens once.

Defined cases: null or empty text is the end mark alone; documents of exactly the limit are whole; equal rows are
packed each for itself; an empty table gives no sequence. Only doc_id and text are read, extra columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from equisite.llm.base import arrow_schema, map_batches
from equisite.plans.session import materialise

MAX_TOKENS = 4096
END_ID = 1
END = END_ID.to_bytes(4, "little")
SLACK = 8
"""A sequence with at most this many free places is emitted before the last round."""

FAN_IN = 16
PORTION = 50_000
CACHE_WORDS = 300_000
TOKENIZER = "word_bpe_49k.json"

MEMBERS = "array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>>"

# in these texts the tokenizer's pre-tokens can be found by a simple pattern; others go to the tokenizer as a whole
PLAIN = re.compile(r"[\n\t\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
PRE_TOKEN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s0-9a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in the tokenizer's vocabulary: itself if it can be printed, else one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printed]
    return {b: b for b in printed} | {b: 256 + i for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class WordIds(dict):
    """Token ids of whole texts as little-endian bytes, remembering the ids of each pre-token.

    A pre-token's ids do not depend on its neighbours, so an unknown one goes to the tokenizer's model alone. The memory
    starts anew after ``CACHE_WORDS`` entries.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.tokens = self.whole.model.tokenize

    def __missing__(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = self[word] = np.array([t.id for t in self.tokens(letters)], "<u4").tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if "<|" in text or not PLAIN.fullmatch(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) > CACHE_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, PRE_TOKEN.findall(text.lower())))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


PIECE = ("doc_id", "piece", "start", "length", "ids_crc32")


def _cut(words: WordIds, text: str | None, limit: int) -> Iterator[tuple]:
    """(piece, start, length, ids_crc32, ids) of a text's pieces, the end mark included."""
    raw = words.encode(text or "") + END
    for piece, at in enumerate(range(0, len(raw), 4 * limit)):
        part = raw[at:at + 4 * limit]
        yield piece, at // 4, len(part) // 4, zlib.crc32(part), part


def pieces(docs: DataFrame, limit: int = MAX_TOKENS, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian, 4 bytes each)."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def make():
        words = WordIds(path or tokenizer_path())

        def step(batch):
            rows = [(doc_id, *p) for doc_id, text in zip(batch["doc_id"], batch["text"]) for p in _cut(words, text, limit)]
            return dict(zip((*PIECE, "ids"), zip(*rows)))
        return step

    return map_batches(docs.select("doc_id", "text"), schema, make)


def best_fit(sizes: list[int], limit: int = MAX_TOKENS) -> list[list[int]]:
    """Bins as lists of item numbers: items by falling size, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r is set when a bin with r free places is there
    for item in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = limit, len(bins)
            bins.append([])
        bins[at].append(item)
        left = room - size
        by_room[left].append(at)
        rooms |= 1 << left
    return bins


Item = tuple[int, list[dict]]
"""Size and members of something to be packed."""


def _piece_items(limit: int, path: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[list[Item]]]:
    """Items from (doc_id, text) rows: every piece for itself."""
    def read(batches):
        words = WordIds(path or tokenizer_path())
        for batch in batches:
            # long texts: a batch is worked off in parts, so that Python objects stay few
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield [(p[2], [dict(zip(PIECE, (doc_id, *p)))])
                       for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()) for p in _cut(words, text, limit)]
    return read


def _open_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Item]]:
    """Items from (size, members) rows: the bins of the round before."""
    for batch in batches:
        yield list(zip(batch.column("size").to_pylist(), batch.column("members").to_pylist()))


def pack_round(items: DataFrame, number: int, slack: int, limit: int = MAX_TOKENS) -> DataFrame:
    """Bins of one round over (size, members) rows: (sequence, done, size, members); ``slack`` = limit emits all."""
    return _packed(items.select("size", "members"), _open_bins, number, slack, limit)


def first_round(docs: DataFrame, slack: int, limit: int = MAX_TOKENS, path: str | None = None) -> DataFrame:
    """``pack_round`` over the pieces of (doc_id, text) rows.

    Tokenising and packing share a worker: two would stand side by side in every task, and pass it each piece.
    """
    return _packed(docs.select("doc_id", "text"), _piece_items(limit, path), 0, slack, limit)


def _packed(rows_of: DataFrame, read: Callable[[Iterator[pa.RecordBatch]], Iterator[list[Item]]], number: int, slack: int, limit: int) -> DataFrame:
    schema = f"sequence bigint, done boolean, size bigint, members {MEMBERS}"
    arrow = arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext
        first = (number << 56) | (TaskContext.get().partitionId() << 34)
        made = 0

        def rows(bins, done):
            nonlocal made
            ids = range(first + made, first + made + len(bins))
            made += len(bins)
            for at in range(0, len(bins), 500):
                part = bins[at:at + 500]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[at:at + 500], pa.int64()), pa.array([done] * len(part)),
                    pa.array([s for s, _ in part], pa.int64()), pa.array([m for _, m in part], arrow.field("members").type)],
                    schema=arrow)

        def packed(held, all_of_it):
            full, open_ = [], []
            for one in best_fit([s for s, _ in held], limit):
                size = sum(held[i][0] for i in one)
                members, at = [m for i in one for m in held[i][1]], 0
                for m in members:
                    m["offset"] = at
                    at += m["length"]
                (full if all_of_it or limit - size <= slack else open_).append((size, members))
            return full, open_

        held: list = []
        for items in read(batches):
            held += items
            if len(held) >= PORTION:
                full, held = packed(held, False)
                yield from rows(full, True)
                if len(held) >= PORTION // 2:  # hardly anything fits together: hand on what there is
                    yield from rows(held, False)
                    held = []
        full, held = packed(held, slack >= limit)
        yield from rows(full, True)
        yield from rows(held, False)

    return rows_of.mapInArrow(run, schema)


def joinable(counts: dict[int, int], limit: int) -> dict[int, int]:
    """Per size the open bins that others can join at most, where that is fewer than there are."""
    out, fitting = {}, 0
    sizes = sorted(counts)
    at = 0
    for size in reversed(sizes):
        while at < len(sizes) and sizes[at] <= limit - size:
            fitting += counts[sizes[at]]
            at += 1
        if size <= limit - size:  # two of them fit beside each other: all may be joined, but for one that is alone
            if fitting == 1:
                out[size] = 0
        elif fitting < counts[size]:
            out[size] = fitting
    return out


def travelling(made: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """The open bins of a round that may still be joined, and those that cannot be (None: there are none)."""
    open_ = made.filter("NOT done")
    few = joinable({r["size"]: r["n"] for r in open_.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}, limit)
    if not few:
        return open_, None
    spark = made.sparkSession
    table = F.broadcast(spark.createDataFrame(list(few.items()), "size bigint, most bigint"))
    place = F.row_number().over(W.partitionBy("size").orderBy("sequence"))
    # the limit stands beside the window: a task ships no more bins of a size than can be joined
    limited = (open_.select("size", "sequence").join(table, "size").withColumn("_r", place).filter(F.col("_r") <= max(few.values()))
               .filter("_r <= most").select("sequence"))
    unlimited = open_.join(table, "size", "left_anti").select("sequence")
    kept = materialise(limited.unionByName(unlimited), "pack-open")
    return open_.join(kept, "sequence", "left_semi"), open_.join(kept, "sequence", "left_anti")


def pack(docs: DataFrame, limit: int = MAX_TOKENS, slack: int = SLACK, fan_in: int = FAN_IN, path: str | None = None) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    parts, number, done, items = max(1, docs.rdd.getNumPartitions()), 0, None, None
    while True:
        last = parts == 1
        free = limit if last else slack
        bins = first_round(docs, free, limit, path) if items is None else pack_round(items, number, free, limit)
        made = materialise(bins, f"pack-{number}")
        out = made.filter("done")
        done = out if done is None else done.unionByName(out)
        if last:
            break
        parts, number = -(-parts // fan_in), number + 1
        key = F.col("members")[0]
        open_, closed = travelling(made, limit)
        done = done if closed is None else done.unionByName(closed.select(*done.columns))
        items = open_.repartition(parts, key["doc_id"], key["piece"]).sortWithinPartitions(
            F.desc("size"), key["doc_id"], key["piece"])
    return done.select("sequence", F.explode("members").alias("_m")).select("_m.*", F.col("sequence").alias("sequence_id"))
