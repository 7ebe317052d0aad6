"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter trigram is the product of its letters' vectors,
each rotated by its place; a text is the sum over its trigrams, a language the sum over its texts' unit vectors. A text
is given to the language with the most similar prototype by cosine.

Letters are lower-cased; runs of other characters are one blank, which has a vector of its own. The alphabet has
``SLOTS`` places: blank, a to z, and the other letters by their code point; nothing about it is learned. Prototypes are
bundled from a sample of about ``TRAIN_ROWS`` labelled rows (reproducible, by hash), in whole numbers, so that the
result does not depend on the order of tasks. Prediction is one narrow pass over all texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0; with nothing to learn from every text
is; one or two letters still have the trigrams with their blanks; equal texts get equal answers. Long texts are read
whole, piece by piece. Only doc_id, text and lang are read, extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equisite.llm.base import hashed_below, held_out, map_batches, sample_share

DIMENSIONS = 1024
SLOTS = 64
TRAIN_ROWS = 20_000
"""Bound (expected) of the labelled rows that prototypes are bundled from."""

SEED = 20_24
GROUP = 64
"""Texts whose vectors are built together."""

TABLE_ROWS = 12_000
"""Trigram vectors kept at a time."""

UNKNOWN = "und"


class Profiles:
    """Vectors of texts. Trigram vectors are made when first met and forgotten when the table is full."""

    def __init__(self, dimensions: int = DIMENSIONS):
        rng = np.random.default_rng(SEED)
        self.letters = rng.choice(np.array([-1, 1], np.int8), (SLOTS, dimensions))
        chars = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(1 << 16))
        slots = np.zeros(1 << 16, np.uint8)
        where = np.flatnonzero([c.isalpha() for c in chars])
        slots[where] = 27 + where % (SLOTS - 27)
        slots[ord("a"):ord("z") + 1] = np.arange(1, 27)
        self.slots, self.dimensions = slots, dimensions
        self.forget()

    def forget(self):
        self.row_of = np.full(SLOTS ** 3, -1, np.int32)
        self.vectors = np.empty((0, self.dimensions), np.float32)

    def trigrams(self, text: str) -> np.ndarray:
        """Numbers of the trigrams of ' text '; none if the text has no letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        slots = self.slots[np.minimum(codes, 0xD800)]
        if len(codes) and codes.max() > 0xFFFF:
            far = np.flatnonzero(codes > 0xFFFF)
            slots[far] = [SLOTS - 1 if chr(c).isalpha() else 0 for c in codes[far].tolist()]
            near = np.flatnonzero((codes > 0xD800) & (codes <= 0xFFFF))
            slots[near] = self.slots[codes[near]]
        elif len(codes) and codes.max() > 0xD800:
            slots = self.slots[codes]
        slots = np.concatenate([[0], slots, [0]])
        blank = slots == 0
        slots = slots[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.int32)
        if len(slots) < 3:
            return np.empty(0, np.int32)
        return (slots[:-2] * SLOTS + slots[1:-1]) * SLOTS + slots[2:]

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        """Table rows of trigrams, new ones added."""
        rows = self.row_of[numbers]
        if (rows < 0).any():
            new = np.unique(numbers[rows < 0])
            a, b, c = new // SLOTS ** 2, new // SLOTS % SLOTS, new % SLOTS
            made = np.roll(self.letters, 2, 1)[a] * np.roll(self.letters, 1, 1)[b] * self.letters[c]
            self.row_of[new] = np.arange(len(self.vectors), len(self.vectors) + len(new))
            self.vectors = np.concatenate([self.vectors, made.astype(np.float32)])
            rows = self.row_of[numbers]
        return rows

    def unit_vectors(self, texts: list[str | None]) -> np.ndarray:
        """One row per text, of length 1; all zero for a text without letters."""
        if len(self.vectors) > TABLE_ROWS:
            self.forget()
        grams = [self.trigrams(t or "") for t in texts]
        sums = np.zeros((len(texts), self.dimensions))
        every = np.concatenate(grams) if grams else np.empty(0, np.int32)
        if not len(every):
            return sums
        rows = self.rows(every)
        used = np.flatnonzero(np.bincount(rows))
        place = np.empty(len(self.vectors), np.int64)
        place[used] = np.arange(len(used))
        text = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
        counts = np.bincount(text * len(used) + place[rows], minlength=len(texts) * len(used)).reshape(len(texts), -1)
        sums[:] = counts.astype(np.float32) @ self.vectors[used]
        length = np.sqrt((sums ** 2).sum(1, keepdims=True))
        return np.divide(sums, length, out=sums, where=length > 0)


def prototypes(docs: DataFrame, rows: int = TRAIN_ROWS, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit prototype of every language, from about ``rows`` documents that may be learned from."""
    known = docs.filter(F.col("lang").isNotNull() & ~held_out())
    sample = known.filter(hashed_below(sample_share(known.count(), rows), "doc_id")).select("text", "lang")

    def make():
        profiles = Profiles(dimensions)

        def step(batch):
            langs = sorted(set(batch["lang"]))
            sums = np.zeros((len(langs), dimensions))
            for at in range(0, len(batch["lang"]), GROUP):
                units = profiles.unit_vectors(batch["text"][at:at + GROUP])
                np.add.at(sums, [langs.index(x) for x in batch["lang"][at:at + GROUP]], np.rint(units * 1e6))
            return {"lang": langs, "vector": [s.astype(np.int64).tolist() for s in sums]}
        return step

    parts = map_batches(sample, "lang string, vector array<bigint>", make)
    sums = (parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect())
    out = {r.lang: np.array([p.x for p in r.v], float) for r in sums}
    return {k: v / max(np.sqrt((v ** 2).sum()), 1.0) for k, v in sorted(out.items())}


def predicted(docs: DataFrame, learned: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine, at least 0)."""
    langs = list(learned)
    matrix = np.array([learned[x] for x in langs]).T if langs else np.zeros((DIMENSIONS, 0))

    def make():
        profiles = Profiles(len(matrix))

        def step(batch):
            preds, scores = [], []
            for at in range(0, len(batch["text"]), GROUP):
                units = profiles.unit_vectors(batch["text"][at:at + GROUP])
                near = units @ matrix
                some = units.any(1) if langs else np.zeros(len(units), bool)
                best = near.argmax(1) if langs else np.zeros(len(units), int)
                for i, ok in enumerate(some.tolist()):
                    preds.append(langs[best[i]] if ok else UNKNOWN)
                    scores.append(float(min(1.0, max(0.0, near[i, best[i]]))) if ok else 0.0)
            return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": preds, "score": scores}
        return step

    return map_batches(docs.select("doc_id", "text", held_out().alias("held_out")),
                       "doc_id bigint, held_out boolean, lang_pred string, score double", make)


def identify(docs: DataFrame) -> DataFrame:
    return predicted(docs.select("doc_id", "text"), prototypes(docs))
