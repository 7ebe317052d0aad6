"""Quality classifier: naive Bayes features in a linear support vector machine.

Features are indicators of n-grams, hashed to ``1 << BITS`` columns: words (one and two) and word shapes (one to
three). A shape is the word with its letters, digits and repeats folded (``Aaa,`` for ``Anhave,``) and a mark if the word
repeats the one before. Each indicator is scaled by its class log-count ratio and each text to length 1; weights come
from hinge loss by dual coordinate descent, drawn towards their mean size as in the published method. A logistic
curve fitted to the margins gives the score.

The model is fitted in one task on a sample of about ``TRAIN_ROWS`` labelled rows (reproducible, by hash; ids that are
held out never take part) and is a vector of fixed size; scoring is one narrow pass over all whole texts.

Defined cases: a null or empty text has no feature and gets the score of the intercept; a label that is null is not
learned from; labels of a repeated doc_id count once each; with one class or none to learn from, every score is the
share of label 1 (0.5 with no label); equal texts get equal scores. Only the named columns are read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equisite.llm.base import WORD, hashed_below, held_out, map_batches, sample_share

BITS = 20
TRAIN_ROWS = 6_000
"""Bound (expected) of the labelled rows that the model is fitted on."""

EPOCHS = 20
COST = 1.0
SMOOTHING = 1.0
PULL = 0.25
"""Weight of the learned part against the mean size of all weights."""

MIN_ROWS = 2
"""Rows of the sample that a feature must be in."""

THRESHOLD = 0.3
CACHE_WORDS = 200_000
SEED = 7
SHAPES = 1 << 16


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


FOLDED = str.maketrans({chr(c): "a" if chr(c).islower() else "A" if chr(c).isupper() else "0" if chr(c).isdigit() else chr(c)
                        for c in range(256)})


class Features:
    """Sorted distinct feature numbers of a text.

    A word is held as one number: 48 bits of its hash and the 16 bits of its shape.
    """

    def __init__(self):
        import xxhash
        self.digest, self.known, self.runs = xxhash.xxh3_64_intdigest, {}, re.compile(r"(.)\1+")

    def word(self, w: str) -> int:
        shape = self.runs.sub(r"\1\1", w[:40].translate(FOLDED))[:8]
        return (self.digest(w.lower()) & ~(SHAPES - 1)) | self.digest(shape) % SHAPES

    def of(self, text: str | None) -> np.ndarray:
        words = WORD.findall(text or "")
        if not words:
            return np.empty(0, np.int64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.word(w)
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        shapes = ids & np.uint64(SHAPES - 1)
        shapes[1:] |= (ids[1:] == ids[:-1]).astype(np.uint64) * np.uint64(SHAPES)
        grams, code = [mixed(ids, 1), mixed(ids[:-1] * np.uint64(3) + ids[1:], 2), mixed(shapes, 3)], shapes
        for n in (1, 2):
            code = code[:-1] * np.uint64(2 * SHAPES) + shapes[n:]
            grams.append(mixed(code, 3 + n))
        return np.unique((np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int32)).astype(np.int64)


def fit(texts: list, labels: list) -> dict:
    """Weights (log-count ratios worked in), intercept and curve from texts with labels 0 and 1."""
    y = np.where(np.array(labels) == 1, 1.0, -1.0)
    features = Features()
    rows = [features.of(t) for t in texts]
    share = float((y > 0).mean()) if len(y) else 0.5
    flat = {"weights": np.zeros(1 << BITS, np.float32), "bias": 0.0, "slope": 0.0, "shift": float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))}
    if len(y) == 0 or abs(y.sum()) == len(y):
        return flat
    counts = {s: np.bincount(np.concatenate([r for r, v in zip(rows, y) if v == s] or [[]]).astype(int), minlength=1 << BITS)
              for s in (1.0, -1.0)}
    seen = counts[1.0] + counts[-1.0]
    p, q = counts[1.0] + SMOOTHING, counts[-1.0] + SMOOTHING
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[seen < MIN_ROWS] = 0.0
    rows = [r[seen[r] >= MIN_ROWS] for r in rows]
    values = [ratio[r] for r in rows]
    norms = [max(np.sqrt((v ** 2).sum()), 1e-9) for v in values]
    values = [v / n for v, n in zip(values, norms)]
    balance = {1.0: 0.5 / share, -1.0: 0.5 / (1 - share)}
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            r, v, s = rows[i], values[i], y[i]
            slope = s * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - slope / (2.0 if len(r) else 1.0), 0.0), COST * balance[s])
            if new != alpha[i]:
                step = (new - alpha[i]) * s
                w[r] += step * v
                bias += step
                alpha[i] = new
    used = seen >= MIN_ROWS
    w = np.where(used, (1 - PULL) * np.abs(w[used]).mean() + PULL * w, 0.0) * ratio if used.any() else w
    margins = np.array([w[r].sum() / n if len(r) else 0.0 for r, n in zip(rows, norms)])
    # the length of a text stays part of the margin: sqrt of its squared ratios, as in training
    slope, shift = logistic_curve(margins, y)
    return {"weights": w.astype(np.float32), "ratios": (ratio ** 2).astype(np.float32), "bias": bias, "slope": slope, "shift": shift}


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, with the usual softened targets, by Newton's method."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(margins.std(), 1e-9)
    x = np.stack([margins / scale, np.ones(len(y))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        z = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (z * (1 - z) + 1e-6)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - z))
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> dict:
    """The model, fitted in one task on a bounded sample of labelled rows."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = known.filter(hashed_below(sample_share(known.count(), rows), "doc_id")).select("doc_id", label)
    # ids are bounded by ``rows``, so the texts need no shuffle; one partition takes the bounded sample
    pairs = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", label)
             .repartition(1).sortWithinPartitions("doc_id", label, "text"))

    def run(batches):
        import pyarrow as pa
        texts, marks = [], []
        for b in batches:
            texts += b.column("text").to_pylist()
            marks += b.column(label).to_pylist()
        m = fit(texts, marks)
        yield pa.RecordBatch.from_pydict({
            "weights": pa.array([m["weights"].tobytes()], pa.binary()),
            "ratios": pa.array([m.get("ratios", m["weights"]).tobytes()], pa.binary()),
            "curve": pa.array([[m["bias"], m["slope"], m["shift"]]], pa.list_(pa.float64()))})

    row = pairs.select("text", label).mapInArrow(run, "weights binary, ratios binary, curve array<double>").first()
    if row is None:
        return fit([], [])
    return {"weights": np.frombuffer(row.weights, np.float32), "ratios": np.frombuffer(row.ratios, np.float32),
            "slope": row.curve[1], "shift": row.curve[2]}


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast((model["weights"], model.get("ratios", model["weights"])))
    slope, shift = model["slope"], model["shift"]

    def make():
        features = Features()
        weights, squares = shared.value

        def step(batch):
            scores = []
            for text in batch["text"]:
                r = features.of(text)
                norm = np.sqrt(float(squares[r].sum(dtype=np.float64)))
                margin = float(weights[r].sum(dtype=np.float64)) / norm if norm > 0 else 0.0
                scores.append(float(1 / (1 + np.exp(-np.clip(slope * margin + shift, -40, 40)))))
            return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores,
                    "predicted": [int(s >= THRESHOLD) for s in scores]}
        return step

    return map_batches(docs.select("doc_id", "text", held_out().alias("held_out")),
                       "doc_id bigint, held_out boolean, score double, predicted int", make)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text"), trained(docs, labels))
