"""Personal data in texts: fixed patterns, and a character model that adds what they miss.

The model is a bidirectional LSTM over characters with CRF transitions between begin/inside tags, written in numpy. It
is trained in one task on windows of a bounded sample of documents: labelled spans of the fixed patterns where the texts have
them, written ones of all kinds and forms in other places of the texts (phone numbers without a plus, cards in groups), and
numbers of other kinds as counter-examples, in balanced shares. Every span holds a digit or an @, so windows are laid over
all stretches that have one; they overlap by half. The tags of a character come from the window in which it stands most
centrally; a span must be valid for its kind, free of spans of the fixed patterns, and as confident as held-out windows
ask for.

Prediction is one narrow pass over whole texts. Defined cases: a null or empty text has no spans; without a digit or
@ in the sample only the fixed patterns work; long texts give more windows, worked off in groups; equal texts get
equal spans; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equisite.llm.base import hashed_below, map_batches, sample_share

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)
"""Outside, then begin and inside of every kind."""

TRAIN_ROWS = 3_000
"""Bound (expected) of the documents with a digit or @ that training windows are taken from."""

TRAIN_WINDOWS = 6_000
"""Windows that the sample's texts are worked up into, in equal parts of written and foreign numbers."""

HIDDEN, WIDTH, STRIDE, MARGIN = 24, 64, 32, 20
STEPS, BATCH, RATE, SEED = 400, 64, 0.015, 11
HELD_SHARE, PRECISION = 8, 0.97
"""One window in so many is not learned from: on these the confidence of a span is chosen, the least of this precision."""

GROUP = 512

# fixed values: the patterns of the contract
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
# the look behind changes no match, as a number is matched from its first digit; it spares a try at every digit
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TRIGGER = re.compile(r"[0-9@]")
STRETCH = re.compile(rf"[0-9@](?:.{{0,{MARGIN}}}[0-9@])*", re.S)


def digits(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def luhn(s: str) -> bool:
    d = digits(s)[::-1]
    return (sum(d[0::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def valid_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def emails(text: str):
    """Matches of local part, @, domain: for every @ the longest run of local characters before it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    if not TRIGGER.search(text):
        return []
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if valid_ip(m[0])]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(m[0])]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def plausible(kind: int, s: str) -> bool:
    """What a span of the model must fulfil, too."""
    n = len(digits(s))
    if kind == 0:
        return s.count("@") == 1 and "." in s and " " not in s and 0 < s.index("@") < len(s) - 3
    if kind == 1:
        parts = re.split(r"[^0-9]+", s.strip())
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 12 <= n <= 19 and luhn(s) and not re.search(r"[A-Za-z]", s)
    return 9 <= n <= 15 and bool(re.search(r"[ ().-]", s)) and not re.search(r"[A-Za-z]", s)


# ---- the model ----

def codes(window: str) -> np.ndarray:
    """Character numbers: printable ASCII each, other letters and the rest as one each, 0 beyond the text."""
    raw = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = np.where((raw >= 32) & (raw < 127), raw - 31, np.where(raw > 127, 96, 97))
    return np.pad(out, (0, WIDTH - len(out)))


SYMBOLS = 98


def new_model(rng) -> dict[str, np.ndarray]:
    h = HIDDEN
    w = {"x": rng.normal(0, 0.3, (2, SYMBOLS, 4 * h)), "h": rng.normal(0, 0.2, (2, h, 4 * h)),
         "o": rng.normal(0, 0.2, (2 * h, TAGS)), "b": np.zeros(TAGS), "a": np.zeros((TAGS, TAGS))}
    w["x"][:, :, h:2 * h] += 0.5  # forget gates start open
    return w


def barred() -> np.ndarray:
    """Transitions that no tag sequence has: into the inside of a kind from anything but that kind."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[[t for t in range(TAGS) if t not in (inside, inside - 1)], inside] = -1e4
    return out


def sigmoid(z):
    return 1 / (1 + np.exp(-z))


def lstm(w, ids, keep=False):
    """Hidden states (batch, time, 2 x hidden) of both directions; with ``keep`` also what the gradient needs."""
    n, t = ids.shape
    h = HIDDEN
    both = np.stack([ids, ids[:, ::-1]])
    gates = np.stack([w["x"][0][both[0]], w["x"][1][both[1]]])
    state = np.zeros((2, n, h), gates.dtype)
    cell = state
    outs, memo = np.empty((2, n, t, h), gates.dtype), []
    for s in range(t):
        z = gates[:, :, s] + state @ w["h"]
        ifo, g = sigmoid(z[..., :3 * h]), np.tanh(z[..., 3 * h:])
        before, last = cell, state
        cell = ifo[..., h:2 * h] * cell + ifo[..., :h] * g
        th = np.tanh(cell)
        state = ifo[..., 2 * h:] * th
        outs[:, :, s] = state
        if keep:
            memo.append((ifo, g, before, last, th))
    return np.concatenate([outs[0], outs[1][:, ::-1]], -1), (both, memo)


def log_sum(x, axis):
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def forward_backward(e, a):
    """Log normaliser, tag marginals and expected transition counts of the CRF."""
    n, t, k = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    start = np.where([i > 0 and i % 2 == 0 for i in range(k)], -1e4, 0.0)  # no window begins inside a span
    alpha[:, 0] = e[:, 0] + start
    for s in range(1, t):
        alpha[:, s] = log_sum(alpha[:, s - 1][:, :, None] + a, 1) + e[:, s]
    for s in range(t - 2, -1, -1):
        beta[:, s] = log_sum(a + (e[:, s + 1] + beta[:, s + 1])[:, None, :], 2)
    z = log_sum(alpha[:, -1], 1)
    marginals = np.exp(alpha + beta - z[:, None, None])
    pairs = np.exp(alpha[:, :-1, :, None] + a + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]).sum((0, 1))
    return z, marginals, pairs


def gradients(w, ids, tags):
    """Gradient of the mean negative log likelihood."""
    n, t = ids.shape
    h = HIDDEN
    hidden, (both, memo) = lstm(w, ids, True)
    a = w["a"] + barred()
    _, marginals, pairs = forward_backward(hidden @ w["o"] + w["b"], a)
    seen = np.zeros((TAGS, TAGS))
    np.add.at(seen, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    de = (marginals - np.eye(TAGS)[tags]) / n
    g = {"a": (pairs - seen) / n, "b": de.sum((0, 1)), "o": np.tensordot(hidden, de, ((0, 1), (0, 1))),
         "x": np.zeros_like(w["x"]), "h": np.zeros_like(w["h"])}
    dh = de @ w["o"].T
    dh = np.stack([dh[..., :h], dh[:, ::-1, h:]])
    dstate, dcell = np.zeros((2, n, h)), np.zeros((2, n, h))
    dz_all = np.empty((2, n, t, 4 * h))
    for s in range(t - 1, -1, -1):
        ifo, c, before, last, th = memo[s]
        i, f, o = ifo[..., :h], ifo[..., h:2 * h], ifo[..., 2 * h:]
        d = dh[:, :, s] + dstate
        dc = dcell + d * o * (1 - th * th)
        dz = np.concatenate([dc * c * i * (1 - i), dc * before * f * (1 - f), d * th * o * (1 - o), dc * i * (1 - c * c)], -1)
        dz_all[:, :, s] = dz
        g["h"] += np.swapaxes(last, 1, 2) @ dz
        dstate = dz @ np.swapaxes(w["h"], 1, 2)
        dcell = dc * f
    for d in range(2):
        np.add.at(g["x"][d], both[d].ravel(), dz_all[d].reshape(-1, 4 * h))
    return g


def fit(windows: list[str], tags: list[np.ndarray], steps: int = STEPS) -> dict[str, np.ndarray]:
    """Trains with Adam on random batches; the same windows give the same model."""
    rng = np.random.default_rng(SEED)
    w = new_model(rng)
    ids, marks = np.array([codes(x) for x in windows]), np.array(tags)
    m, v = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}
    for step in range(1, steps + 1):
        at = rng.integers(0, len(ids), BATCH)
        g = gradients(w, ids[at], marks[at])
        norm = np.sqrt(sum((x ** 2).sum() for x in g.values()))
        rate = RATE * min(1.0, 4 * (1 - step / (steps + 1)))
        for k in w:
            d = g[k] * min(1.0, 5.0 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in w.items()}


def best_tags(w, windows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Most probable tag sequence of every window and the marginal of each of its tags."""
    hidden, _ = lstm(w, np.array([codes(x) for x in windows]))
    e = (hidden @ w["o"] + w["b"]).astype(np.float64)
    a = w["a"].astype(np.float64) + barred()
    _, marginals, _ = forward_backward(e, a)
    n, t, k = e.shape
    score = e[:, 0] + np.where([i > 0 and i % 2 == 0 for i in range(k)], -1e4, 0.0)
    back = np.empty((n, t, k), np.int8)
    for s in range(1, t):
        ways = score[:, :, None] + a
        back[:, s] = ways.argmax(1)
        score = ways.max(1) + e[:, s]
    path = np.empty((n, t), np.int8)
    path[:, -1] = score.argmax(1)
    for s in range(t - 1, 0, -1):
        path[:, s - 1] = back[np.arange(n), s, path[:, s]]
    return path, np.take_along_axis(marginals, path[..., None].astype(int), 2)[..., 0]


# ---- windows and their reconciliation ----

def window_starts(text: str) -> list[int]:
    """Starts of the windows over all stretches with a digit or @."""
    starts = []
    for m in STRETCH.finditer(text):
        first, last = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        starts += range(first, max(first + 1, last - WIDTH + STRIDE), STRIDE)
    return starts


def reconciled(text: str, starts: list[int], paths, sure) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, confidence): every character takes the tag of the window in which it stands most centrally.

    Starts rise, so two windows that overlap share the characters between them at the middle of the overlap.
    """
    spans, run = [], None
    for n, (start, path, p) in enumerate(zip(starts, paths, sure)):
        end = min(start + WIDTH, len(text))
        low = start if n == 0 or starts[n - 1] + WIDTH <= start else (start + min(starts[n - 1] + WIDTH, len(text)) + 1) // 2
        high = end if n + 1 == len(starts) or end <= starts[n + 1] else (starts[n + 1] + end + 1) // 2
        for at in (np.flatnonzero(path[low - start:high - start]) + low).tolist():
            tag, q = int(path[at - start]), float(p[at - start])
            kind = (tag - 1) // 2
            if run and at == run[2] and kind == run[1] and tag % 2 == 0:
                run[2], run[3] = at + 1, min(run[3], q)
                continue
            if run:
                spans.append(run)
            run = [at, kind, at + 1, q]
    if run:
        spans.append(run)
    return [(a, k, b, q) for a, k, b, q in spans if plausible(k, text[a:b])]


def written(rng, kind: int) -> str:
    """A made-up span of a kind in one of its forms: those of the fixed patterns and others."""
    def some(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    if kind == 0:
        name, house = ("".join(rng.choice(list("abcdefghijklmnoprstuvw"), int(rng.integers(3, 9)))) for _ in range(2))
        return f"{name}{rng.choice(['@', ' @ ', '@'])}{house}.{rng.choice(['com', 'org', 'net', 'de', 'io'])}".replace(" ", "")
    if kind == 1:
        return ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        d = [int(x) for x in some(15)]
        total = sum(x * 2 - 9 * (x > 4) if n % 2 == 0 else x for n, x in enumerate(d))
        d = "".join(map(str, d)) + str(-total % 10)
        return str(rng.choice(["", " ", "-", ".", "  "])).join(d[n:n + 4] for n in range(0, 16, 4))
    a, b, c = some(3), some(3), some(4)
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"+{rng.integers(1, 99)} {a} {b} {c}"][rng.integers(5)]


def foreign(rng) -> str:
    """A number that is no personal data."""
    def some(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    y, m, d = rng.integers(1900, 2100), rng.integers(1, 13), rng.integers(1, 29)
    return [f"{y}-{m:02d}-{d:02d}", f"{d}.{m}.{y}", f"{y}", f"{rng.integers(1, 99)},{some(3)}.{some(2)}", some(int(rng.integers(3, 20))),
            f"v{rng.integers(9)}.{rng.integers(20)}.{rng.integers(30)}", f"{rng.integers(24):02d}:{some(2)}", f"({y})", f"{some(3)}-{some(2)}",
            f"@{'abcdefg'[:rng.integers(1, 7)]}", f"{some(4)}-{some(4)}", f"{y}-{y + 1}", f"{some(3)} {some(3)}", f"({some(2)}) {some(3)}"][rng.integers(14)]


def training_windows(texts: list[str], most: int = TRAIN_WINDOWS) -> tuple[list[str], list[np.ndarray]]:
    """Windows around labelled spans of the texts, written spans in other places of theirs, and foreign numbers there."""
    rng = np.random.default_rng(SEED)
    out, tags = [], []

    def add(text, spans, at):
        start = max(0, at - int(rng.integers(4, WIDTH - 24)))
        window, marks = text[start:start + WIDTH], np.zeros(WIDTH, np.int64)
        for a, k, b in spans:
            if a >= start and b <= start + len(window):
                marks[a - start] = 1 + 2 * k
                marks[a - start + 1:b - start] = 2 + 2 * k
            elif b > start and a < start + len(window):
                return  # a span cut by the window's edge teaches nothing
        out.append(window)
        tags.append(marks)

    each = max(1, -(-most // max(1, len(texts))))
    for text in texts:
        spans = base_spans(text)
        if spans:
            add(text, spans, spans[int(rng.integers(len(spans)))][0])
        places = [m.start() for m in re.finditer(" ", text) if not any(a - WIDTH < m.start() < b + WIDTH for a, _, b in spans)] or [0]
        for _ in range(each):
            at = places[int(rng.integers(len(places)))]
            kind = int(rng.choice([0, 1, 2, 3, 3, 3, 4, 4, 4, 4, 4]))
            new = foreign(rng) if kind == 4 else written(rng, kind)
            before, after = text[max(0, at - WIDTH):at] + " ", rng.choice([" ", " ", ", ", ". "]) + text[at + 1:at + WIDTH]
            if rng.random() < 0.1:
                before, after = ("", after) if rng.random() < 0.5 else (before, "")
            add(before + new + after, [] if kind == 4 else [(len(before), kind, len(before) + len(new))], len(before))
    return out, tags


def chosen_confidence(w, windows: list[str], tags: list[np.ndarray]) -> float:
    """The least confidence whose spans in held-out windows reach ``PRECISION``; 1.1 (no span) if there is none."""
    paths, sure = best_tags(w, windows)
    rated = []
    for text, marks, path, p in zip(windows, tags, paths, sure):
        for a, k, b, q in reconciled(text, [0], [path], [p]):
            inside = marks[a] == 1 + 2 * k and (marks[a + 1:b] == 2 + 2 * k).all() and (b == len(marks) or marks[b] != 2 + 2 * k)
            rated.append((q, bool(inside)))
    rated.sort(reverse=True)
    right, best = 0, 1.1
    for n, (q, good) in enumerate(rated, 1):
        right += good
        if right >= PRECISION * n:
            best = q
    return best


def trained(docs: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray] | None:
    """The model, fitted in one task on a bounded sample of the documents with a digit or @."""
    some = docs.filter(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull()).select("doc_id", "text")
    sample = some.filter(hashed_below(sample_share(some.count(), rows), "doc_id"))

    def run(batches):
        texts = [t for b in batches for t in b.column("text").to_pylist()]
        windows, tags = training_windows(texts)
        if windows:
            held = np.arange(len(windows)) % HELD_SHARE == 0
            w = fit([x for x, h in zip(windows, held) if not h], [x for x, h in zip(tags, held) if not h])
            w["confidence"] = np.array([chosen_confidence(w, [x for x, h in zip(windows, held) if h], [x for x, h in zip(tags, held) if h])], np.float32)
            yield pa.RecordBatch.from_pydict({"name": pa.array(list(w)), "data": pa.array([x.tobytes() for x in w.values()], pa.binary()),
                                              "shape": pa.array([list(x.shape) for x in w.values()], pa.list_(pa.int32()))})

    ordered = sample.repartition(1).sortWithinPartitions("doc_id", "text").select("text")
    parts = ordered.mapInArrow(run, "name string, data binary, shape array<int>").collect()
    return {p["name"]: np.frombuffer(p["data"], np.float32).reshape(p["shape"]) for p in parts} or None


def found(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """doc_id, counts and digest of the spans of the fixed patterns, number of added spans, all spans."""
    def make():
        def step(batch):
            texts = [t or "" for t in batch["text"]]
            base = [base_spans(t) for t in texts]
            added: list[list] = [[] for _ in texts]
            if model:
                starts = [window_starts(t) for t in texts]
                flat = [(i, s) for i, own in enumerate(starts) for s in own]
                paths, sure = [], []
                for at in range(0, len(flat), GROUP):
                    p, q = best_tags(model, [texts[i][s:s + WIDTH] for i, s in flat[at:at + GROUP]])
                    paths.append(p)
                    sure.append(q)
                at = 0
                if flat:
                    paths, sure = np.concatenate(paths), np.concatenate(sure)
                for i, own in enumerate(starts):
                    if own:
                        mine = reconciled(texts[i], own, paths[at:at + len(own)], sure[at:at + len(own)])
                        added[i] = [(x, k, y) for x, k, y, q in mine if q >= model["confidence"][0]
                                    and not any(x < b and a < y for a, _, b in base[i])]
                        at += len(own)

            def joined(spans):
                return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))

            out = {"doc_id": batch["doc_id"], "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b in base],
                   "n_added": [len(a) for a in added], "spans": [joined(b + a) for b, a in zip(base, added)]}
            for k, name in enumerate(KINDS):
                out[f"n_{name}"] = [sum(x[1] == k for x in b) for b in base]
            return out
        return step

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_batches(docs.select("doc_id", "text"),
                       f"doc_id bigint, {counts}, n_added bigint, base_sha256 string, spans string", make)


def find(docs: DataFrame) -> DataFrame:
    return found(docs.select("doc_id", "text"), trained(docs))
