"""Line-first cleaning: rules judge lines, failing lines go, documents that lose too much text are rejected.

A document goes through in one narrow pass (no shuffle): lines are judged one by one, the failing ones are
removed, and the verdict compares the words that went with the words that were there.

Defined cases: a null or empty text has one empty line and no words, so it fails the base rule; lines without
a word are neither judged nor counted as loss; a very long text or line is judged whole; equal rows get equal results; an
empty table gives an empty result. ``quality`` reads doc_id and text only, ``cleaned`` returns the five columns of the
documents table and no others.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from equisite.llm.base import WORD, map_batches

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
STOPS = ".,;:!?…。，、！？；：،؛؟।"
UPPER_RUN = "[A-ZÀ-ÖØ-Þ]{2,}"
NAVIGATION = ("skip to content", "back to top", "sign in", "log in", "previous page", "next page", "read more",
              "click here", "share this", "main menu", "site map")
BOILERPLATE = ("cookie", "javascript", "all rights reserved", "terms of use", "terms of service", "privacy policy",
               "lorem ipsum", "subscribe to our")
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LOSS_PCT = 30
"""A document that loses more than this share of its words is rejected."""

LONG_LINE = 30
SHORT_LINE = 12
"""Words of a line that a navigation or boilerplate phrase can fail; a longer line may speak of such things."""

SCHEMA = ("doc_id bigint, n_words bigint, n_symbols bigint, word_chars bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, n_lost_words bigint, n_lost_lines bigint, kept boolean")


def repeated_words(words: list[str]) -> int:
    """Words inside a three-word window that occurs at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    size = len(seen) + 1
    pairs = ids[:-1] * size + ids[1:]
    if size > 1 << 20:  # renumbered, so that the third word still fits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, where, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    hit = counts[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= hit
    return int(covered.sum())


def line_fails(line: str, n: int, upper) -> bool:
    """The rules for one line of ``n`` >= 1 words."""
    separators = sum(map(line.count, SEPARATORS))
    bangs = line.count("!")
    if 4 * sum(map(line.count, SYMBOLS)) > n or (bangs >= 3 and 3 * bangs > n):
        return True  # punctuation: symbols or exclamation marks instead of sentences
    if n >= LONG_LINE and not any(s in line for s in STOPS):
        return True  # punctuation: a long run without any
    if separators >= 2 and 3 * separators >= n:
        return True  # navigation: a list of links
    if n >= 5 and 2 * len(upper.findall(line)) > n:
        return True  # shouting
    low = line.lower()
    return n <= SHORT_LINE and any(p in low for p in NAVIGATION + BOILERPLATE)


def judge_text(text: str | None, upper) -> tuple:
    text = text or ""
    lines = text.split("\n")
    words, kept_lines, lost, gone, dup = [], [], 0, 0, 0
    seen: set[str] = set()
    for line in lines:
        own = WORD.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        dup += line in seen
        seen.add(line)
        words += own
        if line_fails(line, len(own), upper):
            lost += len(own)
            gone += 1
        else:
            kept_lines.append(line)
    n, repeat = len(words), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n
    return (n, sum(map(text.count, SYMBOLS)), sum(map(len, words)), dup, repeat, failed, lost, gone,
            not failed and 100 * lost <= MAX_LOSS_PCT * n, kept_lines)


NAMES = ("n_words", "n_symbols", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed", "n_lost_words",
         "n_lost_lines", "kept")


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base rule and verdict."""
    def make():
        import re
        upper = re.compile(UPPER_RUN)

        def step(batch):
            rows = [judge_text(t, upper) for t in batch["text"]]
            return {"doc_id": batch["doc_id"]} | {n: [r[i] for r in rows] for i, n in enumerate(NAMES)}
        return step

    return map_batches(docs.select("doc_id", "text"), SCHEMA, make)


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept documents with their failing lines removed; the columns of the documents table."""
    def make():
        import re
        upper = re.compile(UPPER_RUN)

        def step(batch):
            out = {k: [] for k in ("doc_id", "text", "lang", "source", "n_chars")}
            for i, text in enumerate(batch["text"]):
                row = judge_text(text, upper)
                if row[8]:
                    clean = "\n".join(row[9])
                    for k in ("doc_id", "lang", "source"):
                        out[k].append(batch[k][i])
                    out["text"].append(clean)
                    out["n_chars"].append(len(clean))
            return out
        return step

    return map_batches(docs.select("doc_id", "text", "lang", "source"),
                       "doc_id bigint, text string, lang string, source string, n_chars bigint", make)


def oracle_sql() -> str:
    def listed(phrases):
        return "(" + "|".join(p.replace("|", r"\|") for p in phrases) + ")"

    def count(text, chars):
        return f"(length({text}) - length(translate({text}, '{chars}', '')))"
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM t),
m AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
        {count('line', SEPARATORS)} AS seps, {count('line', SYMBOLS)} AS syms, {count('line', '!')} AS bangs
      FROM l),
j AS (SELECT r, n,
        4 * syms > n OR (bangs >= 3 AND 3 * bangs > n) OR (n >= {LONG_LINE} AND {count('line', STOPS)} = 0)
        OR (seps >= 2 AND 3 * seps >= n) OR (n >= 5 AND 2 * len(regexp_extract_all(line, '{UPPER_RUN}')) > n)
        OR (n <= {SHORT_LINE} AND regexp_matches(lower(line), '{listed(NAVIGATION + BOILERPLATE)}')) AS bad,
        row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS dup FROM m WHERE n > 0),
d AS (SELECT r, count(*) FILTER (WHERE dup) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE bad), 0)::BIGINT AS n_lost_words,
        count(*) FILTER (WHERE bad) AS n_lost_lines FROM j GROUP BY r),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
        unnest(range(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))) AS i FROM t),
g AS (SELECT r, i, w, lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS rest FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, i, w, CASE WHEN rest IS NULL THEN 0 ELSE (count(*) OVER (PARTITION BY r, w, rest) > 1)::INT END AS hit FROM g),
c AS (SELECT r, w, greatest(hit, lag(hit, 1, 0) OVER o, lag(hit, 2, 0) OVER o) AS cov FROM h WINDOW o AS (PARTITION BY r ORDER BY i)),
s AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, sum(cov)::BIGINT AS n_repeat_words FROM c GROUP BY r),
f AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, {count('text', SYMBOLS)}::BIGINT AS n_symbols,
        coalesce(word_chars, 0) AS word_chars, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lost_words, 0) AS n_lost_words,
        coalesce(n_lost_lines, 0) AS n_lost_lines FROM t LEFT JOIN d USING (r) LEFT JOIN s USING (r))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)
  AND 100 * n_lost_words <= {MAX_LOSS_PCT} * n_words AS kept FROM f"""
