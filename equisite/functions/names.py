"""Name normalisation and token-sorted similarity, as expressions."""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def _expansions() -> dict[str, str]:
    """Characters whose compatibility decomposition, without marks, holds ASCII text: ligatures, fractions, letters
    beyond the basic plane and accented letters alike. What is not ASCII in it is a blank."""
    out = {}
    for code in range(0xA0, sys.maxunicode + 1):
        parts = unicodedata.normalize("NFKD", chr(code)) if not 0xD800 <= code < 0xE000 else ""
        base = "".join(c if c.isascii() else " " for c in parts if not unicodedata.combining(c))
        if base.strip() and chr(code) != base:
            out[chr(code)] = base
    return out


EXPANSIONS = _expansions()
ACCENTED, PLAIN = (list(x) for x in zip(*((c, e) for c, e in EXPANSIONS.items() if len(e) == 1)))
ACCENTED, PLAIN = "".join(ACCENTED), "".join(PLAIN)
LONGER = {c: e for c, e in EXPANSIONS.items() if len(e) > 1}


def _class_of(characters: Sequence[str]) -> str:
    """A character class of these, neighbours as ranges."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in runs) + "]"


LONGER_MARK = _class_of([c for c in LONGER if ord(c) < 256]) + r"|(?=[^\x00-\xff])" + _class_of([c for c in LONGER if ord(c) >= 256])
"""Pattern of the characters that stand for several: those beyond Latin-1, of which a text has few, meet the long class."""


def _spelled_out(s: Column) -> Column:
    """Characters that stand for several letters, written as these; only texts that hold one are taken apart."""
    table = F.from_json(F.lit(json.dumps(LONGER)), "map<string,string>")
    def letters(c: Column) -> Column:  # the table is gone through entry by entry, so plain letters pass it by
        return F.when(c < min(LONGER), c).otherwise(F.coalesce(F.try_element_at(table, c), c))
    apart = F.array_join(F.transform(F.split(s, ""), letters), "")
    return F.when(s.rlike(LONGER_MARK), apart).otherwise(s)


# Words that carry no identity, and words that tell siblings apart.
NOISE_WORDS = ("district", "dist", "zila", "zilla", "pargana", "division")
QUALIFIERS = ("north", "south", "east", "west", "central", "upper", "lower", "urban", "rural",
              "metropolitan", "new", "purba", "paschim", "uttar", "dakshin", "poorvi", "pashchim")

MASK_LENGTH = 62
"""Characters that fit one whole number as a position mask."""


def normalise(name: Column | str, noise: Sequence[str] = NOISE_WORDS) -> Column:
    """Strip accents, lower, spell out ``&``, drop noise words and punctuation, collapse spaces."""
    s = F.col(name) if isinstance(name, str) else name
    # letters written with separate combining marks lose the marks first
    s = _spelled_out(F.regexp_replace(s, r"\p{M}+", ""))
    s = F.lower(F.translate(s, ACCENTED, PLAIN))
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = F.translate(s, "-.", "  ")
    s = F.regexp_replace(s, r"\b(" + "|".join(noise) + r")\b", " ")
    s = F.regexp_replace(s, "[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(s, " +", " "))


def qualifier_tokens(norm: Column | str, words: Sequence[str] = QUALIFIERS) -> Column:
    """The qualifiers of a normalised name, as a sorted set; siblings differ in it."""
    s = F.col(norm) if isinstance(norm, str) else norm
    return F.array_sort(F.array_intersect(F.split(s, " "), F.array(*[F.lit(w) for w in words])))


def token_sort(norm: Column | str) -> Column:
    s = F.col(norm) if isinstance(norm, str) else norm
    return F.array_join(F.array_sort(F.split(s, " ")), " ")


def _characters(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def position_masks(text: Column | str) -> Column:
    """Character -> whole number whose bits mark the character's positions (up to 62 of them)."""
    s = F.col(text) if isinstance(text, str) else text
    chars = _characters(s)
    places = F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1)))

    def mask(c: Column) -> Column:
        here = F.filter(places, lambda i: F.element_at(chars, i) == c)
        bits = F.transform(here, lambda i: F.expr("1L") * F.call_function("shiftleft", F.lit(1).cast("long"), i - 1))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a + b)

    distinct = F.array_distinct(chars)
    return F.when((F.length(s) <= MASK_LENGTH) & (F.length(s) > 0),
                  F.map_from_arrays(distinct, F.transform(distinct, mask)))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_bag(text: Column | str) -> Column:
    """A whole number with two bits for every letter: one copy, at least two copies."""
    s = F.col(text) if isinstance(text, str) else text
    bits = F.lit(0).cast("long")
    for at, letter in enumerate(LETTERS):
        copies = F.length(s) - F.length(F.replace(s, F.lit(letter), F.lit("")))
        bits = bits.bitwiseOR(F.when(copies >= 2, F.lit(3 << 2 * at)).when(copies == 1, F.lit(1 << 2 * at)).otherwise(F.lit(0)))
    return bits


def similarity_bound(left_length: Column, left_bag: Column, right_length: Column, right_bag: Column) -> Column:
    """What ``similarity_e4`` can be at most: common letters by their bags, and all that the bags leave out as common."""
    known = F.bit_count(left_bag.bitwiseAND(right_bag))
    left_over, right_over = left_length - F.bit_count(left_bag), right_length - F.bit_count(right_bag)
    common = F.least(known + F.least(left_over, right_over), left_length, right_length)
    whole = left_length + right_length
    return F.when(whole == 0, F.lit(1_000_000).cast("long")).otherwise(
        F.call_function("div", common.cast("long") * 2_000_000, F.greatest(whole, F.lit(1))))


def bigrams(text: Column | str) -> Column:
    """Neighbouring characters with the number of their copy, so that common copies are counted as equal elements."""
    s = F.col(text) if isinstance(text, str) else text
    pairs = F.when(F.length(s) >= 2, F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substr(s, i, F.lit(2)))).otherwise(
        F.array().cast("array<string>"))
    return F.transform(pairs, lambda g, i: F.concat(g, F.size(F.filter(F.slice(pairs, F.lit(1), i + 1), lambda x: x == g)).cast("string")))


def least_common_bigrams(length: Column, score_e4: Column) -> Column:
    """Bigrams that a name of ``length`` shares at least with any name of this similarity or more.

    A common subsequence of L characters leaves the left name by a - L deletions, each of which ends two bigrams at most, and
    becomes the right one by b - L insertions, each of which ends one: 3 L - a - b - 1 are shared. The shortest right name
    that allows the similarity is the worst case, as long as the similarity is above two thirds.
    """
    score = score_e4.cast("long")
    shortest = F.call_function("div", score * length + 1_999_999 - score, F.lit(2_000_000) - score)
    whole = length + shortest
    needed = F.ceil((whole * (3 * score - 2_000_000)) / F.lit(2_000_000.0)) - 1
    return F.when(3 * score > 2_000_000, needed).otherwise(F.lit(0)).cast("int")


def lcs_length(left: Column, right: Column, right_masks: Column) -> Column:
    """Longest common subsequence length.

    Bit-parallel (one addition per character of ``left``) while ``right`` fits a mask; else the
    ordinary table, one row at a time, over the whole text.
    """
    ones = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(right)) - 1

    def step(row: Column, c: Column) -> Column:
        hit = row.bitwiseAND(F.coalesce(F.try_element_at(right_masks, c), F.lit(0).cast("long")))
        return (row + hit).bitwiseOR(row - hit).bitwiseAND(ones)

    fast = F.aggregate(_characters(left), ones, step,
                       lambda row: F.length(right) - F.bit_count(row).cast("int"))
    return F.when(right_masks.isNotNull(), fast).otherwise(_lcs_table(left, right))


def _lcs_table(left: Column, right: Column) -> Column:
    chars = _characters(right)
    blank = F.transform(F.sequence(F.lit(0), F.length(right)), lambda _: F.lit(0))

    def next_row(row: Column, a: Column) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.length(right), F.lit(1))), start,
            lambda new, j: F.concat(new, F.array(
                F.when(F.try_element_at(chars, j) == a, F.element_at(row, j) + 1)
                .otherwise(F.greatest(F.coalesce(F.try_element_at(row, j + 1), F.lit(0)),
                                      F.element_at(new, -1))))))

    return F.when((F.length(left) == 0) | (F.length(right) == 0), F.lit(0)).otherwise(
        F.element_at(F.aggregate(_characters(left), blank, next_row), -1))


def similarity_e4(left: Column, right: Column, right_masks: Column) -> Column:
    """Similarity of two token-sorted names, 0..1,000,000 (percent times 10**4).

    Twice the longest common subsequence over both lengths; two empty names are alike.
    """
    whole = F.length(left) + F.length(right)
    lcs = lcs_length(left, right, right_masks)
    return F.when(whole == 0, F.lit(1_000_000).cast("long")).otherwise(
        F.call_function("div", lcs.cast("long") * 2_000_000, whole))
