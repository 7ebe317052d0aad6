"""Main text of web pages by minimum cut.

A page becomes blocks of text (runs between block-level tags). A linear classifier gives every block a cost for each
label, from its containers, their class and id words, its links, length and punctuation: these are the capacities to
the two terminals. Neighbours on the page and neighbours under one parent element are tied by smoothness edges. The
minimum cut, found by augmenting flows, separates content from boilerplate at the least total cost; content blocks are
joined by line breaks.

One narrow pass, page by page; memory is that of a page. Nothing is learned: the tables have no labelled pages, so the
classifier's weights are the constants below.

Defined cases: a null or empty page has the empty text; text without any tag is one block; unclosed elements, empty comments,
unknown character references and pages that end inside a tag are taken as browsers do; very long pages are read whole,
in time that grows with their length; words of notices count in blocks below ``NOTICE_CHARS`` characters; repeated rows get
equal results; an empty table gives an empty result; only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame

from equisite.llm.base import map_batches

START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
COMMENT_END = re.compile(r"-?>|.*?--!?>", re.S)
TAIL = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
"""The rest of a tag: quotes count after an equals sign only. Nothing is tried twice, so long pages take linear time."""

ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|type)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPACE = re.compile(r"\s+")
SPLIT = re.compile(r"[^a-z0-9]+")

RAW = frozenset("script style textarea title iframe noembed".split())
"""Without an end tag these hold the rest of the page, as in browsers."""
SKIPPED = frozenset("template svg object canvas select datalist button".split())
"""What these hold is left out where they end; they do not cut the sentence they stand in."""
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr img ruby rt rp "
                   "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace mpadded semantics "
                   "annotation".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                     "pre section table ul".split())
SAME_CLOSES = frozenset("p li dt dd tr td th".split())
BARRED = frozenset("nav footer aside dialog menu noscript input".split())
DOUBTED = frozenset("form fieldset address".split())
HOME = frozenset("article main".split())
BAD_WORDS = frozenset(
    "nav navbar navigation menu footer sidebar ad ads advert adverts advertisement advertising banner promo promotion "
    "sponsor sponsored cookie cookies consent gdpr notice notices alert comment comments commentlist respond reply share "
    "sharing social related recommended subscribe subscription newsletter breadcrumb breadcrumbs login signup signin popup "
    "modal overlay widget copyright legal toolbar pagination pager tags masthead disclaimer topbar search complementary "
    "contentinfo discussion disqus teaser outbrain taboola skip".split())
OTHER_WORDS = frozenset("comment comments commentlist respond reply discussion disqus related recommended teaser outbrain taboola".split())
"""Bad words for prose that is not the page's own."""
BESIDE_WORDS = frozenset("has with no without and".split())
WRAP_WORDS = frozenset("wrap wrapper container layout grid row columns area page site".split())
"""A class that says what a page has beside its content, or that ends in a wrapper with content in it, is no bad word."""
GOOD_WORDS = frozenset("article content post entry main story body text".split())
NOTICES = ("cookie", "all rights reserved", "subscribe to", "sign up for", "privacy policy", "terms of", "©", "log in to",
           "click here", "enable javascript")

BARRED_COST, DOUBT_COST, HOME_GAIN, GOOD_GAIN, HEADING_GAIN = 160, 100, 40, 12, 10
LINK_COST, NOTICE_COST, SHORT_COST, WORDS_GAIN, STOP_GAIN = 40, 20, 12, 4, 6
NEXT_TIE, SIBLING_TIE = 4, 6
PROSE_CHARS, LEAST_LIFTED, FREE_SHARE, NOTICE_CHARS = 40, 100, 5, 400
"""Characters of a prose block; of an element whose mark can be lifted; a page's free prose is little below one FREE_SHARE-th."""


class Block:
    __slots__ = ("text", "linked", "parent", "bad", "doubts", "home", "good", "heading")

    def __init__(self, text, linked, at):
        self.text, self.linked = text, linked
        _, self.parent, self.bad, self.home, self.good, self.heading, _, self.doubts = at


def bad_words(value: str) -> set[str]:
    """The bad words of a class, id or role, name by name."""
    out: set[str] = set()
    for name in value.split():
        words = [w for w in SPLIT.split(name) if w]
        wraps = words and words[-1] in WRAP_WORDS and not GOOD_WORDS.isdisjoint(words)
        if not wraps and BESIDE_WORDS.isdisjoint(words):
            out |= BAD_WORDS.intersection(words)
    return out


def attributes(raw: str, inside_home: bool, tag: str) -> tuple[bool, bool, bool, bool, bool]:
    """Whether an element is barred, is doubted, holds others' prose, is good, and is the main one."""
    bad, good, main = tag in BARRED, False, tag == "main"
    doubted, words = tag in DOUBTED or (tag == "header" and not inside_home), set()
    if raw and raw.strip("/ "):
        for name, value in ATTRIBUTE.findall(raw):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "style":
                bad |= "display:none" in value.replace(" ", "")
            elif name in ("hidden", "aria-hidden"):
                bad |= value in ("", "hidden", "true") and (name == "hidden" or value == "true")
            elif name != "type":
                main |= name == "role" and value == "main"
                words |= bad_words(value) if tag not in ("body", "html") else set()
                good |= not GOOD_WORDS.isdisjoint(SPLIT.split(value))
    return bad, doubted or bool(words), not words.isdisjoint(OTHER_WORDS), good, main


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    # tag, number, bad, home, good, heading, in a link, doubted elements: the marks hold for all that is inside, but a main
    # element leaves the doubts about its wrappers behind
    root = ("", 0, False, False, False, False, False, ())
    stack, number, open_ = [root], 0, {}
    parts: list[str] = []
    linked = 0
    owner = root

    def flush():
        nonlocal parts, linked
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append(Block(text, linked / max(1, len(text)), owner))
        parts, linked = [], 0

    def close(tag):
        while stack[-1][0] != tag:
            open_[stack.pop()[0]] -= 1
        open_[stack.pop()[0]] -= 1

    at, end, endless = 0, len(page), set()
    while at < end:
        m = START.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            if not parts:
                owner = next(s for s in reversed(stack) if s[0] not in INLINE)
            parts.append(text)
            if stack[-1][6]:
                linked += len(text)
        if not m:
            break
        ending, tag = m.group(1), (m.group(2) or "").lower()
        tail = COMMENT_END.match(page, m.end()) if m.group() == "<!--" else TAIL.match(page, m.end()) if tag else None
        if tag == "" and m.group() != "<!--":
            at = page.find(">", m.end()) + 1 or end
            continue
        if not tail:
            break  # the page ends inside a tag or a comment
        at = tail.end()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "option":  # its end tag may be missing: the label goes, and nothing else
            after = page.find("<", at)
            at = at if ending else after if after >= 0 else end
            continue
        if tag in RAW or tag in SKIPPED:
            if not ending and tag not in endless and not (tag in SKIPPED and tail.group(1).endswith("/")):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if not stop:
                    endless.add(tag)
                at = stop.end() if stop else end if tag in RAW else at
            continue
        if tag not in INLINE:
            flush()
        if ending:
            if open_.get(tag):
                close(tag)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and open_.get("p"):
            close("p")
        if tag in SAME_CLOSES and stack[-1][0] == tag:
            close(tag)
        top = stack[-1]
        bad, doubted, other, good, main = attributes(tail.group(1), top[3], tag)
        number += 1
        doubts = (() if main else top[7]) + (((number, other),) if doubted and not main else ())
        stack.append((tag, number, top[2] or bad, top[3] or main or tag in HOME, top[4] or good,
                      top[5] or (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()), top[6] or tag == "a", doubts))
        open_[tag] = open_.get(tag, 0) + 1
    flush()
    return out


def lift_doubts(blocks: list[Block]) -> None:
    """Takes doubts back where the page has little prose besides.

    While the prose outside doubted elements is little and in no article, the outermost doubted element with most prose
    is a wrapper: its mark goes. Others' prose (comments, related pages) is lifted only if there is nothing else.
    """
    prose = [b for b in blocks if not b.bad and len(b.text) >= PROSE_CHARS and b.linked < 0.3
             and not any(n in b.text.lower() for n in NOTICES if len(b.text) < NOTICE_CHARS)]
    total = sum(len(b.text) for b in prose)
    while True:
        held: dict[tuple[int, bool], int] = {}
        free, home = 0, False
        for b in prose:
            if b.doubts:
                held[b.doubts[0]] = held.get(b.doubts[0], 0) + len(b.text)
            else:
                free += len(b.text)
                home |= b.home
        held = {d: n for d, n in held.items() if n >= LEAST_LIFTED and not (d[1] and free)}
        if not held or home or FREE_SHARE * free >= total:
            return
        top = max(held, key=lambda d: (not d[1], held[d]))
        for b in blocks:
            if b.doubts and b.doubts[0] == top:
                b.doubts = b.doubts[1:]


def leaning(block: Block) -> int:
    """The classifier: cost of calling the block boilerplate less the cost of calling it content."""
    words = block.text.count(" ") + 1
    low = block.text.lower() if len(block.text) < NOTICE_CHARS else ""
    score = WORDS_GAIN * min(words.bit_length(), 6) - SHORT_COST
    score += STOP_GAIN * (block.text[-1] in ".!?…。\"'”»:" or ". " in block.text)
    score -= int(LINK_COST * min(1.0, block.linked))
    score -= NOTICE_COST * any(n in low for n in NOTICES)
    score += HOME_GAIN * block.home + GOOD_GAIN * block.good + HEADING_GAIN * block.heading
    return score - BARRED_COST * block.bad - DOUBT_COST * (not block.bad and bool(block.doubts))


def ties(blocks: list[Block]) -> dict[tuple[int, int], int]:
    """Smoothness edges: the next block on the page, and the next block under the same parent."""
    out: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            out[(i - 1, i)] = NEXT_TIE
        if b.parent in last:
            key = (last[b.parent], i)
            out[key] = out.get(key, 0) + SIBLING_TIE
        last[b.parent] = i
    return out


def minimum_cut(lean: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Blocks on the content side of a minimum cut.

    A block leans to one terminal by the difference of its two capacities; flow goes from blocks that lean to content,
    over the edges, to blocks that lean away. Distances from all sources are found once per phase, then flow is pushed
    along falling distance until none gets through, every block remembering the arc it is at.
    """
    n = len(lean)
    left = list(lean)
    room: list[dict[int, int]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        room[a][b] = room[a].get(b, 0) + c
        room[b][a] = room[b].get(a, 0) + c
    around = [list(r) for r in room]
    while True:
        front = [i for i in range(n) if left[i] > 0]
        far = [-1] * n
        for i in front:
            far[i] = 0
        found = False
        while front and not found:
            after = []
            for i in front:
                for j in around[i]:
                    if far[j] < 0 and room[i][j]:
                        far[j] = far[i] + 1
                        found |= left[j] < 0
                        after.append(j)
            front = after
        if not found:
            return [x >= 0 for x in far]
        arc = [0] * n
        for source in range(n):
            path = [source] if far[source] == 0 else []
            while path and left[source] > 0:
                i = path[-1]
                if left[i] < 0:
                    amount = min(left[source], -left[i], min(room[a][b] for a, b in zip(path, path[1:])))
                    left[source] -= amount
                    left[i] += amount
                    for a, b in zip(path, path[1:]):
                        room[a][b] -= amount
                        room[b][a] += amount
                    path = [source]
                elif arc[i] == len(around[i]):
                    path.pop()
                    if path:
                        arc[path[-1]] += 1
                else:
                    j = around[i][arc[i]]
                    if room[i][j] and far[j] == far[i] + 1:
                        path.append(j)
                    else:
                        arc[i] += 1


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    lift_doubts(blocks)
    keep = minimum_cut([leaning(b) for b in blocks], ties(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    def make():
        def step(batch):
            texts = [main_text(h) for h in batch["html"]]
            return {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
        return step

    return map_batches(pages.select("page_id", "url", "html"),
                       "page_id bigint, url string, text string, n_chars bigint", make)
