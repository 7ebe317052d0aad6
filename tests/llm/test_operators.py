"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from equisite.llm import (chosen_path, fingerprints, html_text, line_dedup, mixing, packing, private_data, queries,
                          quality_rules)
from equisite.llm.base import table
from suite import check

WORDS = re.compile(r"[^ \t-\r]+")


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r.doc_id: r.text or "" for r in table(spark, small, "documents").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, small, name):
    result = check.compare(spark, check.connect(small), small, queries.QUERIES[name], queries.ORACLES[name])
    assert result.startswith("ok") and "EMPTY" not in result, result


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language(spark, small):
    langs = {r.doc_id: r.lang for r in table(spark, small, "documents").collect()}
    rows = queries.QUERIES["op2_language_id"](spark, small).collect()
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 and r.held_out == held_out(r.doc_id) for r in rows)
    tested = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in tested]) > 0.95


def test_quality_classifier(spark):
    small = "/root/testdata/sf0.01"  # the smallest tables have a handful of held-out labels
    marks = {r.doc_id: r.quality for r in table(spark, small, "labels").collect()}
    rows = queries.QUERIES["op9_quality_classifier"](spark, small).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and marks.get(r.doc_id) is not None]
    assert np.mean([r.predicted == marks[r.doc_id] for r in tested]) > 0.95


def brute_classes(texts):
    sets = {}
    for k, t in texts.items():
        w = WORDS.findall(t)
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    where = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            where[x].append(k)
    common = Counter((a, b) for v in where.values() for i, a in enumerate(v) for b in v[i + 1:])
    head, links = {k: k for k in sets}, Counter()

    def find(x):
        while head[x] != x:
            x = head[x]
        return x
    for (a, b), c in common.items():
        if 5 * c >= 4 * (len(sets[a]) + len(sets[b]) - c):
            links.update((a, b))
            a, b = find(a), find(b)
            head[max(a, b)] = min(a, b)
    return {k: (find(k), links[k]) for k in sets}


@pytest.mark.parametrize("limits", [{}, {"small": 2, "depth": 2}])
def test_jaccard_join(spark, small, texts, limits):
    rows = chosen_path.join(table(spark, small, "documents"), **limits).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == brute_classes(texts)


def test_jaccard_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK_SETS", 7)
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(base[:i % 55] + [f"x{i}"] + base[i % 55 + 1:]) for i in range(40)}
    texts |= {100 + i: texts[i] for i in range(5)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = chosen_path.join(docs, small=4).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == brute_classes(texts)


def test_jaccard_families_of_a_large_group(spark):
    """Two families of 170 template texts each, linked by twins only: large nodes with equal members are repetitions."""
    def text(family, k):
        words = [f"a20x{i}" for i in range(300)]
        words[10:34] = [f"{family}20_{i}" for i in range(24)]
        for j in range(8):
            words[100 + 20 * j] = f"v20y{j}z{k >> j & 1}"
        return " ".join(words)

    docs = spark.createDataFrame([(170 * f + k, text("pq"[f], k)) for f in range(2) for k in range(170)], "doc_id bigint, text string")
    assert {r.class_id for r in chosen_path.join(docs).collect()} == {0}


def test_recall_of_runs():
    assert 1 - (1 - chosen_path.survival(chosen_path.DEPTH)) ** chosen_path.runs_for(0.999) >= 0.999


def test_packing_round_trip(spark, small, texts):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.tokenizer_path())
    rows = queries.QUERIES["op4_best_fit_packing"](spark, small).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for k, t in texts.items():
        ids = np.array(whole.encode(t, add_special_tokens=False).ids + [1], "<u4")
        want = [(i, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())) for i, at in enumerate(range(0, len(ids), 4096))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[k]) == want
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 4096) + max(2, 0.02 * total / 4096)


@pytest.mark.parametrize("text", ["", "Ünï ß don't it's 12 a3 !!' 's <|endoftext|> x", "日本 ﬁne ² ½ İ", "a b\x1cc\td\n'll've"])
def test_token_ids(text):
    from tokenizers import Tokenizer
    path = packing.tokenizer_path()
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordIds(path).encode(text), "<u4").tolist() == want


def test_best_fit_is_tight():
    sizes = np.random.default_rng(1).integers(1, 4097, 3000).tolist()
    bins = packing.best_fit(sizes)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert max(sum(sizes[i] for i in b) for b in bins) <= 4096 and len(bins) <= 1.03 * sum(sizes) / 4096


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_sketch(text, k=fingerprints.K):
    w = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in WORDS.findall(text)]

    def chained(ws):
        s = 42
        for x in ws:
            s = xxhash.xxh64(struct.pack("<Q", x), seed=s).intdigest()
        return signed(s)
    every = {chained(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {chained(w)} if w else set()
    return sorted(every)[:k], every


def test_fingerprints(spark, small, texts):
    rows = {r.doc_id: r for r in queries.QUERIES["op8_fingerprints"](spark, small).collect()}
    order = sorted(texts)
    for i, k in enumerate(order):
        text, after = texts[k], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edit = text[:len(text) - half] + after[:half]
        (a, every_a), (b, every_b) = brute_sketch(text), brute_sketch(edit)
        r = rows[k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert r.fingerprint == ",".join("%x" % (x % (1 << 64)) for x in a)
        assert r.edited_fingerprint == ",".join("%x" % (x % (1 << 64)) for x in b)
        true = len(every_a & every_b) / len(every_a | every_b) if every_a | every_b else 1.0
        assert abs(r.near_edited - true) < 0.2


def test_sketch_estimates_and_merging(spark):
    from pyspark.sql import functions as F
    long, part = " ".join(f"w{i}" for i in range(5000)), " ".join(f"w{i}" for i in range(2000))
    df = spark.createDataFrame([(1, long, part)], "id int, a string, b string")
    df = fingerprints.with_sketch(fingerprints.with_sketch(df, "a", "_a"), "b", "_b")
    r = df.select(fingerprints.distinct_shingles(F.col("_a")), fingerprints.containment(F.col("_b"), F.col("_a")),
                  fingerprints.resemblance(F.col("_a"), F.col("_b"))).first()
    assert abs(r[0] / 4996 - 1) < 0.3 and r[1] > 0.8 and abs(r[2] - 0.4) < 0.15
    parts = df.select("id", F.col("_a").alias("s")).unionByName(df.select("id", F.col("_b").alias("s")))
    merged = fingerprints.merge_groups(parts, ["id"], "s").first().s
    assert merged == df.first()["_a"]


PAGE = """<html><body class="page"><header class="top"><a href=/>Logo</a></header><nav><ul><li><a>One</a></li></ul></nav>
<div class="cookie-banner">We use cookies. <button>OK</button></div><div id="content"><h1>A title</h1>
<p>First &amp; foremost, a
 paragraph <b>of words.<br><p>Second one, see <a href="y">this link</a> for all.</p><div class="share">Share</div>
<script>var t="</p>";</script><!-- ad --><blockquote>Quoted words stand here.</blockquote></div>
<aside><p>Some other article that is long enough to look like content, indeed it is.</p></aside>
<section id="comments"><p>I think this is great, thank you for writing.</p></section>
<form><label>Name</label></form><footer>&copy; 2020 All rights reserved</footer></body></html>"""


OPEN_END = re.compile(r"<[!/?a-zA-Z][^<]*\Z", re.S)


def test_html_text(spark, small):
    assert html_text.main_text(PAGE).split("\n") == [
        "A title", "First & foremost, a paragraph of words.", "Second one, see this link for all.", "Quoted words stand here."]
    assert [html_text.main_text(x) for x in (None, "", "<p", "<script>x")] == [""] * 4
    rows = queries.QUERIES["op5_html_main_text"](spark, small).collect()
    pages = {r.page_id: r.html for r in table(spark, small, "pages").collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)
        want = [" ".join(x.split()) for x in re.split(r"</?(?:p|h1)>|<br>", OPEN_END.sub("", inner[1]))]
        want = [" ".join(html_text.entities.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in want]
        assert r.text == "\n".join(x for x in want if x) and r.n_chars == len(r.text)


PROSE = "".join(f"<p>Sentence {i} of the article goes on for a while, as sentences in articles do.</p>" for i in range(6))


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main>{}</main><div class='sidebar'>{s}</div></div>",
    "<div class='has-sidebar'>{}<div class='sidebar'>{s}</div></div>", "<div class='page-with-menu'><article>{}</article></div>",
    "<form id=aspnet><div>{}</div><div class='sidebar'>{s}</div></form>", "<div class='sidebar layout'><article>{}</article></div>",
    "<form><div class='post'>{}</div><section id=comments><article>{s}{s}{s}{s}{s}{s}{s}{s}{s}</article></section></form>",
    "<article>{}</article><div class='sidebar'>{s}</div><div id='comments'>{s}{s}{s}{s}{s}{s}{s}{s}{s}{s}{s}{s}</div>"])
def test_wrappers_keep_the_article(page):
    other = "<p>Someone else wrote these words, which stand beside the article of this page.</p>"
    text = html_text.main_text(f"<body><nav><a>Home</a></nav>{page.format(PROSE, s=other)}<footer>Imprint and the rest.</footer></body>")
    assert text == "\n".join(re.findall("<p>(.*?)</p>", PROSE))


LINE = "This sentence of the article goes on for a while, as sentences do."


@pytest.mark.parametrize("page, lines", [
    ("<p>{x}</p><datalist><option value=a></datalist><p>{x}</p>", ["{x}", "{x}"]), ("<p>{x}</p><datalist><option value=a>Red<p>{x}</p>", ["{x}", "{x}"]),
    ("<p>{x}</p><select><option>Red<option>Blue</select><p>{x}</p>", ["{x}", "{x}"]), ("<p>{x} <svg width=1 /> {x}</p><p>{x}</p>", ["{x} {x}", "{x}"]),
    ("<p>{x} If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then so.</p>", ["{x} If x=1 then so."]), ("<p>{x}<math/> {x}</p>", ["{x} {x}"]),
    ("<p>{x}</p><!--><p>{x}</p>", ["{x}", "{x}"]), ("<p>{x}</p><!---><p>{x}</p><!-- <p>no</p> --!><p>{x}</p>", ["{x}", "{x}", "{x}"]),
    ("<p don't>{x}</p><p>{x}</p>", ["{x}", "{x}"]), ("<p title='a > b' x=\"'\">{x}</p>", ["{x}"]), ("<p>{x}<svg><path></p><p>{x}</p>", ["{x}", "{x}"]),
    ("<p>{x} Press <button>OK <b>now</b></button> to <script>'</p>'</script>go on.</p>", ["{x} Press to go on."]),
    ("<!DOCTYPE html><?xml version='1'?><p>{x} 5 < 6 stays.</p><p", ["{x} 5 < 6 stays."])])
def test_rest_of_the_page_stays(page, lines):
    assert html_text.main_text(page.replace("{x}", LINE)).split("\n") == [x.replace("{x}", LINE) for x in lines]


def test_long_pages_take_linear_time():
    start = time.perf_counter()
    many = "".join(f"<p>{LINE} {i}</p>" if i % 7 else f"<div><a href=x>link {i}</a></div>" for i in range(20_000))
    assert html_text.main_text(many).count("\n") > 15_000
    for junk in ("<a b'c ", '<a b="c ', "<svg>x ", "<!-- ", "</b <i = "):
        html_text.main_text(junk * 20_000)
    assert time.perf_counter() - start < 10


def test_minimum_cut_is_minimal():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(2, 9))
        lean = rng.integers(-9, 10, n).tolist()
        edges = {(i, j): int(rng.integers(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4}

        def cost(keep):
            return (sum(max(x, 0) for x, k in zip(lean, keep) if not k) + sum(max(-x, 0) for x, k in zip(lean, keep) if k)
                    + sum(c for (a, b), c in edges.items() if keep[a] != keep[b]))
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_text.minimum_cut(lean, edges)) == best


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


@pytest.mark.parametrize("text", ["a@b.c x@y z.z@q.w.e@r.t.", "@@a.b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 01.02.03.004",
                                  "4111 1111-1111 1111 and +1 (619) 555-0053, +12", "x@a..b y@-.-", "%@9.9"])
def test_base_patterns(text):
    spans = private_data.base_spans(text)
    assert [(a, b) for a, k, b in spans if k == 0] == [m.span() for m in EMAIL.finditer(text)]


def plain_spans(text):
    """The contract's patterns by plain searches, written apart from the operator."""
    def luhn(d):
        doubled = [x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(map(int, reversed(d)))]
        return sum(doubled) % 10 == 0
    n = {"email": len(list(EMAIL.finditer(text))), "ip": 0, "card": 0, "phone": 0}
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        n["ip"] += all(int(p) <= 255 for p in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        n["card"] += 12 <= len(d) <= 19 and luhn(d)
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        n["phone"] += 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15
    return n


@pytest.mark.parametrize("text", ["ip 0000000255.1.2.3 and 256.1.1.1 or 1.2.3.4.5.6.7.8", "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111",
                                  "+1 (619) 555-0053 +12 +123456789 +1234567890123456 +1..2..3..4..5..6..7..8..9", "12.34.56.78.90 1.2.3", "+49 30 1234567-8 a"])
def test_counts_against_plain_patterns(text):
    got = Counter(private_data.KINDS[k] for _, k, _ in private_data.base_spans(text))
    assert {k: got[k] for k in private_data.KINDS} == plain_spans(text)


def test_many_digits_take_linear_time():
    start = time.perf_counter()
    for text in ("1" * 200_000, "1." * 100_000, "1 " * 100_000, "+1" * 100_000, "a@" * 100_000):
        private_data.base_spans(text)
        starts = private_data.window_starts(text)
        tags = np.tile(np.arange(private_data.WIDTH) % 7 // 3, (len(starts), 1))
        private_data.reconciled(text, starts, tags, np.ones(tags.shape))
    assert time.perf_counter() - start < 20


def test_model_finds_rewritten_forms_in_unseen_texts(texts):
    rng = np.random.default_rng(77)
    learned = [t for k, t in texts.items() if k % 2 == 0 and private_data.TRIGGER.search(t)]
    unseen = [t for k, t in texts.items() if k % 2 and t and not private_data.TRIGGER.search(t)][:80]
    windows, tags = private_data.training_windows(learned)
    held = np.arange(len(windows)) % private_data.HELD_SHARE == 0
    parts = [([w for w, h in zip(windows, held) if h == side], [t for t, h in zip(tags, held) if h == side]) for side in (False, True)]
    model = private_data.fit(*parts[0])
    least = private_data.chosen_confidence(model, *parts[1])

    def number(mask):
        return re.sub("d", lambda _: str(rng.integers(0, 10)), mask)

    def found(text):
        starts = private_data.window_starts(text)
        if not starts:
            return []
        paths, sure = private_data.best_tags(model, [text[s:s + private_data.WIDTH] for s in starts])
        return [(a, k, b) for a, k, b, q in private_data.reconciled(text, starts, paths, sure) if q >= least]

    for mask in ("(ddd) ddd-dddd", "ddd.ddd.dddd", "ddd-ddd-dddd", "1-ddd-ddd-dddd"):
        hits = extra = 0
        for text in unseen:
            at, new = max(0, text.find(" ", len(text) // 3)), number(mask)
            spans = found(f"{text[:at]} {new} {text[at:]}")
            hits += (at + 1, 3, at + 1 + len(new)) in spans
            extra += len(spans) - ((at + 1, 3, at + 1 + len(new)) in spans)
        assert hits >= 0.9 * len(unseen) and extra <= 0.1 * hits, mask
    wrong = sum(len(found(f"{t[:50]} {number(m)} {t[50:]}")) for t in unseen for m in ("dddd-dd-dd", "dddd", "dd:dd", "ddd,ddd.dd", "dd.dd.dddd"))
    assert wrong <= 0.02 * 5 * len(unseen)


def test_private_data(spark, small, texts):
    rows = queries.QUERIES["op6_private_data"](spark, small).collect()
    for r in rows:
        base = ",".join(f"{private_data.KINDS[k]}:{a}:{b}" for a, k, b in private_data.base_spans(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))


def test_crf_marginals_and_learning():
    texts = [f"and the +1 ({300 + i}) 555-{1000 + 7 * i} of or 10.{i}.3.{i + 1} in that x{i}@mail{i}.org was" for i in range(60)]
    windows, tags = private_data.training_windows(texts)
    model = private_data.fit(windows, tags, steps=120)
    path, sure = private_data.best_tags(model, windows)
    assert (path == np.array(tags)).mean() > 0.95 and 0 <= sure.min() and sure.max() < 1 + 1e-6


def test_gradient_of_tagger():
    rng = np.random.default_rng(0)
    w = private_data.new_model(rng)
    ids = rng.integers(1, 98, (2, 9))
    tags = np.array([[0, 1, 2, 2, 0, 0, 3, 4, 0], [0] * 9])

    def loss(model):
        e = private_data.lstm(model, ids)[0] @ model["o"] + model["b"]
        a = model["a"] + private_data.barred()
        z = private_data.forward_backward(e, a)[0]
        gold = np.take_along_axis(e, tags[..., None], 2).sum((1, 2)) + a[tags[:, :-1], tags[:, 1:]].sum(1)
        return (z - gold).mean()
    g = private_data.gradients(w, ids, tags)
    for key, at in (("h", (0, 3, 5)), ("h", (1, 2, 80)), ("x", (0, ids[0, 2], 7)), ("o", (30, 1)), ("a", (1, 2)), ("b", (3,))):
        up, down = {k: v.copy() for k, v in w.items()}, {k: v.copy() for k, v in w.items()}
        up[key][at] += 1e-5
        down[key][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[key][at]) < 1e-4


def test_mix_keeps_shares_everywhere(spark, small):
    docs = table(spark, small, "documents")
    rows = mixing.mix(docs, block=64).orderBy("slot").collect()
    share = {r.source: r.target for r in mixing.targets(mixing.sized(docs)).collect()}
    total = sum(share.values())
    assert abs(sum(r.n_words for r in rows) / total - 1) < 0.01
    got, seen = Counter(), 0
    for r in rows:
        got[r.source] += r.n_words
        seen += r.n_words
        if seen > 20_000:
            assert all(abs(got[s] / seen - share[s] / total) < 0.03 for s in share)


def test_mix_has_rows_without_id_and_rows_that_repeat_an_id(spark):
    """Every row is taken exactly twice: weights that no source reaches leave both at their bound."""
    texts = [(None, "a b c", "s"), (None, "d e f", "s"), (None, "g", None), (None, None, "s"), (1, "h i", "s"), (1, "j k", "s"),
             (1, "l m n o", "s"), (2, "p", "t"), (2, "p", "t"), (3, "q r", "t")]
    docs = spark.createDataFrame([(k, t, "en", s) for k, t, s in texts], "doc_id bigint, text string, lang string, source string")
    rows = mixing.mixed_documents(docs, total_pct=1000).collect()
    want = Counter((k, t, s) for k, t, s in texts if t for _ in range(2))
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == want
    # a share of the words: each row as often as its taken words say, the last one in part
    words = sum(len(r.text.split()) for r in mixing.mixed_documents(docs).collect())
    assert words == sum(r.taken for r in mixing.taken(docs).collect()) > 0


def test_line_bitmaps_are_sparse(spark):
    line = "the very same line of text"
    docs = spark.createDataFrame([(i, "\n".join([f"own {i}"] * 70 + [line])) for i in range(4)], "doc_id bigint, text string")
    marks = {r.doc_id: r["_drops"] for r in line_dedup.drop_bitmaps(docs).collect()}
    assert marks == {i: {1: 1 << 6} for i in range(3)}


def test_rules_spare_clean_text():
    clean = "\n".join(f"On day {i} the {i}th boat{i} left{i}, as{i} ever{i} laden with{i} grain{i}." for i in range(9))
    junk = "\n".join(f"home{i} | about{i} | contact{i} | login{i}" for i in range(30))
    upper = re.compile(quality_rules.UPPER_RUN)
    assert quality_rules.judge_text(clean, upper)[8] and not quality_rules.judge_text(junk, upper)[8]


@pytest.mark.parametrize("phrase", quality_rules.BOILERPLATE + quality_rules.NAVIGATION)
def test_long_clean_lines_may_speak_of_boilerplate(phrase):
    upper = re.compile(quality_rules.UPPER_RUN)
    recipe = ", ".join(f"step {i} takes flour{i} and butter{i}" for i in range(60)) + f" as the {phrase} says."
    assert quality_rules.judge_text(recipe, upper)[6:9] == (0, 0, True)
    assert quality_rules.line_fails(f"Please accept our {phrase} here.", 7, upper)


@pytest.mark.parametrize("ids", ["sparse", "null", "same"])
def test_successors_of_any_ids(spark, monkeypatch, ids):
    monkeypatch.setattr(fingerprints, "ROWS", 20)
    keys = {"sparse": lambda i: (i * 0x9E3779B97F4A7C15) % (1 << 63), "null": lambda i: None if i % 3 else i, "same": lambda i: 7}[ids]
    rows = [(keys(i), f"text {i * 7919 % 1009} of many words it's {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = {(r.doc_id, r.text): r._next_text for r in fingerprints.with_next(docs).select("doc_id", "text", "_next_text").collect()}
    order = sorted(rows, key=lambda r: (-(1 << 62) if r[0] is None else r[0], r[1].encode()))
    assert got == {a: b[1] for a, b in zip(order, order[1:] + order[:1])}


def test_long_documents_do_not_meet_in_one_task(spark, monkeypatch):
    """All documents above half a sequence, and a few small ones: only as many long ones travel on as small ones fit beside."""
    seen = []
    round_ = packing.pack_round
    monkeypatch.setattr(packing, "pack_round", lambda items, number, slack, limit: (seen.append(items), round_(items, number, slack, limit))[1])
    docs = spark.createDataFrame([(i, "word " * (40 + i % 7)) for i in range(400)] + [(1000 + i, "a b c") for i in range(3)],
                                 "doc_id bigint, text string").repartition(6)
    rows = packing.pack(docs, limit=70, slack=2, fan_in=4).collect()
    lengths = Counter()
    for r in rows:
        lengths[r.sequence_id] += r.length
    sizes = [r.length for r in rows]
    assert len(rows) == 403 and max(lengths.values()) <= 70 and len(lengths) == sum(x > 35 for x in sizes)
    assert seen[-1].count() < 60


def test_joinable_bins():
    assert packing.joinable({4000: 5, 3000: 4, 2500: 2, 96: 1, 50: 2}, 4096) == {4000: 3, 3000: 3}
    assert packing.joinable({3000: 4, 2500: 9}, 4096) == {3000: 0, 2500: 0}
    assert packing.joinable({2000: 9}, 4096) == {} and packing.joinable({2000: 1, 2500: 1}, 4096) == {2000: 0, 2500: 0}


@pytest.mark.parametrize("start", [0x21, 0xc0, 0xdf])
def test_ids_of_single_words(start):
    """Every plain character, in words that the model sees alone, as the tokenizer has it; also after the memory started anew."""
    from tokenizers import Tokenizer
    path = packing.tokenizer_path()
    words, whole = packing.WordIds(path), Tokenizer.from_file(path)
    for text in ["".join(chr(c) for c in range(start, min(start + 90, 256)) if c not in (0xd7, 0xf7)), "Größe ñandú ÀÉ'Ve x''s 1a2 $%&", "zz"]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        words.clear()


def test_packing_has_one_worker_in_a_task(spark, monkeypatch):
    """No stage tokenises in one worker and packs in another: both held their memory at once."""
    plans = []
    keep = packing.materialise
    monkeypatch.setattr(packing, "materialise", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df, label))[1])
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id bigint, text string").repartition(3)
    assert len(packing.pack(docs, limit=64).collect()) == 50
    assert plans and max(p.count("MapInArrow") for p in plans) == 1
