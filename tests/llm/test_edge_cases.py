"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from equisite.llm import (chosen_path, fingerprints, html_text, language, line_dedup, mixing, packing, private_data,
                          quality_classifier, quality_rules, queries)
from suite import check

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, _h1 string, _pos int, _s int, "
          "sid string, node int, size int, members string, slot int, label string, held_out string, taken int")
LONG = " ".join(f"word{i % 997} and {i % 13}." for i in range(60_000))
LINE = "this line is in several of the texts"
TEXTS = [(1, None), (2, ""), (3, "\n\n"), (4, "one"), (5, LINE), (6, f"{LINE}\n  {LINE.upper()} "), (7, LONG), (7, LONG),
         (8, LINE), (8, LINE), (None, "no id here, but " * 20), (None, None), (9, "été \U0001d400 ﬁ 12 a@b.cd 10.0.0.1 " * 30),
         (10, "!!! *** ||| " * 60), (11, "a b c d e f g h i j " * 30), (12, "a b c d e f g h i j " * 30),
         (13, "\n".join(f"On day {i} the {i}th boat{i} left{i}, as{i} ever{i} laden with{i} grain{i}." for i in range(9)))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", None, "x", 1, 2, "y", 3, 4, "z", 5, "l", "h", 6)
            for i, (k, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, None, None, 0), (2, "u", "", 0), (2, "u", "", 0), (None, "v", "<p>" + LONG, 0), (3, "w", "<b><i" * 2000, 0)],
                                 "page_id bigint, url string, html string, text int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, None, "x") for i in range(1, 14)] + [(None, 1, 0, ""), (4, None, 0, "")],
                                 "doc_id bigint, quality int, toxic int, text string")


ROW_WISE = {"quality": quality_rules.quality, "lines": line_dedup.deduplicated, "language": language.identify, "join": chosen_path.join,
            "private": private_data.find, "fingerprints": fingerprints.edited, "mix": mixing.taken}


@pytest.mark.parametrize("name", list(ROW_WISE))
def test_every_row_comes_back(spark, docs, name):
    fn = ROW_WISE[name]
    rows = fn(docs).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(k) for k, _ in TEXTS)
    by_id = {}
    for r in rows:
        if r.doc_id in (7, 8) and name not in ("fingerprints", "mix"):
            assert by_id.setdefault(r.doc_id, r) == r  # equal rows, equal results
    assert fn(docs.limit(0)).collect() == []


def test_defined_values(docs):
    quality = {r.doc_id: r for r in quality_rules.quality(docs).collect()}
    assert quality[1].n_words == 0 and quality[1].base_failed and not quality[2].kept and not quality[10].kept
    lines = {r.doc_id: r for r in line_dedup.deduplicated(docs).collect()}
    assert (lines[1].n_lines, lines[3].n_lines, lines[5].n_dropped, lines[6].n_dropped, lines[8].n_dropped) == (1, 3, 1, 2, 0)
    langs = {r.doc_id: r for r in language.identify(docs).collect()}
    assert {langs[k].lang_pred for k in (1, 2, 3, 10)} == {"und"} and langs[9].lang_pred == "en"
    joined = {r.doc_id: r for r in chosen_path.join(docs).collect()}
    assert joined[12].class_id == 11 and joined[7].n_links == 1 and joined[1].n_links == 0 and joined[8].class_id == 5
    spans = {r.doc_id: r for r in private_data.find(docs).collect()}
    assert spans[9].n_email == 30 and spans[9].n_ip == 30 and spans[1].spans == ""
    prints = {r.doc_id: r for r in fingerprints.edited(docs).collect()}
    assert prints[1].fingerprint == "" and prints[11].fingerprint == prints[12].fingerprint and prints[11].near_next == 1.0
    mixed = {r.doc_id: r for r in mixing.taken(docs).collect()}
    assert mixed[2].taken == 0 and all(r.taken <= 2 * r.size for r in mixed.values())


def test_packing(docs):
    rows = packing.pack(docs).collect()
    heads = [r for r in rows if r.piece == 0]
    assert sorted(str(r.doc_id) for r in heads) == sorted(str(k) for k, _ in TEXTS)
    assert {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert packing.pack(docs.limit(0)).collect() == []


def test_classifier(docs, labels):
    rows = quality_classifier.classify(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    none = quality_classifier.classify(docs, labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
    assert quality_classifier.classify(docs.limit(0), labels).collect() == []


def test_pages(pages):
    rows = html_text.extract(pages).collect()
    assert len(rows) == 5 and sorted(r.n_chars for r in rows)[:3] == [0, 0, 0] and max(r.n_chars for r in rows) == len(LONG)
    assert html_text.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, docs, stage):
    out = stage(spark, docs, "")
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert out.count() > 0 and stage(spark, docs.limit(0), "").count() == 0


def sets(text):
    words = [w for w in re.split(r"[ \t-\r]+", text or "") if w]
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_classes(rows):
    """Brute force over rows: (links, number of the class's first row) per row."""
    of = [sets(t) for _, t, *_ in rows]
    linked = [[j for j in range(len(rows)) if j != i and of[i] and 5 * len(of[i] & of[j]) >= 4 * len(of[i] | of[j])] for i in range(len(rows))]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in [i, *linked[i]]) for i in range(len(rows))]
    return [len(x) for x in linked], label


def prose(seed, words=60):
    return " ".join(f"w{(seed * 7919 + i * 104729) % 9973}" for i in range(words))


IDS = [(3, prose(1)), (5, prose(1) + " more"), (5, prose(2)), (None, prose(3)), (None, prose(3) + " x"), (7, prose(4)), (None, "y " + prose(4)),
       (8, prose(5)), (8, prose(5)), (8, prose(5) + " z"), (None, None), (None, None), (9, ""), (9, None), (10, prose(6)), (None, prose(6)),
       (None, prose(7)), (None, prose(7)), (11, "one two"), (12, "one  two"), (13, "one two three")]


def test_near_rows_with_null_and_repeated_ids(spark):
    rows = [(k, t, "en", f"s{i % 3}", len(t or "")) for i, (k, t) in enumerate(IDS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    links, label = near_classes(rows)
    least = {c: min((k for (k, *_), x in zip(rows, label) if x == c and k is not None), default=None) for c in set(label)}
    got = chosen_path.join(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == Counter((k, least[c], n) for (k, *_), c, n in zip(rows, label, links))
    kept = [tuple(r) for r in chosen_path.one_of_each(docs).collect()]
    assert not Counter(kept) - Counter(rows) and len(kept) == len(set(label))
    of_class = Counter(label[next(i for i, r in enumerate(rows) if r[:2] == k[:2])] for k in kept if sets(k[1]))
    assert set(of_class.values()) == {1} and set(of_class) == {c for c, r in zip(label, rows) if sets(r[1])}
    assert {k for k, *_ in kept if k} == {least[c] for c in set(label)} - {None}


LINES = [(1, f"{LINE}\nown one"), (1, f"another own line that is long\nx\n{LINE} b"), (2, LINE), (3, f"{LINE}\n{LINE} b"), (None, f"{LINE}\nnull {LINE}"),
         (None, f"{LINE} b\nanother own line that is long"), (None, None), (4, ""), (5, f"{LINE}\n{LINE}"), (5, f"{LINE}\n{LINE}"), (2, f"null {LINE}"),
         (9, f"null {LINE}\r"), (9, f"x\n  {LINE.upper()}\t\n"), (9, None), (-1, f"null {LINE}")]


def test_lines_of_null_and_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in LINES], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert check.compare(spark, con, str(tmp_path), queries.QUERIES["op7_line_dedup"], line_dedup.oracle_sql()) == f"ok {len(LINES)}"
    least = -1 << 62

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    held = defaultdict(set)
    for k, t in LINES:
        for line in (t or "").split("\n"):
            held[key(line)].add(least if k is None else k)
    gone = {x: max(v) for x, v in held.items() if len(x) >= 20 and len(v) >= 3}
    want = [(k, "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), k or (least if k is None else k)) == (least if k is None else k)))
            for k, t in LINES]
    assert Counter((r.doc_id, r.text) for r in line_dedup.cleaned(docs).collect()) == Counter(want)


def test_line_order_is_read(spark, docs):
    plan = line_dedup.runs_of(line_dedup.hashed_lines(docs))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("Sort") < plan.index("rangepartitioning")
