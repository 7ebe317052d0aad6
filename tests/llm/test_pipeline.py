"""The pipeline's stages against brute force on the smallest tables, each on its own input."""

import re
from collections import Counter

import corpus_pipeline
from equisite.llm import quality_rules
from equisite.plans.session import materialise
from tests.llm.test_operators import WORDS, brute_classes


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialise(stage(spark, kept[-1], small), name))
    rows = [{r.doc_id: r for r in k.collect()} for k in kept[:4]]
    upper = re.compile(quality_rules.UPPER_RUN)
    judged = {k: quality_rules.judge_text(r.text, upper) for k, r in rows[0].items()}
    assert {k: r.text for k, r in rows[1].items()} == {k: "\n".join(j[9]) for k, j in judged.items() if j[8]}
    holders = {}
    for k, r in rows[1].items():
        for key in {x.strip(" \t\n\v\f\r").lower() for x in r.text.split("\n")}:
            holders.setdefault(key, set()).add(k)
    for k, r in rows[1].items():
        lines = [x for x in r.text.split("\n") for y in [holders[x.strip(" \t\n\v\f\r").lower()]]
                 if len(x.strip(" \t\n\v\f\r")) < 20 or len(y) < 3 or max(y) == k]
        assert rows[2][k].text == "\n".join(lines) and rows[2][k].n_chars == len(rows[2][k].text)
    classes = brute_classes({k: r.text for k, r in rows[2].items()})
    assert set(rows[3]) == {k for k, (head, _) in classes.items() if head == k}
    sizes = Counter()
    for r in rows[3].values():
        sizes[r.source] += len(WORDS.findall(r.text))
    mixed = kept[4].collect()
    assert abs(sum(len(WORDS.findall(r.text)) for r in mixed) / (1.5 * sum(sizes.values())) - 1) < 0.01
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    packed = kept[5].collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mixed)
