"""Each stage of the corpus pipeline against a brute-force version, on its own input."""

from collections import Counter

import corpus_pipeline
from browsekit.llm import mixing
from browsekit.session import materialize

from .cases import empty_docs
from .test_lines import brute as brute_lines
from .test_near import brute_classes
from .test_repetition import brute as brute_rules

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], SF)))
    raw, ruled, cleaned, single, mixed, packed = [x.collect() for x in seen]
    assert all(x.columns == docs.columns for x in seen[:-1])

    assert Counter(ruled) == Counter(r for r in raw if brute_rules(r["text"])[-1])
    want = brute_lines([(r["doc_id"], r["text"], r["source"]) for r in ruled], 10)
    assert Counter((i, t) for i, _, _, t in want) == Counter((r["doc_id"], r["text"]) for r in cleaned)
    groups = brute_classes([(r["doc_id"], r["text"]) for r in cleaned])
    assert {r["doc_id"] for r in single} == {min(cleaned[i]["doc_id"] for i in g) for g in groups}
    assert set(single) <= set(cleaned)
    p = {r["_row"]["doc_id"]: r["_kept"] for r in mixing.mixing_probabilities(seen[3]).collect()}
    assert Counter(mixed) == Counter(r for r in single if p[r["doc_id"]])
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed}
    whole = {}
    for r in packed:
        whole.setdefault(r["doc_id"], [r["doc_tokens"], 0])[1] += r["length"]
    assert all(a == b for a, b in whole.values())


def test_empty(spark):
    docs = empty_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0


def test_run_is_the_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "pack"]
    assert corpus_pipeline.run(spark, SF).count() > 0
