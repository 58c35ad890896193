from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from browsekit.llm import mixing

from .cases import clashing, empty_docs, odd_docs


def test_rake_meets_reachable_margins():
    r = np.random.default_rng(1)
    cells = [(s, l, t) for s in "abcd" for l in "xyz" for t in "pq"]
    tokens = r.integers(500, 2000, len(cells))
    targets = [{"a": 0.3, "b": 0.3, "c": 0.2, "d": 0.2}, {"x": 0.5, "y": 0.3, "z": 0.2}, {"p": 0.6, "q": 0.4}]
    p = mixing.rake(tokens, cells, targets, keep=0.4)
    assert (p >= 0).all() and (p <= 1).all()
    mass = p * tokens
    assert abs(mass.sum() / tokens.sum() - 0.4) < 1e-6
    for j, target in enumerate(targets):
        for v, share in target.items():
            got = sum(m for m, c in zip(mass, cells) if c[j] == v) / mass.sum()
            assert abs(got - share) < 1e-6


def test_unlisted_values_keep_their_share_and_caps_hold():
    p = mixing.rake([90, 10], [("a", "x", "p"), ("other", "x", "p")], [{"a": 0.9}, {"x": 1.0}, {"p": 1.0}], keep=0.5)
    assert np.allclose(p, [0.5, 0.5])
    p = mixing.rake([99, 1], [("a", "x", "p"), ("b", "x", "p")], [{"a": 0.5, "b": 0.5}, {}, {}], keep=0.5)
    assert p[1] == 1 and 0 < p[0] < 1
    assert len(mixing.rake([], [], [{}, {}, {}])) == 0
    assert mixing.rake([0, 0], [("a", "x", "p"), ("b", "x", "p")], [{}, {}, {}]).tolist() == [0, 0]


def test_sample_follows_the_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.mixing_probabilities(docs).select("_row.doc_id", "_cell_lang", "_tokens", "_p", "_kept").collect()
    assert len(rows) == docs.count() and all(0 <= r["_p"] <= 1 for r in rows)
    kept = [r for r in rows if r["_kept"]]
    tokens = sum(r["_tokens"] for r in kept)
    assert abs(tokens / sum(r["_tokens"] for r in rows) - mixing.KEEP) < 0.05
    by = defaultdict(int)
    for r in kept:
        by[r["_cell_lang"]] += r["_tokens"]
    for lang, share in mixing.LANGUAGES.items():
        assert abs(by[lang] / tokens - share) < 0.05


def test_odd_rows_and_clashing_names(spark):
    docs = clashing(odd_docs(spark))
    out = mixing.mixing_probabilities(docs, sources={"a": 0.5, "b": 0.5})
    assert out.count() == docs.count()
    assert {r["_cell_source"] for r in out.collect()} == {"a", "b", "other"}
    kept = mixing.sample_to_targets(docs, sources={"a": 0.5, "b": 0.5})
    assert kept.columns == docs.columns
    every = Counter(map(str, docs.collect()))
    assert all(every[k] == n for k, n in Counter(map(str, kept.collect())).items())     # repeats stand or fall together
    assert mixing.sample_to_targets(empty_docs(spark)).count() == 0


def test_targets_from_a_table(spark):
    docs = spark.createDataFrame(
        [(i, "x" * 400, "web" if i % 4 else "books", "xx", "law" if i % 3 else "art") for i in range(4000)],
        "doc_id long, text string, source string, lang string, topic string")
    table = spark.createDataFrame(
        [("sources", "web", 1.0, 0), ("sources", "books", 1.0, 0), ("topics", "law", 3.0, 0), ("topics", "art", 2.0, 0)],
        "margin string, value string, share double, extra int")
    targets = mixing.read_targets(table)
    assert targets == {"sources": {"web": 1.0, "books": 1.0}, "languages": {}, "topics": {"law": 3.0, "art": 2.0}}
    got = mixing.mixing_probabilities(docs, topic=F.col("topic"), keep=0.3, **targets).withColumn("m", F.col("_p") * F.col("_tokens"))
    for margin, want in (("_cell_source", {"web": 0.5, "books": 0.5}), ("_cell_lang", {"other": 1.0}),
                         ("_cell_topic", {"law": 0.6, "art": 0.4})):
        mass = {r[0]: r[1] for r in got.groupBy(margin).agg(F.sum("m")).collect()}
        total = sum(mass.values())
        assert abs(total - 0.3 * 4000 * 100) < 1
        assert mass.keys() == want.keys() and all(abs(mass[k] / total - want[k]) < 1e-6 for k in want)


@pytest.mark.parametrize("rows", [
    [("owner", "a", 1.0)], [("sources", None, 1.0)], [("sources", "a", None)], [("sources", "a", -1.0)],
    [("sources", "a", float("nan"))], [("sources", "a", 1.0), ("sources", "a", 2.0)], [(None, "a", 1.0)],
    [("topics", str(i), 1.0) for i in range(6)]])
def test_targets_that_are_none(spark, rows):
    with pytest.raises(ValueError):
        mixing.read_targets(spark.createDataFrame(rows, "margin string, value string, share double"), limit=5)


def test_an_empty_target_table(spark):
    targets = mixing.read_targets(spark.createDataFrame([], "margin string, value string, share double"))
    assert targets == {"sources": {}, "languages": {}, "topics": {}}
