import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from browsekit.llm import phrases

from .cases import SCHEMA, clashing, empty_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_words=2, max_words=3, min_count=10, cover=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, max_words + 1):
                f.update((lang, *w[i:i + size]) for i in range(len(w) - size + 1))
    found = {p: a for p, a in f.items() if len(p) - 1 >= min_words and a >= min_count}
    inside = {}
    for p, a in found.items():
        for size in range(min_words, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                q = (p[0], *p[i:i + size])
                inside[q] = max(inside.get(q, 0), a)
    out = {}
    for p, a in found.items():
        if 100 * inside.get(p, 0) >= cover * a:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            l, r = f[p[:k + 1]], f[(p[0], *p[k + 1:])]
            cuts.append((10**6 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), l, r))
    return Counter((lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
                   for lang, x in out.items() for rank, (score, a, phrase, l, r) in enumerate(sorted(x)[:top], 1))


def check(docs, **parameters):
    got = phrases.collocations(docs, **parameters)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    parameters.pop("group", None)
    want = brute([(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()], **parameters)
    assert Counter(tuple(r) for r in got.collect()) == want
    return want


def test_whole_table(spark):
    assert len(check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))) > 50
    assert len(check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), max_words=5, min_count=4, cover=80, top=40, group=500)) > 50


def test_twin(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = Counter(con.sql(phrases.collocations_sql()).fetchall())
    got = phrases.collocations(spark.read.parquet(f"{d}/documents.parquet"))
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 1000


def test_odd_rows_and_clashing_names(spark):
    for docs in (odd_docs(spark), clashing(odd_docs(spark))):
        check(docs, min_count=2, top=30)
    assert phrases.collocations(empty_docs(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None, None), (2, " ,.\t", "en", None, None)], SCHEMA)
    assert phrases.collocations(nothing).count() == 0


def test_hot_phrase_and_hot_leading_word(spark):
    """A third of all words begin one phrase; it is merged as its rows arrive."""
    rows = [(i, f"the end of part{i % 40} the end, the same thing again: the end" if i % 3 else f"of word{i % 9} the part{i}", "en", "a", 1)
            for i in range(900)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(12)
    check(docs, group=50)


def test_words_that_share_a_key_are_counted_apart(spark, monkeypatch):
    """Under the first seed words of the same letters have one key: counting starts again."""
    monkeypatch.setattr(phrases, "_MULTIPLIERS", [1, *phrases._MULTIPLIERS[1:]])     # a plain sum of letters
    rows = [(i, "stop the pots and spot the tops", "en", "a", 1) for i in range(12)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_scores_past_64_bits(spark):
    """a * a * 10**6 of the formula as decimals: exact far beyond 64 bits."""
    a, l, r = 3 * 10**14 + 7, 3 * 10**14 + 11, 4 * 10**14 + 13
    x = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    got = x.select(phrases.score_of("a", "l", "r").alias("s")).first()["s"]
    assert got == 10**6 * a * a // (l * r)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 2), st.integers(1, 5)), max_size=400),
       st.integers(1, 12), st.sampled_from([1, 3, 50, 4096]))
def test_equal_partitions_are_counts(rows, least, leaf):
    before, phrases.LEAF = phrases.LEAF, leaf
    try:
        keys = [np.array([r[d] for r in rows], dtype=np.uint64) for d in range(3)]
        size = np.array([r[3] for r in rows], dtype=np.int64)
        at, total = phrases.equal_partitions(keys, size, least)
    finally:
        phrases.LEAF = before
    want = Counter()
    for a, b, c, n in rows:
        want[a, b, c] += n
    got = [(tuple(int(k[i]) for k in keys), int(n)) for i, n in zip(at, total)]
    assert len(got) == len(set(got)) and dict(got) == {k: n for k, n in want.items() if n >= least}


def test_no_phrase_without_a_key_is_lost_by_the_filter(spark, monkeypatch):
    """A filter of so few bits that nearly everything passes changes no count."""
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 15)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60), min_count=3)


def test_long_text_is_one_stretch(spark):
    text = " ".join(f"w{i % 50} x{i % 7}" for i in range(300_000))
    check(spark.createDataFrame([(1, text, "en", "a", 1)], SCHEMA), top=20)


@pytest.mark.parametrize("text", ["a b", "a,b", "a\tb", "a b", "A b.a B"])
def test_pieces_and_words(spark, text):
    check(spark.createDataFrame([(i, text, "en", "a", 1) for i in range(10)], SCHEMA))
