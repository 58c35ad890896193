import hashlib
import re
from collections import Counter

import pytest

from browsekit.llm import substring

from .cases import clashing, empty_docs, odd_docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    times = Counter(tuple(w[j:j + length]) for _, w in texts for j in range(len(w) - length + 1))
    out = Counter()
    for i, w in texts:
        gone = [False] * len(w)
        for j in range(len(w) - length + 1):
            if times[tuple(w[j:j + length])] > 1:
                gone[j:j + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def check(docs, length=35, seed=16):
    got = substring.remove_repeats(docs, length=length, seed=seed)
    got = Counter(tuple(r) for r in got.collect())
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], length)


def test_odd_rows_and_clashing_names(spark):
    check(odd_docs(spark))
    check(clashing(odd_docs(spark)))
    check(empty_docs(spark))


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.mark.parametrize("length,seed", [(5, 1), (7, 7), (12, 5)])
def test_passages_with_shifting_neighbours(spark, length, seed):
    words = prose(9, 60).split()
    rows = [(i, " ".join(prose(100 + i, i).split() + words[i % 7: 40 - i % 11] + prose(200 + i, 9).split()))
            for i in range(30)]
    rows += [(50, "la " * 70), (51, " ".join(["la"] * length)), (52, "la lo " * 40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), length, seed)


def test_kept_text_and_spans(spark):
    docs = odd_docs(spark)
    for r in substring.remove_repeats(docs, with_text=True).collect():
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]
    two = spark.createDataFrame([(1, prose(1, 50) + " " + prose(2, 60)), (2, prose(3, 20) + " " + prose(2, 60))],
                                "doc_id long, text string")
    assert sorted((r["first_word"], r["n_words"]) for r in substring.repeat_spans(two).collect()) == [(20, 60), (50, 60)]
