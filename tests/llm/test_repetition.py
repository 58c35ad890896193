import re
from collections import Counter

from browsekit.llm import repetition

from .cases import clashing, empty_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, limits=repetition.NGRAM_LIMITS, line_limit=repetition.LINE_LIMIT):
    text = text or ""
    words = WORD.findall(text)

    def covered(n):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        many = Counter(grams)
        out = [False] * len(words)
        for i, g in enumerate(grams):
            if many[g] > 1:
                out[i:i + n] = [True] * n
        return out

    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), []
    for x in lines:
        if x in seen:
            dup.append(x)
        seen.add(x)
    chars = sum(map(len, words))
    rep = sum(covered(8))
    base_failed = len(words) < 20 or 100 * rep > 30 * len(words)
    fails = any(sum(len(w) for w, c in zip(words, covered(n)) if c) > lim * chars for n, lim in limits.items())
    fails |= sum(map(len, dup)) > line_limit * sum(map(len, lines))
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), len(dup), rep, base_failed,
            not base_failed and not fails)


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def check(docs):
    got = Counter((r["doc_id"], *(r[c] for c in COLS)) for r in repetition.repetition_stats(docs).collect())
    want = Counter((r["doc_id"], *brute(r["text"])) for r in docs.select("doc_id", "text").collect())
    assert got == want


def test_odd_rows_and_clashing_names(spark):
    check(odd_docs(spark))
    check(clashing(odd_docs(spark)))
    check(empty_docs(spark))


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_filter_keeps_rows_whole(spark):
    docs = clashing(odd_docs(spark))
    got = Counter(map(tuple, repetition.drop_repetitive(docs).collect()))
    want = Counter(tuple(r) for r in docs.collect() if brute(r["text"])[-1])
    assert got == want
    assert repetition.drop_repetitive(empty_docs(spark)).columns == empty_docs(spark).columns


def test_good_documents_stay_and_repetitive_ones_go(spark):
    d = "/root/testdata/sf0.01"
    kept = repetition.repetition_stats(spark.read.parquet(f"{d}/documents.parquet")).select("doc_id", "kept", "n_words")
    rows = kept.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("quality = 1 and n_words >= 20").collect()
    assert sum(r["kept"] for r in rows) >= 0.98 * len(rows)
