import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from browsekit.llm import importance
from browsekit.llm.text import slices

from .cases import SCHEMA, clashing, empty_docs, odd_docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, buckets=10_000, longest=1):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
                        for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, buckets=10_000, longest=1, min_words=20, percent=10):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text, buckets, longest)[1])
    for text in target:
        t.update(features(text, buckets, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    out = []
    for i, text in rows:
        n, f = features(text, buckets, longest)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words, None])
    fit = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for rank, x in enumerate(fit[: percent * len(fit) // 100], 1):
        x[5] = rank
    return Counter((i, n, w, score, rank) for i, n, w, score, _, rank in out)


def check(docs, target, **parameters):
    got = importance.resample(docs, target, **parameters)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    parameters.pop("seed", None)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, [r["text"] for r in target.select("text").collect()], **parameters)
    assert Counter(tuple(r) for r in got.collect()) == want
    return want


def test_whole_table(spark):
    docs, target = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    want = check(docs, target)
    assert sum(1 for x in want if x[4]) > 50


def test_twin(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = Counter(con.sql(importance.resample_sql()).fetchall())
    got = importance.resample(*(spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark")))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_odd_rows_and_clashing_names(spark):
    target = spark.createDataFrame([(prose(2, 100),), (None,), ("",), ("né one",)], "text string")
    for docs in (odd_docs(spark), clashing(odd_docs(spark))):
        check(docs, clashing(target), percent=50)
        check(docs, target, longest=3, buckets=97, min_words=1, percent=100)
    check(odd_docs(spark), target.limit(0))
    assert importance.resample(empty_docs(spark), target).count() == 0


def test_ties_go_to_the_smaller_id_and_repeated_rows_are_ranked(spark):
    rows = [(i % 7, prose(3, 30), "en", "a", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = importance.resample(docs, docs.limit(0), percent=100).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 61))
    assert [(-r["score"], r["doc_id"]) for r in got] == sorted((-r["score"], r["doc_id"]) for r in got)


def test_drawn_rows_keep_their_columns(spark):
    docs = clashing(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    out = importance.draw(docs, target)
    ranked = importance.resample(docs, target).where("rank is not null").collect()
    assert out.dtypes == docs.dtypes and {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in ranked}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(1 << 40), 1 << 40), min_size=1, max_size=200), st.data())
def test_bit_planes_sum_exactly(gains, data):
    n = data.draw(st.integers(1, 5))
    f = data.draw(st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, len(gains) - 1)), max_size=300))
    doc, bucket = (np.array([x[i] for x in f], dtype=np.int64) for i in (0, 1))
    got = importance.weights_of(doc, bucket, n, importance.gain_planes(gains), len(gains))
    assert got.tolist() == [sum(gains[b] for d, b in f if d == i) for i in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é9.\t日", max_size=200), max_size=6), st.integers(1, 3))
def test_buckets_are_crc32_of_the_features(texts, longest):
    word, crc = importance._word_bytes(), importance._crc_table()
    got = []
    for at, part in slices(pa.array(texts, type=pa.string())):
        f = importance.Features(part, word, crc, 10_000, longest)
        got += list(zip((f.doc + at).tolist(), f.bucket.tolist()))
    assert Counter(got) == Counter((i, b) for i, t in enumerate(texts) for b in features(t, 10_000, longest)[1])


def test_very_long_words_and_texts():
    texts = ["x" * 100_000 + " y", "ab " * 400_000]
    word, crc = importance._word_bytes(), importance._crc_table()
    for at, part in slices(pa.array(texts)):
        f = importance.Features(part, word, crc, 10_000, 1)
        for i in range(part.n):
            assert f.bucket[f.doc == i].tolist() == features(texts[at + i])[1]


def test_gains_follow_the_counts():
    assert importance.bucket_gains(np.array([0, 3, 10]), np.array([0, 5, 0])) == [
        math.floor(1000 * math.log((t + 1) * 16.0 / ((s + 1) * 8.0))) for s, t in ((0, 0), (3, 5), (10, 0))]
