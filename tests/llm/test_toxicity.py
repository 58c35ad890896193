import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from browsekit.llm import toxicity
from browsekit.llm.text import slices

from .cases import clashing, empty_docs, odd_docs

SF = "/root/testdata/sf0.1"


def classes_of(text):
    points = np.array([ord(c) for c in text], dtype=np.uint32)
    return toxicity.char_classes(points, toxicity.kinds()[points]).tolist() if text else []


def brute_trigrams(text):
    """Trigrams of the words of a text, each word between breaks."""
    out = Counter()
    words, now = [], []
    for c in [*classes_of(text.lower()), 0]:
        if c:
            now.append(c)
        elif now:
            words.append(now)
            now = []
    for w in words:
        chain = [0, 0, *w, 0]
        out.update(zip(chain, chain[1:], chain[2:]))
    return out


@pytest.fixture(scope="module")
def chars(spark):
    return toxicity.char_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_trigram_counts_are_those_of_all_texts(spark):
    docs = odd_docs(spark)
    want = Counter()
    for r in docs.collect():
        want += brute_trigrams(r["text"] or "")
    counts = np.zeros((64, 64, 64))
    for (a, b, c), n in want.items():
        counts[a, b, c] = n
    assert np.allclose(toxicity.char_model(docs), toxicity.log_probabilities(counts), atol=1e-5)
    model = toxicity.log_probabilities(counts)
    assert np.allclose(np.exp(model).sum(axis=2), 1, atol=1e-4)


def path_price(chosen, model):
    text = " " + "".join(t for t, _ in chosen)
    c = [0, *classes_of(text), 0]
    price = sum(p for _, p in chosen)
    return price + sum(model[0 if c[i - 1] == 0 else c[i - 2], c[i - 1], c[i]] for i in range(2, len(c)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["1d10t", "f*ol", "l0s3rr", "i d i 0 t", "s.c.u.m", "mooooron", "tr@sh!!", "a1b", "éé9é", "x  y z", "4", "a b c"]),
                min_size=1, max_size=5), st.integers(0, 2**32 - 1))
def test_viterbi_finds_the_best_path(stretches, seed):
    counts = np.random.default_rng(seed).integers(0, 6, (64, 64, 64)).astype(float) ** 3
    model = toxicity.log_probabilities(counts)
    lattices = [toxicity.lattice(s) for s in stretches]
    for x, text in zip(lattices, toxicity.viterbi(lattices, model)):
        prices = {}
        for chosen in itertools.product(*x):
            read = "".join(t for t, _ in chosen)
            prices[read] = max(prices.get(read, -math.inf), path_price(chosen, model))
        assert prices[text] == pytest.approx(max(prices.values()), abs=1e-3)


def restore(texts, model):
    r = toxicity.Restorer(model)
    return [t for _, part in slices(pa.array(texts, type=pa.string())) for t in r.restore(part)]


def test_hidden_words_are_restored(spark):
    words = ["idiot", "moron", "loser", "stupid", "trash", "scum"]
    docs = spark.createDataFrame([(" ".join(words[(i + j) % 6] for j in range(40)),) for i in range(50)], "text string")
    model = toxicity.char_model(docs)
    hidden = ["1d10t", "i d i o t", "m00000ron", "l.o.s.e.r", "st*pid", "tr@$h!!", "s-c-u-m", "5cum", "l 0 s 3 r"]
    plain = ["idiot", "idiot", "moron", "loser", "stupid", "trash", "scum", "scum", "loser"]
    assert [t.strip() for t in restore(hidden, model)] == plain
    # what is not suspicious stays as it is, in lower case
    clean = ["The Trash, and 123 at 10:30!", "", "call 555-1234 NOW!!", "well-known a b", "coffee ß É"]
    assert restore(clean, model) == [t.lower() for t in clean]
    # stretches do not cross texts, and each text is read by itself whatever its neighbours
    assert restore(["a b", "c d"], model) == ["a b", "c d"]
    many = hidden * 3 + clean
    assert restore(many, model) == [restore([t], model)[0] for t in many]


def test_long_stretches(chars):
    long = "a1" * 50_000
    got = restore([long, "x y " * 30_000, "z" * 1_000_000, "0" * 1_000_000 + "a"], chars)
    assert len(got[0]) >= 50_000 and set(got[2]) == {"z"} and len(got[2]) <= 2 and len(got[3]) <= 3
    assert got[1].replace(" ", "").startswith("xyxyxy")


def test_word_runs_are_all_runs_within_words():
    x = toxicity.WordRuns(["Ab cdefghijk ab", "", "ab é"], toxicity.kinds())
    words = 5
    assert len(x.doc) == words and x.doc.tolist() == [0, 0, 0, 2, 2] and x.n == 4
    runs = Counter(x.word.tolist())
    sizes = Counter()
    for word, place in (("Ab", 0), ("cdefghijk", 1), ("ab", 2), ("é", 4)):
        marked = len(word) + 2
        sizes[int(x.which[place])] = sum(max(0, marked - n + 1) for n in toxicity.RUNS) + (marked > 8)
    assert runs == +sizes


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.82 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    # the same words, hidden, in texts the model never saw
    plain = [r["text"] for r in docs.join(labels.where("toxic = 0 and quality = 1"), "doc_id").where("lang = 'en' and n_chars < 900")
             .where(toxicity.fold_of(F.col("doc_id"), 5) == 0).orderBy("doc_id").limit(20).collect()]
    loud = [t + " you pathetic idiot and worthless moron" for t in plain]
    hidden = [t + " you p4th3t1c 1d10t and w0rthl3$$ m o r o n" for t in plain]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(plain + loud + hidden)], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(texts, model).collect()}
    found = [sum(got[i] for i in range(a, a + 20)) for a in (0, 20, 40)]
    assert found[0] <= 1 and found[1:] == [20, 20]


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.fold_of(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit_toxicity(d, x) for d, x in ((docs, labels), (docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")), flipped)))
    assert a.curve == b.curve and np.array_equal(a.runs, b.runs) and np.array_equal(a.weight, b.weight) and np.array_equal(a.chars, b.chars)
    for x in (odd_docs(spark), clashing(odd_docs(spark))):
        rows = toxicity.score_toxicity(x, a).collect()
        assert len(rows) == x.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] == 7}) == 1
        assert {r["doc_id"]: r["score"] for r in rows}[1] == {r["doc_id"]: r["score"] for r in rows}[2]
    assert toxicity.score_toxicity(empty_docs(spark), a).count() == 0


def test_without_labels(spark):
    docs = clashing(odd_docs(spark))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for d in (docs, empty_docs(spark)):
        model = toxicity.fit_toxicity(d, none)
        assert {r["score"] for r in toxicity.score_toxicity(docs, model).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1), (1, None), (4, 1), (4, 0), (5, 7), (9, 0)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, odd)).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
