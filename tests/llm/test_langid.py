import zlib

import numpy as np
from pyspark.sql import functions as F

from browsekit.llm import langid

from .cases import SCHEMA, clashing, empty_docs, odd_docs

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    net = langid.BiGRU(3, hidden=4, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(2)
    words, y = r.integers(97, 101, (6, 5)).astype(np.uint8), r.integers(0, 3, 6)
    _, g = net.gradients(words, y)
    for key, value in net.p.items():
        used = [(i, j) for i, j in (np.argwhere(np.abs(g[key]) > 0) if value.ndim == 2 else [])]
        places = [tuple(p) for p in used[:: max(1, len(used) // 6)]] if value.ndim == 2 else [(0,), (2,)]
        for at in places:
            old, eps = value[at], 1e-5
            value[at] = old + eps
            up, _ = net.gradients(words, y)
            value[at] = old - eps
            down, _ = net.gradients(words, y)
            value[at] = old
            assert abs((up - down) / (2 * eps) - g[key][at]) < 1e-6


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit_languages(docs)
    rows = langid.predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.99 * len(held)


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    spoilt = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    (a, x), (b, y) = langid.fit_languages(docs), langid.fit_languages(spoilt)
    assert a == b and all((x.p[k] == y.p[k]).all() for k in x.p)


def test_pooling_counts_every_position(spark):
    """The pooled probabilities are the mean over all positions of all words, cut or not."""
    languages, net = langid.train({"aa": ["abab abba baba"] * 20, "bb": ["cdcd dcdc ccdd"] * 20}, hidden=6)
    text = "abab, Cdcd abab " + "abcd" * 20 + " dcdc"
    row = langid.predict_languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), (languages, net)).first()
    words = ["abab", "cdcd", "abab", *(("abcd" * 20)[i:i + 24] for i in range(0, 80, 24)), "dcdc"]
    probs = np.concatenate([net.label(np.frombuffer(w.encode(), dtype=np.uint8)[None])[:, 0] for w in words])
    assert row["lang_pred"] == languages[probs.mean(axis=0).argmax()]
    assert abs(row["score"] - probs.mean(axis=0).max()) < 1e-5


def test_odd_rows_and_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_languages(clashing(docs.unionByName(odd_docs(spark))))
    extra = spark.createDataFrame([(90, "123 ... !?", "en", "a", 1), (91, "—٣²", "en", "a", 1), (92, "日本", None, "a", 1)], SCHEMA)
    for x in (odd_docs(spark).unionByName(extra), clashing(odd_docs(spark).unionByName(extra))):
        got = langid.predict_languages(x, model).collect()
        assert len(got) == x.count() and all(0 <= r["score"] <= 1 for r in got)
        by = {r["doc_id"]: r["lang_pred"] for r in got}
        assert by[2] == by[3] == by[90] == by[91] == "und" and by[92] != "und" and by[8] != "und"
        assert [r["lang_pred"] for r in got if r["doc_id"] is None].count("und") == 1
    assert langid.predict_languages(empty_docs(spark), model).count() == 0


def test_every_language_is_learnt(spark):
    """Seventy languages of their own letters, the last ones the rarest: each row gets its own."""
    rows, codes = [], [f"l{k:02d}" for k in range(70)]
    for k, code in enumerate(codes):
        word = (chr(0x4E00 + 7 * k) + chr(0x4E00 + 11 * k + 3)) * 2
        rows += [(100 * k + i, " ".join([word] * 40), code, "a", 1) for i in range(12 if k < 64 else 6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    languages, net = langid.fit_languages(docs)
    assert languages == codes
    got = langid.predict_languages(docs, (languages, net)).collect()
    assert sum(r["lang_pred"] == codes[r["doc_id"] // 100] for r in got if r["doc_id"] >= 6400) > 0
    assert {r["lang_pred"] for r in got} - set(codes[:64])


def test_words_are_drawn_from_whole_texts(spark):
    """Words far behind the start of a long text are learnt from as well."""
    docs = spark.createDataFrame([("aa", 7, "abba " * 2000 + "zzyx " * 2000)], "lang string, salt long, text string")
    drawn = [bytes(r["word"]) for r in langid._drawn(docs, 1000).collect()]
    assert len(drawn) == 1000 and 350 < drawn.count(b"zzyx") < 650
    assert len(langid._drawn(docs, 10_000).collect()) == 4000


def test_without_languages(spark):
    docs = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.predict_languages(docs, langid.fit_languages(docs)).collect()} == {"und"}
    one = langid.fit_languages(odd_docs(spark).where("lang = 'en'"))
    assert {r["lang_pred"] for r in langid.predict_languages(docs, one).collect()} == {"en", "und"}
