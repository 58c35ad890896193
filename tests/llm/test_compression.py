import zlib

from pyspark.sql import functions as F

from browsekit.llm import compression

from .cases import clashing, empty_docs, odd_docs

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = compression.fit_quality(docs, labels)
    rows = compression.score_quality(docs, model).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)
    assert sum(1 - r["predicted"] for r in bad) >= 0.9 * len(bad)
    # calibrated: within bins the mean score is near the share of good documents
    assert abs(sum(r["score"] for r in rows) / len(rows) - len(good) / len(rows)) < 0.02
    wins = sum(g["score"] > b["score"] for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.98


def test_held_out_rows_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(compression.fold_of(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert compression.fit_quality(docs, labels) == compression.fit_quality(docs, flipped)


def test_fold_is_crc32_of_the_id(spark):
    rows = spark.range(50).select("id", compression.fold_of(F.col("id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_odd_rows_and_clashing_names(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = labels.limit(3).select(F.lit(None).cast("long").alias("doc_id"), "quality", "toxic").unionByName(
        labels.withColumn("quality", F.lit(None).cast("int")).limit(2))
    model = compression.fit_quality(clashing(docs), labels.unionByName(odd))
    for x in (odd_docs(spark), clashing(odd_docs(spark))):
        rows = compression.score_quality(x, model).collect()
        assert len(rows) == x.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] == 7}) == 1
    assert compression.score_quality(empty_docs(spark), model).count() == 0


def test_long_texts_are_learnt_whole(spark):
    """Texts alike in their first 9000 bytes, told apart by what follows."""
    start = " ".join(f"common{i % 50}" for i in range(1200))
    assert len(start) > 9000
    rows = [(i, start + " " + " ".join(f"{'good' if i % 2 else 'poor'}word{(7 * i + j) % 90} tail" for j in range(900))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    got = compression.score_quality(docs, compression.fit_quality(docs, labels)).where("held_out").collect()
    good, bad = ([r["score"] for r in got if r["doc_id"] % 2 == y] for y in (1, 0))
    assert good and bad and min(good) > max(bad) + 0.5


def test_without_labels(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = compression.score_quality(docs, compression.fit_quality(docs, none)).collect()
    assert {r["score"] for r in rows} == {0.5}
    few = spark.createDataFrame([(1, 0), (4, 1), (5, 1)], "doc_id long, quality int")
    assert all(0 <= r["score"] <= 1 for r in compression.score_quality(docs, compression.fit_quality(docs, few)).collect())
