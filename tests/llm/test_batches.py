"""What a task sends to its Python worker at a time is bounded in bytes, not in rows alone."""

from pyspark.sql import functions as F

from browsekit.llm import repetition, spots
from browsekit.llm.text import BATCH_BYTES, arrow_map

ROW = 20_000        # 400 rows of one partition: 8 MB, well under 10,000 rows and 64 MB


def _texts(spark):
    return spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.format_string("word%d ", "id"), ROW // 8).alias("text"))


def test_texts_reach_python_in_bounded_batches(spark):
    def held(rows, texts):
        # slices share the buffer of the batch they were cut from
        return {"bytes": [rows.column(1).buffers()[2].size] * texts.n}

    got = arrow_map(_texts(spark), held, "bytes long", "text", ("doc_id",)).collect()
    assert len(got) == 400
    assert max(r["bytes"] for r in got) <= BATCH_BYTES + 2 * ROW


def test_fingerprints_ask_for_bounded_batches_and_keep_every_row(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    out = spots.neighbour_likeness(_texts(spark))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(BATCH_BYTES)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == list(range(400))


def test_the_rows_that_pass_the_quality_rules_come_from_bounded_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(100)), lambda i: F.concat(F.lit("w"), i + 1000 * F.col("id"))), " ").alias("text"))
    out = repetition.drop_repetitive(docs)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(BATCH_BYTES)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == list(range(400))
