"""From raw documents to packed training sequences.

Each stage takes the whole table its predecessor kept; all but the last return
the columns of ``documents``.  Between stages the rows are written as Parquet
under the shared checkpoint folder and read again, so a lost executor costs at
most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from browsekit.llm import lines, mixing, near, packing, queries, repetition
from browsekit.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules (operator 5); the others go."""
    return repetition.drop_repetitive(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that many sites share (operator 7)."""
    return lines.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the smallest id (operator 3)."""
    return near.drop_near_duplicates(docs, order_col="doc_id")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of source, language and topic (operator 9)."""
    return mixing.sample_to_targets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences (operator 1)."""
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# Rolling hashes, dart signatures, differencing and a BPE have no SQL form; the tests hold
# each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
