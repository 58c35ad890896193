"""Cross-site boilerplate lines by distinct-site spread (operator 7).

DataFrame functions only.  Every trimmed line that is not blank is reduced to a 128-bit
hash.  Copies of one text count as one page, on the least of their sites: lines are first
grouped by line and text, which also leaves a line of a text with thousands of copies one row for
each task.  A HyperLogLog sketch of the sites of each line is then built map-side and merged by
the aggregation.  The estimate settles lines that are clearly above or below the threshold; those
within the sketch's error of it get an exact distinct count.  Boilerplate lines are
taken out of every document that holds them, whatever their length and share of it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import text_key

MIN_SITES = 10      # a line on at least so many distinct sites is boilerplate
LG_K = 12           # log2 of the sketch's buckets
SIGMAS = 5          # standard errors around the threshold that get exact counts
BROADCAST_BYTES = 1 << 24   # lists of lines to take out are broadcast up to this measured size
SALTS = 16          # beyond it, rows of one text are dealt to so many tasks


def _hash(line: Column) -> list[Column]:
    line = F.trim(line)
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2")]


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _lines(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns and (h1, h2) of each line that is not blank."""
    line = F.explode(F.filter(_split(F.col("text")), lambda x: F.trim(x) != ""))
    return docs.select(*columns, line.alias("_line")).select(*columns, *_hash(F.col("_line")))


def boilerplate_lines(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                      min_sites: int = MIN_SITES, lg_k: int = LG_K, sigmas: float = SIGMAS) -> DataFrame:
    """(h1, h2) of the lines on at least ``min_sites`` distinct sites.

    Equal texts are one page on the least of their sites; a null site counts as none, a
    null text has no lines; repeated rows change nothing; no rows, no result.
    """
    x = docs.select(F.col(site_col).cast("string").alias("site"), F.col(text_col).alias("text"), *text_key(F.col(text_col)))
    pages = materialize(_lines(x, "k1", "k2", "site").groupBy("h1", "h2", "k1", "k2").agg(F.min("site").alias("site"))
                        .where("site is not null").select("h1", "h2", "site"))
    error = sigmas * 1.04 / math.sqrt(1 << lg_k)
    spread = materialize(
        pages.groupBy("h1", "h2")
        .agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
        .select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= math.floor(min_sites * (1 - error))))
    sure = spread.where(F.col("sites") > math.ceil(min_sites * (1 + error))).select("h1", "h2")
    near = spread.where(F.col("sites") <= math.ceil(min_sites * (1 + error))).select("h1", "h2")
    exact = (pages.join(near, ["h1", "h2"], "left_semi")
             .distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"))
             .where(F.col("sites") >= min_sites).select("h1", "h2"))
    return sure.unionByName(exact)


def _with_lists(x: DataFrame, gone: DataFrame) -> DataFrame:
    """``x`` with the list of lines to take out of each text, null for most.

    Lists of a measured size are broadcast, so that texts stay where they are; larger ones
    meet the texts in a shuffle, in which the copies of a text are dealt to ``SALTS`` tasks.
    """
    size = gone.agg(F.sum(F.size("gone") * 8 + 48).alias("bytes")).first()["bytes"] or 0
    if size <= BROADCAST_BYTES:
        return x.join(F.broadcast(gone), ["k1", "k2"], "left")
    salted = x.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    every = gone.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(every, ["k1", "k2", "_salt"], "left").drop("_salt")


def remove_boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                       min_sites: int = MIN_SITES) -> DataFrame:
    """(_row, _text, _n_lines, _n_removed) per document: the row as a struct, its text without
    boilerplate lines, its number of lines and how many went.

    A null text stays null with 0 lines; a document with a null site is cleaned but adds no
    site; blank lines stay; repeated rows are cleaned alike; a document of boilerplate alone is
    left with an empty text; other columns are carried in ``_row``; an empty table gives an
    empty result.
    """
    # what goes depends on the text alone, so the text's key joins it back
    found = boilerplate_lines(docs, site_col, text_col, min_sites)
    x = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("text"), *text_key(F.col(text_col)))
    gone = materialize(_lines(x.select("k1", "k2", "text"), "k1", "k2").join(found, ["h1", "h2"])
                       .groupBy("k1", "k2").agg(F.collect_set("h1").alias("gone")))
    line = _split(F.col("text"))
    kept = F.filter(line, lambda a: (F.trim(a) == "") | ~F.array_contains("gone", F.xxhash64(F.trim(a))))
    cleaned = _with_lists(x, gone).withColumn("_kept", F.when(F.col("gone").isNotNull(), kept))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(line))
    return cleaned.select(
        "_row", F.when(F.col("_kept").isNotNull(), F.concat_ws("\n", "_kept")).otherwise(F.col("text")).alias("_text"),
        n_lines.cast("int").alias("_n_lines"),
        F.when(F.col("_kept").isNotNull(), F.size(line) - F.size("_kept")).otherwise(0).cast("int").alias("_n_removed"))


def clean_documents(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                    min_sites: int = MIN_SITES, n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with boilerplate taken out of ``text_col`` (and ``n_chars_col`` counted again
    where text went); all rows and columns stay."""
    out = remove_boilerplate(docs, site_col, text_col, min_sites)
    columns = []
    for c in docs.columns:
        value = F.col(f"_row.`{c}`")
        if c == text_col:
            value = F.col("_text")
        elif c == n_chars_col:
            kind = docs.schema[c].dataType
            value = F.when(F.col("_n_removed") > 0, F.length("_text").cast(kind)).otherwise(value)
        columns.append(value.alias(c))
    return out.select(*columns)


def line_dedup_sql(min_sites: int = MIN_SITES) -> str:
    """DuckDB twin: doc_id, n_lines, n_removed, text (ids must be distinct)."""
    return f"""
WITH page AS (SELECT text, min(source) AS site FROM documents WHERE text IS NOT NULL GROUP BY text),
bad AS (
  SELECT t FROM (SELECT trim(unnest(string_split(text, chr(10))), ' ') AS t, site FROM page) WHERE t <> ''
  GROUP BY t HAVING count(DISTINCT site) >= {min_sites}),
line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
marked AS (SELECT line.*, bad.t IS NOT NULL AS gone FROM line LEFT JOIN bad ON trim(line.l, ' ') = bad.t),
doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_gone,
         coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_gone, 0) AS INTEGER) AS n_removed,
       CASE WHEN n_gone > 0 THEN kept ELSE d.text END AS text
FROM documents d LEFT JOIN doc v ON d.doc_id = v.doc_id
"""
