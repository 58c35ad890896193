"""Importance resampling towards a target distribution, bit-sliced (operator 12).

Features (runs of 1 to ``longest`` words) are hashed into ``buckets``.  How often a
bucket occurs in all documents and in all target texts gives it a whole-numbered gain, and a document's weight
is the sum of the gains of its features.  That sum is taken on bit planes: bit j of
all bucket counts of a document is one plane of ``buckets`` bits, bit k of all gains
(two's complement) another, and

    weight = sum over j, k of  +-2**(j + k) * popcount(count plane j AND gain plane k)

with a minus for the sign plane of the gains.  Only whole numbers are added, so weights
are exact whatever the order.  Adding Gumbel noise from a hash of the id and taking
the highest scores draws without replacement, in proportion to exp(weight / 1000).

Bucket counts are the only thing collected: ``buckets`` numbers for each side.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import Texts, byte_table, arrow_map, slices

BUCKETS = 10_000
LONGEST = 1         # words of the longest feature
SEED = "2024"
MIN_WORDS = 20      # shorter documents are not drawn
PERCENT = 10        # documents drawn of those long enough
SCALE = 1000        # gains and noise are thousandths
_SHORT = 64         # longer features are hashed one by one


def _word_bytes() -> np.ndarray:
    """Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased text."""
    return byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z, and nothing else, in lower case."""
    return np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)


def _crc_table() -> np.ndarray:
    """The 256 remainders of CRC-32 (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def crc32_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for each span, one byte of all spans at a time."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    size, at = size[order], start[order]
    crc = np.full(len(size), 0xFFFFFFFF, dtype=np.uint32)
    short = np.searchsorted(-size, -_SHORT)     # the first ``short`` spans are longer than _SHORT
    for j in range(int(size[short]) if short < len(size) else 0):
        some = slice(short, np.searchsorted(-size, -j))
        crc[some] = table[(crc[some] ^ data[at[some] + j]) & 0xFF] ^ (crc[some] >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(short):
        crc[i] = zlib.crc32(data[at[i]:at[i] + size[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


class Features:
    """Buckets of all features of some texts: ``doc`` and ``bucket`` of each, and words per text."""

    def __init__(self, texts: Texts, word: np.ndarray, crc: np.ndarray, buckets: int, longest: int):
        data = lower_ascii(texts.data)
        start, end = texts.runs(word[data])
        owner = texts.owner(start)
        self.n_words = np.bincount(owner, minlength=texts.n)
        if longest > 1:     # words of a text one space apart, so that a run of words is a span
            keep = word[data]
            after = end[:-1][owner[1:] == owner[:-1]]
            keep[after], data[after] = True, 0x20
            place = np.append(0, np.cumsum(keep))
            data, start, end = data[keep], place[start], place[end]
        docs, found = [], []
        for n in range(1, longest + 1):
            at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1:]) if len(owner) >= n else owner[:0]
            docs.append(owner[at])
            found.append(crc32_spans(data, start[at], end[at + n - 1], crc) % np.uint32(buckets))
        self.doc, self.bucket = np.concatenate(docs), np.concatenate(found).astype(np.int64)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall into each bucket (``buckets`` whole numbers)."""
    def run(batches):
        word, crc, total = _word_bytes(), _crc_table(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                total += np.bincount(Features(texts, word, crc, buckets, longest).bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln of the smoothed target share over the smoothed source share) of each bucket."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return [math.floor(SCALE * math.log((float(t) + 1) * float(s_all + k) / ((float(s) + 1) * float(t_all + k))))
            for s, t in zip(source.tolist(), target.tolist())]


def gain_planes(gains) -> np.ndarray:
    """(bits, words) two's complement bit planes of whole numbers; the last plane is the sign."""
    gains = np.asarray(gains, dtype=np.int64)
    bits = max(int(max(gains.max(), ~gains.min())).bit_length(), 1) + 1 if len(gains) else 1
    width = -(-len(gains) // 64)
    planes = np.zeros((bits, width * 64), dtype=np.uint8)
    for k in range(bits):
        planes[k, :len(gains)] = (gains >> k) & 1
    return np.packbits(planes, axis=1, bitorder="little").view("<u8")


def weights_of(doc: np.ndarray, bucket: np.ndarray, n_texts: int, planes: np.ndarray, buckets: int) -> np.ndarray:
    """Sum of the gains of each text's features, from bit planes of its bucket counts."""
    weight = np.zeros(n_texts, dtype=np.int64)
    cell, times = np.unique(doc * buckets + bucket, return_counts=True)
    place = np.int64(1) << np.arange(len(planes))
    place[-1] = -place[-1]
    for j in range(int(times.max()).bit_length() if len(times) else 0):
        some = cell[(times >> j) & 1 == 1]
        texts, at = some // buckets, some % buckets
        rows, row = np.unique(texts, return_inverse=True)
        plane = np.zeros((len(rows), planes.shape[1]), dtype=np.uint64)
        word = row * planes.shape[1] + (at >> 6)        # ascending, since cells are
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else word
        if len(word):
            plane.reshape(-1)[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
        for k, gain in enumerate(planes):
            weight[rows] += np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) * (place[k] << j)
    return weight


def noise(key: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(``seed:key``); null key: empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def importance_weights(docs: DataFrame, gains, id_col: str = "doc_id", text_col: str = "text",
                       longest: int = LONGEST) -> DataFrame:
    """Per document: ``id_col``, n_words, n_features and weight under the buckets' gains."""
    buckets, planes = len(gains), gain_planes(gains)
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def start():
        word, crc = _word_bytes(), _crc_table()

        def work(_, texts: Texts) -> dict:
            f = Features(texts, word, crc, buckets, longest)
            return {"n_words": f.n_words.astype(np.int64), "n_features": np.bincount(f.doc, minlength=texts.n).astype(np.int64),
                    "weight": weights_of(f.doc, f.bucket, texts.n, planes, buckets)}

        return work

    return (arrow_map(x, start, "n_words long, n_features long, weight long", "_text", ("_id",), per_task=True)
            .withColumnRenamed("_id", id_col))


def _ranked(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """``rows`` (fit or not) with the rank of the fit ones, and how many these are: ranges of the
    order are sorted side by side and numbered on from the ranges before; no task sees them all."""
    sorted_ = materialize(rows.where("fit").repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("part", F.spark_partition_id()).withColumn("mono", F.monotonically_increasing_id()))
    sizes = sorted_.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offset = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))      # a row for each range
    place = F.col("mono") - F.shiftleft(F.col("part").cast("long"), 33)
    ranked = sorted_.join(F.broadcast(offset), "part").withColumn("rank", F.col("before") + place + 1)
    return ranked, sorted_.count()


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST, seed: str = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``id_col``, n_features, weight, score, rank.

    Of the N documents with at least ``min_words`` words the floor(percent N / 100) highest
    scores are drawn and ranked from 1; ties go to the smaller id, a null id last; rank is
    null for all others.  A null text has no words and weight 0; a null id draws its noise
    from the empty text.  Repeated rows are each ranked.  Without target texts every gain
    follows from the documents alone; other columns are ignored; no documents, no rows.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))
    weighed = importance_weights(docs, gains, id_col, text_col, longest).select(
        F.col(id_col).alias("id"), "n_features", "weight", (F.col("weight") + noise(F.col(id_col), seed)).alias("score"),
        (F.col("n_words") >= min_words).alias("fit"))
    rows = materialize(weighed)
    ranked, n = _ranked(rows, [F.desc("score"), F.asc_nulls_last("id")])
    drawn = F.when(F.col("rank") <= percent * n // 100, F.col("rank"))
    out = ranked.withColumn("rank", drawn).unionByName(rows.where("not fit").withColumn("rank", F.lit(None).cast("long")),
                                                       allowMissingColumns=True)
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """The drawn rows of ``docs``, all columns unchanged (see ``resample``); ids must be distinct."""
    chosen = resample(docs, target, id_col, **parameters).where("rank is not null").select(F.col(id_col).alias("_drawn"))
    return docs.join(chosen, F.col(id_col).eqNullSafe(F.col("_drawn")), "left_semi")


def resample_sql(buckets: int = BUCKETS, seed: str = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> str:
    """DuckDB twin for features of one word: doc_id, n_features, weight, score, rank."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    table = "SELECT i, i AS c FROM (SELECT unnest(range(256)) AS i)"
    for _ in range(8):
        table = f"SELECT i, {shift} AS c FROM ({table})"
    return rf"""
WITH remainder AS (SELECT list(c ORDER BY i) AS t FROM ({table})),
doc AS (SELECT doc_id, {words} AS w FROM documents),
used AS (SELECT doc_id, unnest(w) AS word FROM doc),
goal AS (SELECT unnest({words}) AS word FROM benchmark),
word AS (SELECT DISTINCT word FROM (SELECT word FROM used UNION ALL SELECT word FROM goal)),
hexed AS (SELECT word, hex(encode(word)) AS x FROM word),
bytes AS (SELECT word, list_transform(range(CAST(length(x) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)) AS b FROM hexed),
hashed AS (
  SELECT word, xor(list_reduce(b, lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) % {buckets} AS bucket
  FROM bytes, remainder),
s AS (SELECT bucket, count(*) AS n FROM used JOIN hashed USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM goal JOIN hashed USING (word) GROUP BY 1),
totals AS (SELECT (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM s) AS s_all, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM t) AS t_all),
gain AS (
  SELECT s.bucket, CAST(floor({SCALE} * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * CAST(s_all + {buckets} AS DOUBLE)
         / ((CAST(s.n AS DOUBLE) + 1) * CAST(t_all + {buckets} AS DOUBLE)))) AS BIGINT) AS g
  FROM s LEFT JOIN t ON t.bucket = s.bucket, totals),
weighed AS (
  SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM used JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-{SCALE}.0 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM doc LEFT JOIN weighed USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {min_words} ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= {min_words}) AS fit FROM scored)
SELECT doc_id, n_features, weight, score,
       CAST(CASE WHEN n_features >= {min_words} AND place <= {percent} * fit // 100 THEN place END AS BIGINT) AS rank
FROM placed
"""
