"""Document fingerprints by spot signatures (operator 6).

Very common words (articles, prepositions and the like) are anchors.  Wherever one
stands, the chain of the next content words after it is a spot signature, so most
signatures sit in running prose.  A word with no anchor among the ``GAP`` words before it
(in tables, code, other languages) is an anchor itself.  What is an anchor thus depends on
the words just before it, never on how many the rest of the text holds, so two texts that
share a passage share its signatures but for those at its ends.  A document's
fingerprint is the set of its signatures, 32 bits each, sorted and written in
base64; the likeness of two fingerprints is the Jaccard likeness of the sets.

``neighbour_likeness`` compares each document with its successor in id order and
with an edited form of itself.  ``similar_pairs`` finds all similar fingerprints:
sets are partitioned by length so that only neighbouring partitions can hold a
partner, joined on the rarest signatures that a partner must share, and the Jaccard
likeness is worked out only where the lengths allow the threshold.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import Texts, Words, arrow_map, bound_batches, byte_table, in_share, mix, slices, span_hash

# Common words of the four languages of the corpus.
ANCHORS = (
    "the of and to a in that is was for on with as are by this from at be it an or "
    "de la le et les des en un une que est pour qui dans par au plus ne se sur du avec "
    "der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch es "
    "el y los las por para con no una su al lo como más del"
).split()
CHAIN = 2           # content words in a signature
DISTANCE = 1        # every so many content words
GAP = 4             # a word with no anchor among so many words before it counts as one
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 16_384
SAMPLES = 16        # sampled ids for each bucket bound

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORD = byte_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def _anchor_hashes(anchors) -> np.ndarray:
    raw = [a.encode() for a in dict.fromkeys(anchors)]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return np.sort(span_hash(data, ends - [len(r) for r in raw], ends))


def spots_of(texts: Texts, anchors: np.ndarray, chain: int = CHAIN, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of the distinct spot signatures, sorted by text and signature."""
    lower = Texts(np.frombuffer(texts.data.tobytes().translate(_LOWER), dtype=np.uint8), texts.bounds)
    words = Words(lower, _WORD)
    common = np.isin(words.hash, anchors)
    content = np.flatnonzero(~common)
    reach = (chain - 1) * distance

    def chains(at):
        """Signatures of the chains that begin at the first content word after each place."""
        first = np.searchsorted(content, at, side="right")
        ok = first + reach < len(content)
        at, first = at[ok], first[ok]
        ok = words.doc[content[first + reach]] == words.doc[at]
        at, first = at[ok], first[ok]
        key = words.hash[at]
        for i in range(chain):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + words.hash[content[first + i * distance]])
        return words.doc[at], key

    at = np.arange(len(common))
    last = np.maximum.accumulate(np.where(common, at, -1))
    # up to a text's first common word, every word has none before it
    lone = (last < words.bounds[words.doc]) | (at - last > GAP)
    doc, key = chains(np.flatnonzero(common | lone))
    # texts too short for any chain: all their words are one signature
    left = np.flatnonzero((np.bincount(doc, minlength=texts.n) == 0) & (words.count > 0))
    doc = np.append(doc, left)
    key = np.append(key, span_hash(words.hash, words.bounds[left], words.bounds[left + 1]))
    both = np.unique((doc.astype(np.uint64) << np.uint64(32)) | (key >> np.uint64(32)))
    return (both >> np.uint64(32)).astype(np.int64), both & np.uint64(0xFFFFFFFF)


def _printed(doc: np.ndarray, spot: np.ndarray, n: int) -> list[str]:
    """Fingerprint strings."""
    raw, bounds = spot.astype("<u4"), np.searchsorted(doc, np.arange(n + 1))
    return [base64.b64encode(raw[bounds[i]:bounds[i + 1]].tobytes()).decode() for i in range(n)]


def _likeness(a: tuple, b: tuple, n: int) -> np.ndarray:
    """Jaccard likeness of the sets of two (group, signature) lists, group by group; 1 if both are empty."""
    ka, kb = (((g.astype(np.uint64) << np.uint64(32)) | s) for g, s in (a, b))
    both = np.bincount((np.intersect1d(ka, kb, assume_unique=True) >> np.uint64(32)).astype(np.int64), minlength=n)
    union = np.bincount(a[0], minlength=n) + np.bincount(b[0], minlength=n) - both
    return np.where(union > 0, both / np.maximum(union, 1), 1.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors=ANCHORS,
                 chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """One row per document: ``id_col``, fingerprint, spots (the signatures, ascending).

    Equal texts have equal fingerprints; texts without words (null, empty, blank) the empty one.
    Ids are carried through, null or repeated, and repeated rows stay; other columns, whatever their
    names, are ignored; an empty table gives an empty result.
    """
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = _anchor_hashes(anchors)

    def work(_, texts: Texts) -> dict:
        doc, spot = spots_of(texts, known, chain, distance)
        bounds = np.searchsorted(doc, np.arange(texts.n + 1))
        return {"fingerprint": _printed(doc, spot, texts.n),
                "spots": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(spot.astype(np.int64)))}

    return (arrow_map(x, work, "fingerprint string, spots array<long>", "_text", ("_id",))
            .withColumnRenamed("_id", id_col))


def _bounds(keys: DataFrame, n_rows: int, buckets: int) -> list[tuple]:
    """Ascending (id, k) of existing rows that cut the rows into about equal buckets.  About
    ``buckets * SAMPLES`` rows, at most ``MAX_BUCKETS * SAMPLES``, reach the driver."""
    n = min(buckets, MAX_BUCKETS) * SAMPLES
    sample = sorted({(r["id"] is not None, r["id"], r["k"]) for r in keys.where(in_share(n / n_rows, "id", "k")).distinct().collect()},
                    key=lambda r: (r[0], r[1] if r[0] else 0, r[2]))
    step = max(1, len(sample) // min(buckets, MAX_BUCKETS))
    return [r[1:] for r in sample[::step][1:]]


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors=ANCHORS,
                       chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """Per document: ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next document is the one that follows in order of id (null first; rows with equal ids
    in order of a hash of their text), after the last the first.  The edited text has its last
    floor(n_chars / 2) code points replaced by as many from the start of the next document, or
    all it has.  Null texts count as empty; a table of one row is its own next; an empty table
    gives an empty result; other columns are ignored.

    Texts are shuffled once, by ranges of the id between ids sampled from the data; the row at
    each bound also goes to the range before it, so each range knows its last row's successor.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    x = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k"), text.alias("text"))
    size = x.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"), F.min(F.struct("id", "k")).alias("least")).first()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    if size["least"] is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(-(-(size["bytes"] or 0) // BUCKET_BYTES), 4 * partitions)
    bounds = _bounds(x.select("id", "k"), size["rows"], buckets)

    def struct(row):
        return F.struct(F.lit(row[0]).cast(kind).alias("id"), F.lit(row[1]).cast("long").alias("k"))

    own = F.struct("id", "k")
    groups = [bounds[i:i + 128] for i in range(0, len(bounds), 128)]
    if bounds:      # the number of bounds at or before the row, in two steps
        coarse = F.array(*(struct(g[0]) for g in groups))
        fine = F.array(*(F.array(*map(struct, g)) for g in groups))
        group = F.size(F.filter(coarse, lambda b: b <= own))
        x = x.withColumn("group", group).withColumn(
            "bucket", F.when(F.col("group") == 0, 0).otherwise(
                (F.col("group") - 1) * 128
                + F.size(F.filter(F.element_at(fine, F.greatest(F.col("group"), F.lit(1))), lambda b: b <= own))))
        at_bound = F.exists(F.element_at(fine, F.greatest(F.col("group"), F.lit(1))), lambda b: b == own)
    else:
        x, at_bound = x.withColumn("bucket", F.lit(0)), F.lit(False)
    first = own == struct(tuple(size["least"]))
    # roles: 0 a row of its bucket, 1 successor of the bucket before, 2 successor of the last row
    role = F.explode(F.filter(F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("role")),
        F.when(at_bound & (F.col("bucket") > 0), F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(1).alias("role"))),
        F.when(first, F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(2).alias("role")))), lambda r: r.isNotNull()))
    dealt = (x.select("id", "k", "text", role.alias("r"))
             .select(F.col("r.bucket").alias("bucket"), F.col("r.role").alias("role"), "id", "k", "text")
             .repartition(max(partitions, min(buckets, MAX_BUCKETS) // 4), "bucket")
             .sortWithinPartitions("bucket", "role", "id", "k"))
    known = _anchor_hashes(anchors)
    id_type = pa.schema([("id", _arrow_type(docs, id_col))])

    def run(batches):
        held = None     # the last row so far: its successor is still to come
        for batch in batches:
            for at, texts in slices(batch.column(4)):
                rows = batch.slice(at, texts.n)
                raw = [texts.text(i) for i in range(texts.n)]
                meta = list(zip(*(rows.column(c).to_pylist() for c in range(3))))
                if held:
                    meta, raw = [held[0], *meta], [held[1], *raw]
                held = (meta[-1], raw[-1])
                yield _compare(meta, raw, known, chain, distance, id_type.field(0).type)

    return bound_batches(dealt).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _arrow_type(docs: DataFrame, column: str):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def _joined(raw: list[bytes]) -> Texts:
    return Texts(np.frombuffer(b"".join(raw), dtype=np.uint8), np.append(0, np.cumsum([len(r) for r in raw], dtype=np.int64)).astype(np.int64))


def _compare(meta, raw, known, chain, distance, id_type) -> pa.RecordBatch:
    """Rows whose successor stands right after them: the result columns."""
    n = len(raw)
    doc, spot = spots_of(_joined(raw), known, chain, distance)
    # the first row of several with the successor's role is the successor
    use = [i for i in range(n - 1) if meta[i][1] == 0 and meta[i + 1][0] == meta[i][0]]
    edited, chars = [], []
    for i in use:
        text, after = raw[i].decode(), raw[i + 1].decode()
        half = len(text) // 2
        chars.append(len(text))
        edited.append((text[:len(text) - half] + after[:half]).encode())
    e_doc, e_spot = spots_of(_joined(edited), known, chain, distance)
    number = np.full(n + 1, -1, dtype=np.int64)
    number[use] = np.arange(len(use))

    def picked(shift):
        """(pair, signature) of each used row (or, with 1, of the row after it)."""
        to = np.full(n + 1, -1, dtype=np.int64)
        to[np.array(use, dtype=np.int64) + shift] = np.arange(len(use))
        ok = to[doc] >= 0
        return to[doc[ok]], spot[ok]

    own, after = picked(0), picked(1)
    prints = _printed(doc, spot, n)
    return pa.RecordBatch.from_arrays([
        pa.array([meta[i][2] for i in use], type=id_type), pa.array(chars, type=pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited], type=pa.string()),
        pa.array([prints[i] for i in use], type=pa.string()),
        pa.array(_printed(e_doc, e_spot, len(use)), type=pa.string()),
        pa.array(_likeness(own, (e_doc, e_spot), len(use)), type=pa.float64()),
        pa.array(_likeness(own, after, len(use)), type=pa.float64()),
    ], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def similar_pairs(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                  anchors=ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs (a, b, likeness) of different fingerprints with at least the
    threshold, and members (``id_col``, f) of each fingerprint f; copies are not expanded.
    Documents without signatures are members of the empty fingerprint, which has no pairs."""
    signed = materialize(fingerprints(docs, id_col, text_col, anchors, chain, distance)
                         .withColumn("f", F.sha2("fingerprint", 256)))
    sets = (signed.where(F.size("spots") > 0).select("f", "spots").dropDuplicates(["f"])
            .withColumn("n", F.size("spots")))
    # partition p holds lengths from (1/t)**p: a partner's length lies in the same or the next one
    part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")
    sets = materialize(sets.withColumn("part", part))
    each = sets.select("f", "n", "part", F.explode("spots").alias("s"))
    rarity = each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (each.join(rarity, "s").groupBy("f", "n", "part")
              .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("known")))
    # signatures found nowhere else come first in the order of rarity and match nothing
    need = F.ceil(threshold * F.col("n") - 1e-9).cast("int")
    prefix = F.col("n") - need + 1 - (F.col("n") - F.size("known"))
    rare = (ranked.withColumn("prefix", prefix).where("prefix > 0")
            .select("f", "n", "part", F.explode(F.slice("known", F.lit(1), F.col("prefix"))).alias("r"))
            .select("f", "n", "part", F.col("r.s").alias("s")))
    shorter = rare.select(F.col("f").alias("a"), F.col("n").alias("na"), "s",
                          F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    longer = rare.select(F.col("f").alias("b"), F.col("n").alias("nb"), "s", "part")
    met = (shorter.join(longer, ["part", "s"])
           .where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
           .where(F.col("na") >= threshold * F.col("nb") - 1e-9).select("a", "b").distinct())
    left = sets.select(F.col("f").alias("a"), F.col("spots").alias("sa"))
    right = sets.select(F.col("f").alias("b"), F.col("spots").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    pairs = (met.join(left, "a").join(right, "b").withColumn("both", both)
             .withColumn("likeness", F.col("both") / (F.size("sa") + F.size("sb") - F.col("both")))
             .where(F.col("likeness") >= threshold).select("a", "b", "likeness"))
    return pairs, signed.select(id_col, "f")
