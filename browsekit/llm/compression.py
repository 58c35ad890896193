"""Quality classifier by compression (operator 4).

Two zstandard dictionaries are built, from texts labelled good and from texts
labelled bad.  A text is cut into blocks of ``BLOCK`` bytes and each block is
compressed under either dictionary: blocks are short, so what a block costs is
decided by the dictionary and not by the text itself.  The features are the
difference of the two compressed sizes over the raw size and, as a second one, the
logarithm of the smaller size over the raw size (text that repeats itself is cheap
under any dictionary).  A logistic curve fitted on labelled texts that the
dictionaries have not seen turns them into a calibrated score.

Learning takes at most ``SAMPLE`` labelled rows of each class, the first in hash
order: dictionaries from at most ``SAMPLE_BLOCKS`` blocks of each class, drawn by hash from
the whole texts, the curve from features of whole texts, computed in the tasks.  Every document is scored over its whole text, in one pass without shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import Texts, arrow_map, in_share

SAMPLE = 2000           # labelled rows of each class to learn from, at most
SAMPLE_BLOCKS = 16_000  # blocks of each class to build a dictionary from, at most
DICT_BYTES = 1 << 16
BLOCK = 1024
LEVEL = 3
SHRINK = 32             # bytes added to sizes: short texts say little
FOLDS, HELD_FOLD = 5, 0
CUT = 0.3               # predicted is 1 from this score on


def fold_of(key: Column, folds: int) -> Column:
    """CRC-32 of the key as text, modulo ``folds``; null keys have no fold."""
    return F.crc32(key.cast("string").cast("binary")) % folds


@dataclass
class Model:
    good: bytes         # dictionaries; empty if a class had no rows to learn from
    bad: bytes
    weights: tuple[float, float, float]
    mean: tuple[float, float]
    scale: tuple[float, float]


def _compressor(dictionary: bytes):
    import zstandard

    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def _features(raw: bytes, good, bad) -> tuple[float, float]:
    """(normalised difference, log of size over raw size); zeros for an empty text."""
    a = b = 0
    for at in range(0, len(raw), BLOCK):
        block = raw[at:at + BLOCK]
        a += len(good.compress(block))
        b += len(bad.compress(block))
    if not raw:
        return 0.0, 0.0
    return (b - a) / (len(raw) + SHRINK), float(np.log((min(a, b) + SHRINK) / (len(raw) + SHRINK)))


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary, or the blocks themselves where there are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, blocks)) // 8)), blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICT_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton's method, with an intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _blocks(texts: DataFrame, most: int) -> tuple[list[bytes], list[bytes]]:
    """At most ``most`` blocks of each class, bad and good, drawn by hash from whole texts (id, y, text)."""
    raw = F.encode("text", "UTF-8")
    places = F.sequence(F.lit(0), F.floor((F.octet_length("text") - 1) / BLOCK).cast("int"))
    block = F.transform(places, lambda i: F.struct(i.alias("i"), F.substring(raw, i * BLOCK + 1, F.lit(BLOCK)).alias("raw")))
    rows = (texts.where(F.octet_length("text") > 0).select("id", "y", F.explode(block).alias("b"))
            .select("y", "b.raw", F.struct(F.xxhash64("id", "b.i").alias("h"), "id", "b.i").alias("place"))
            .withColumn("nth", F.row_number().over(Window.partitionBy("y").orderBy("place")))
            .where(F.col("nth") <= most).select("y", "nth", "raw").collect())
    rows.sort(key=lambda r: r["nth"])
    return tuple([bytes(r["raw"]) for r in rows if r["y"] == y] for y in (0, 1))


def _measured(texts: DataFrame, good: bytes, bad: bytes) -> list:
    """(id, y, difference, size): the features of whole texts (id, y, text), in order of id."""
    def start():
        a, b = _compressor(good), _compressor(bad)

        def work(_, batch: Texts) -> dict:
            f = np.array([_features(batch.text(i), a, b) for i in range(batch.n)])
            return {"difference": pa.array(f[:, 0]), "size": pa.array(f[:, 1])}

        return work

    rows = arrow_map(texts, start, "difference double, size double", "text", ("id", "y"), per_task=True).collect()
    return sorted(rows, key=lambda r: str(r["id"]))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", sample: int = SAMPLE, sample_blocks: int = SAMPLE_BLOCKS) -> Model:
    """Learn from the labelled rows outside the held-out fold, at most ``sample`` of each class:
    dictionaries from two thirds of their texts (``sample_blocks`` blocks of each class), the curve
    from the others, weighted to the classes' numbers in the labels."""
    usable = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
              .where(F.col("y").isin(0, 1)).where(fold_of(F.col("id"), FOLDS) != HELD_FOLD)
              .groupBy("id").agg(F.max("y").alias("y")))
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    counts = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [usable.where(F.col("y") == y).where(in_share(3 * sample / max(counts.get(y, 0), 1), "id"))
           .orderBy(*order).limit(sample) for y in (0, 1)]
    chosen = few[0].unionByName(few[1])
    texts = materialize(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                        .join(F.broadcast(chosen), "id")      # at most 2 * sample ids
                        .groupBy("id").agg(F.max("y").alias("y"), F.max("text").alias("text")))
    ids = sorted(texts.select("id", "y").collect(), key=lambda r: str(r["id"]))
    classes = [[r["id"] for r in ids if r["y"] == y] for y in (0, 1)]
    if not all(classes):
        return Model(b"", b"", (0.0, 0.0, 0.0), (0.0, 0.0), (1.0, 1.0))
    roles = [(i, n % 3 == 0, n % 3 > 0 or len(x) == 1) for x in classes for n, i in enumerate(x)]
    kind = texts.schema["id"].dataType.simpleString()
    dealt = texts.join(F.broadcast(docs.sparkSession.createDataFrame(roles, f"id {kind}, held boolean, fit boolean")), "id")
    bad, good = map(_dictionary, _blocks(dealt.where("fit"), sample_blocks))
    rows = _measured(dealt.where("held"), good, bad)
    x, y = np.array([[r["difference"], r["size"]] for r in rows]), np.array([float(r["y"]) for r in rows])
    share = counts[1] / (counts[1] + counts[0])
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum()) * len(y)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = _logistic((x - mean) / scale, y, weight)
    return Model(good, bad, tuple(w), tuple(mean), tuple(scale))


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, held_out, score, predicted, and the compressed-size
    difference it rests on.

    A null text counts as empty and scores like one; null ids are not held out; repeated rows
    score alike; other columns are ignored; without labels of both classes every score is 0.5.
    """
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def start():
        good, bad = _compressor(model.good), _compressor(model.bad)
        w, mean, scale = map(np.array, (model.weights, model.mean, model.scale))

        def work(_, texts: Texts) -> dict:
            f = np.array([_features(texts.text(i), good, bad) for i in range(texts.n)])
            z = w[0] + ((f - mean) / scale) @ w[1:]
            return {"score": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "difference": pa.array(f[:, 0])}

        return work

    out = arrow_map(x, start, "score double, difference double", "_text", ("_id",), per_task=True)
    return out.select(F.col("_id").alias(id_col),
                      F.coalesce(fold_of(F.col("_id"), FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "difference")
