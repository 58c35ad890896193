"""Removal of repeated passages by seed and extend (operator 2).

A passage is a run of ``length`` words or more that occurs twice.  Seeds: of the
hashes of ``seed`` consecutive words, the smallest among each ``length - seed + 1``
neighbours is an anchor (winnowing), so every window of ``length`` words holds one,
and equal windows hold the same one.  Texts are joined on anchors; a text none of
whose anchors occurs elsewhere has no repeat and is done.  Extension: windows that
share their anchor form a *run*; its *context* is all words those windows cover,
both ways from the anchor.  Runs with equal context are repeated whole; of the
others only those whose anchor occurs elsewhere are compared window by window,
against one representative of each context.  Overlapping repeated windows merge
into maximal repeats.

Nothing is compared in pairs: every step counts or joins on hashes, so a passage
that a third of all documents share costs one row for each occurrence.  Copies of
a whole text are recognised first (128-bit key) and only one of them is extended.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, materialize_many
from .skew import join_by_count
from .text import (Texts, Words, arrow_map, list_array, mix, slices, space_table, span_hash, text_key,
                   window_hash)

LENGTH = 35     # words in a window
SEED = 16       # words in a seed; any value up to LENGTH gives the same result


def _window_min(values: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each ``w`` consecutive values, by doubling."""
    out, have = values, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _anchors(words: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every window of ``length`` words, and its anchor's hash."""
    at = words.windows(length)
    if not len(at):
        return at, np.zeros(0, dtype=np.uint64)
    return at, _window_min(window_hash(words.hash, seed), length - seed + 1)[at]


def _anchor_places(words: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Every place whose seed hash is the smallest in some window, and that hash."""
    at, anchor = _anchors(words, length, seed)
    if not len(at):
        return at, anchor
    reach = length - seed + 1
    padded = np.zeros(len(words.hash) - length + 1 + 2 * (reach - 1), dtype=np.uint64)
    padded[at + reach - 1] = anchor
    smallest = ~_window_min(~padded, reach)     # largest of the minima of the windows around
    seeds = window_hash(words.hash, seed)
    place = np.flatnonzero((seeds == smallest) & (smallest != 0))
    return place, seeds[place]


def _runs(at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Indexes at which a run begins: consecutive windows with one anchor."""
    first = np.ones(len(at), dtype=bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    return np.flatnonzero(first)


def _seeds(length: int, seed: int):
    """Per text: number of words, digest of its words, its anchors and which of them recur in it."""
    table, seen = space_table(), set()

    def work(rows: pa.RecordBatch, texts: Texts) -> dict:
        words = Words(texts, table)
        place, value = _anchor_places(words, length, seed)
        doc = words.doc[place]
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        recurs = np.diff(np.append(np.flatnonzero(fresh), len(order))) > 1
        bounds = np.searchsorted(doc[fresh], np.arange(texts.n + 1))
        # one copy of a text for each task is enough for the search
        keys = list(zip(rows.column(rows.schema.get_field_index("k1")).to_pylist(),
                        rows.column(rows.schema.get_field_index("k2")).to_pylist()))
        new = np.zeros(texts.n, dtype=bool)
        for i, key in enumerate(keys):
            if key not in seen:
                seen.add(key)
                new[i] = True
        keep = new[doc[fresh]]
        sizes = np.diff(bounds) * new
        bounds = np.append(0, np.cumsum(sizes))
        sha = [hashlib.sha256(b" ".join(texts.text(i).split())).hexdigest() for i in range(texts.n)]
        return {"n_words": words.count.astype(np.int64), "sha": sha,
                "h": list_array(value[fresh][keep].view(np.int64), bounds),
                "recurs": list_array(recurs[keep], bounds)}

    return work


def _first_copies(docs: DataFrame) -> DataFrame:
    """Drop texts seen before in the same task, ahead of a shuffle by key."""

    def run(batches):
        seen = set()
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            new = []
            for key in keys:
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _extend(length: int, seed: int):
    """Runs of a text whose anchor is in its list ``hs``: context hash and hashes of the windows."""
    table = space_table()

    def run(batches):
        for batch in batches:
            for at0, texts in slices(batch.column(batch.schema.get_field_index("text"))):
                rows = batch.slice(at0, texts.n)
                words = Words(texts, table)
                at, anchor = _anchors(words, length, seed)
                wanted = rows.column(rows.schema.get_field_index("hs"))
                salt = mix(np.arange(texts.n, dtype=np.uint64))
                own = np.repeat(salt, np.diff(wanted.offsets.to_numpy()))
                hs = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                hit = np.isin(anchor ^ salt[words.doc[at]], hs ^ own)
                at, anchor = at[hit], anchor[hit]
                begin = _runs(at, anchor)
                last = np.append(begin, len(at))[1:] - 1
                doc = words.doc[at[begin]]
                base = words.bounds[doc]
                lo, hi = at[begin], at[last] if len(at) else at[begin]
                windows = window_hash(words.hash, length)
                index = pa.array(doc)
                yield pa.RecordBatch.from_arrays([
                    rows.column(rows.schema.get_field_index("k1")).take(index),
                    rows.column(rows.schema.get_field_index("k2")).take(index),
                    pa.array(anchor[begin].view(np.int64)),
                    pa.array(span_hash(words.hash, lo, hi + length).view(np.int64)),
                    pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32)),
                    list_array(windows[at].view(np.int64) if len(at) else np.zeros(0, dtype=np.int64),
                               np.append(begin, len(at)) if len(at) else np.zeros(1, dtype=np.int64)),
                ], names=["k1", "k2", "h", "c", "lo", "hi", "w"])

    return run


def _search(keyed: DataFrame, length: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with seeds, candidate texts, repeated spans of window starts by text key)."""
    seeded = materialize(arrow_map(
        keyed, lambda: _seeds(length, seed), "n_words long, sha string, h array<long>, recurs array<boolean>",
        "text", ("k1", "k2", "id"), per_task=True))
    anchors = seeded.select("k1", "k2", F.explode(F.arrays_zip("h", "recurs")).alias("a")).select(
        "k1", "k2", F.col("a.h").alias("h"), F.col("a.recurs").alias("recurs"))
    shared = materialize(
        anchors.groupBy("h")
        .agg(F.min("k1").alias("least"), F.max("k1").alias("most"), F.max("recurs").alias("recurs"),
             F.count(F.lit(1)).alias("rows"))
        .where("least < most or recurs").select("h", "rows"))
    wanted = (join_by_count(anchors.select("k1", "k2", "h"), shared, ["h"], "rows")
              .groupBy("k1", "k2").agg(F.collect_set("h").alias("hs")))
    # at most one row for each text and task meets here; any of them will do
    texts = _first_copies(keyed.select("k1", "k2", "text"))
    found = materialize(texts.join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"]))
    runs = materialize(found.mapInArrow(
        _extend(length, seed), "k1 long, k2 long, h long, c long, lo int, hi int, w array<long>"))

    contexts = runs.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min("k1").alias("k1"),
                                          F.min(F.struct("k1", "k2", "lo")).alias("one"))
    contexts = materialize(contexts.select("h", "c", "n", "one"))
    whole = (join_by_count(runs.select("k1", "k2", "h", "c", "lo", "hi"),
                           contexts.where("n > 1").select("h", "c", "n"), ["h", "c"], "n")
             .select("k1", "k2", "lo", "hi"))
    # anchors with a context found once: compare windows, one run for each context
    open_anchors = materialize(contexts.groupBy("h").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("rows"))
                               .where("least = 1").select("h", "rows"))
    one = (join_by_count(contexts, open_anchors, ["h"], "rows")
           .select("h", "n", "one.k1", "one.k2", "one.lo"))
    # the run's windows: 16-word seeds and 64-bit window hashes together identify a window
    windows = materialize(runs.join(one, ["h", "k1", "k2", "lo"])
                          .select("h", "n", "k1", "k2", "lo", F.posexplode("w").alias("i", "w")))
    twice = materialize(
        windows.groupBy("h", "w").agg(F.sum("n").alias("times"), F.min("n").alias("least"), F.count_if(F.col("n") == 1).alias("rows"))
        .where("times > 1 and least = 1").select("h", "w", "rows"))
    start = (F.col("lo") + F.col("i")).cast("int")
    single = (join_by_count(windows.where("n = 1"), twice, ["h", "w"], "rows")
              .select("k1", "k2", start.alias("lo"), start.alias("hi")))
    # a key's rows are known by count, so the joins' hot keys stay out of the shuffles
    whole, single = materialize_many(whole, single)
    return seeded, found, whole.unionByName(single)


def _prepare(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*text_key(F.col(text_col)), F.col(id_col).alias("id"), text.alias("text"))


def _cut(length: int, with_text: bool):
    """Drop the words that repeated windows cover."""
    table = space_table()

    def work(rows: pa.RecordBatch, texts: Texts) -> dict:
        words = Words(texts, table)
        spans = rows.column(rows.schema.get_field_index("spans"))
        row = np.repeat(np.arange(texts.n), np.diff(spans.offsets.to_numpy()))
        flat = spans.flatten()
        lo = flat.field(0).to_numpy(zero_copy_only=False) + words.bounds[row]
        hi = flat.field(1).to_numpy(zero_copy_only=False) + words.bounds[row] + length
        cover = np.zeros(len(words.doc) + 1, dtype=np.int64)
        np.add.at(cover, lo, 1)
        np.add.at(cover, hi, -1)
        gone = np.cumsum(cover[:-1]) > 0
        kept = []
        for i in range(texts.n):
            a, b = words.bounds[i], words.bounds[i + 1]
            left = np.flatnonzero(~gone[a:b])
            split = texts.text(i).split()
            kept.append(b" ".join([split[j] for j in left]))
        out = {"n_removed": np.bincount(words.doc[gone], minlength=texts.n).astype(np.int64),
               "kept_sha": [hashlib.sha256(k).hexdigest() for k in kept]}
        if with_text:
            out["kept_text"] = [k.decode() for k in kept]
        return out

    return work


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, seed: int = SEED, with_text: bool = False) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_removed, kept_sha256 and, if ``with_text``,
    the kept words joined by one space as ``kept_text``.

    Every word covered by a window of ``length`` words that also starts elsewhere, in the
    same or another document, is removed; windows are judged on the input.  A null text has
    no words (kept as null under ``with_text``); ids are carried through, null or repeated;
    rows repeated whole are copies of each other; other columns are ignored; an empty table
    gives an empty result.
    """
    if not 1 <= seed <= length:
        raise ValueError("seed must lie between 1 and length")
    keyed = _prepare(docs, id_col, text_col)
    seeded, found, spans = _search(keyed, length, seed)
    grouped = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    new = "n_removed long, kept_sha string" + (", kept_text string" if with_text else "")
    cut = arrow_map(found.select("k1", "k2", "text").join(grouped, ["k1", "k2"]), _cut(length, with_text),
                    new, "text", ("k1", "k2"))
    copies = (seeded.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"))
              .where("copies > 1"))
    out = (seeded.select("id", "k1", "k2", "n_words", "sha")
           .join(copies, ["k1", "k2"], "left").join(cut, ["k1", "k2"], "left"))
    whole = F.col("copies").isNotNull() & (F.col("n_words") >= length)
    columns = [
        F.col("id").alias(id_col), "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256")]
    if not with_text:
        return out.select(*columns)
    # untouched texts are read again from the input, by key
    own = F.regexp_replace(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), "^ | $", "")
    first = _first_copies(keyed.select("k1", "k2", "text")).dropDuplicates(["k1", "k2"])
    return out.join(first, ["k1", "k2"]).select(
        *columns, F.when(whole, F.lit("")).otherwise(F.coalesce("kept_text", own)).alias("kept_text"))


def repeat_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Maximal repeats of distinct texts: k1, k2 (key of the text), first word and number of words.

    Overlapping and touching windows are merged; whole copies, so also repeated rows, count once.  A null
    text is empty and, like any text of fewer than ``length`` words, has no repeat; other columns
    are ignored; an empty table gives an empty result.
    """
    keyed = _prepare(docs.select(text_col).withColumn("_none", F.lit(0)), "_none", text_col)
    _, _, spans = _search(keyed, length, seed)

    def merge(batches):
        for batch in batches:
            k1, k2, first, n = [], [], [], []
            for row in batch.to_pylist():
                end = None
                for lo, hi in sorted((s["lo"], s["hi"] + length) for s in row["spans"]):
                    if end is None or lo > end:
                        k1.append(row["k1"]), k2.append(row["k2"]), first.append(lo), n.append(hi - lo)
                        end = hi
                    elif hi > end:
                        n[-1] += hi - end
                        end = hi
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(first, pa.int64()), pa.array(n, pa.int64())],
                names=["k1", "k2", "first_word", "n_words"])

    return (spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
            .mapInArrow(merge, "k1 long, k2 long, first_word long, n_words long"))
