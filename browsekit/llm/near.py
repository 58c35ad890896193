"""Near-duplicate documents by DartMinHash signatures (operator 3).

Sketch.  A text is a weighted set of shingles (``words`` consecutive words).  Every
shingle owns an endless sheet of darts, the same in every text: a Poisson process
over weight x rank, laid out in weight layers [0,1), [1,2), [2,4), ... whose darts
come in order of rank.  A text throws the darts that fall under its shingles'
weights with a rank below a bound chosen so that about k (ln k + 2) darts hit;
each dart belongs to one of k coordinates, and the earliest dart of a coordinate
is the sketch there (with the bound doubled for the few texts that leave one
empty).  Two texts agree in a coordinate with probability their weighted Jaccard
likeness, at a cost that does not grow with k times the number of shingles.

Join.  ``rows`` coordinates make a band; texts that agree in a band share a bucket.
No bucket is expanded into pairs.  Each bucket has a leader (the text with the
most bucket neighbours, so the original of a group leads all its buckets); every
member is compared with the leaders of its buckets, exactly, on its shingles.
Links give components.  Only buckets that still hold several components go on:
there, members outside the leader's component are compared with the others, unless
their differences from the leader prove that the pair cannot reach the threshold
(see ``_across``).  So no link between components is lost but those that no band
catches: (1 - 0.8**rows)**bands, 5e-8 at the threshold.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components
from .substring import _first_copies
from .text import Texts, Words, arrow_map, list_array, mix, space_table, span_hash, text_key, window_hash

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
_BLOCKS = (1, 4, 16, 64)    # darts drawn at a time; the last size repeats


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform (0, 1] from 64 hash bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles_of(words: Words, n_texts: int, size: int, counted: bool = False):
    """(text, shingle hash, weight) of the distinct shingles, sorted by text and hash.

    A text of fewer words than ``size`` has one shingle, all its words; one without
    words has none.  Weights are 1, or with ``counted`` the number of occurrences.
    """
    at = words.windows(size)
    value, doc = window_hash(words.hash, size)[at], words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        value = np.append(value, span_hash(words.hash, words.bounds[short], words.bounds[short + 1]))
        doc = np.append(doc, short)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    times = np.diff(np.append(first, len(value))).astype(np.float64)
    return doc[first], value[first], times if counted else np.ones(len(first))


def dart_sketch(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """(n_texts, k) sketches of weighted sets; texts without weight get zeros."""
    sketch = np.zeros((n_texts, k), dtype=np.uint64)
    live = weight > 0
    doc, element, weight = doc[live], element[live], weight[live]
    total = np.bincount(doc, weights=weight, minlength=n_texts)
    bound = np.zeros(n_texts)
    np.divide(k * (math.log(k) + 2), total, out=bound, where=total > 0)
    todo = total > 0
    while todo.any():
        use = todo[doc]
        best = np.full(n_texts * k, np.inf)
        thrown = []
        for d, rank, cell, ident in _darts(doc[use], element[use], weight[use], bound, k):
            slot = d * k + cell
            np.minimum.at(best, slot, rank)
            thrown.append((slot, rank, ident))
        flat = sketch.reshape(-1)
        for slot, rank, ident in thrown:
            won = rank == best[slot]
            flat[slot[won]] = ident[won]
        empty = np.isinf(best.reshape(n_texts, k)).any(axis=1)
        todo &= empty
        bound[todo] *= 2
    return sketch


def _darts(doc, element, weight, bound, k):
    """Blocks of darts (text, rank, coordinate, identity) with rank below the text's bound."""
    top = int(np.ceil(np.log2(weight.max()))) if len(weight) and weight.max() > 1 else 0
    for layer in range(top + 1):
        low, width = (0.0, 1.0) if layer == 0 else (2.0 ** (layer - 1), 2.0 ** (layer - 1))
        inside = np.flatnonzero(weight > low)
        seed = mix(element[inside] ^ mix(np.full(1, layer + 1, dtype=np.uint64)))
        rank, drawn, block = np.zeros(len(inside)), 0, 0
        while len(inside):
            n = _BLOCKS[min(block, len(_BLOCKS) - 1)]
            serial = mix(np.arange(drawn, drawn + n, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
            ident = mix(seed[:, None] ^ serial[None, :])
            step = -np.log(_unit(ident)) / width
            ranks = rank[:, None] + np.cumsum(step, axis=1)
            where = mix(ident + np.uint64(0x2545F4914F6CDD1D))
            hit = ranks < bound[doc[inside]][:, None]
            if layer or (weight[inside] < low + width).any():
                hit &= low + width * _unit(mix(where)) <= weight[inside][:, None]
            row, col = np.nonzero(hit)
            got = where[row, col]
            yield doc[inside[row]], ranks[row, col], ((got >> np.uint64(32)) % np.uint64(k)).astype(np.int64), ident[row, col]
            on = ranks[:, -1] < bound[doc[inside]]
            inside, seed, rank = inside[on], seed[on], ranks[on, -1]
            drawn, block = drawn + n, block + 1


def _bands(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sketch), bands))
    for i in range(rows):
        key = mix((key + part[:, :, i]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i))
    return key


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
               bands: int = BANDS, rows: int = ROWS, counted: bool = False) -> DataFrame:
    """Per document: ``id_col``, n (distinct shingles) and ``bands`` (one hash for each band;
    empty for a text without words).  ``counted`` weighs shingles by their occurrences."""
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return (arrow_map(x, _signature_work(size, bands, rows, counted), "n int, bands array<long>", "_text", ("_id",))
            .withColumnRenamed("_id", id_col))


def _signature_work(size, bands, rows, counted=False):
    table = space_table()

    def work(_, texts: Texts) -> dict:
        words = Words(texts, table)
        doc, element, weight = shingles_of(words, texts.n, size, counted)
        sketch = dart_sketch(doc, element, weight, texts.n, bands * rows)
        n = np.bincount(doc, minlength=texts.n).astype(np.int32)
        full = n > 0
        return {"n": n, "bands": list_array(_bands(sketch[full], bands, rows).view(np.int64).ravel(),
                                            np.append(0, np.cumsum(full * bands)))}

    return work


def _shingle_work(size):
    table = space_table()

    def work(_, texts: Texts) -> dict:
        doc, element, _ = shingles_of(Words(texts, table), texts.n, size)
        return {"sh": list_array(element.view(np.int64), np.searchsorted(doc, np.arange(texts.n + 1)))}

    return work


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their shingle sets, na and nb, and of what they share, both."""
    left = sets.select(F.col("t").alias("a"), F.col("sh").alias("sa"))
    right = sets.select(F.col("t").alias("b"), F.col("sh").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both"))


def _likeness() -> Column:
    return F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           threshold: float = THRESHOLD, size: int = SHINGLE,
                           bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``id_col``, class_id, class_size, keep.

    Documents are linked when the sets of their shingles of ``size`` words have a Jaccard
    likeness of at least ``threshold`` (equal texts always are); classes are the connected
    components.  ``class_id`` is the smallest id in the class (null if all are null), ``keep``
    marks one document of each class: the smallest id, and of rows that tie on it the first
    read.  Texts without words (null, empty, blank) are linked to nothing and are classes of
    their own.  Other columns are ignored; an empty table gives an empty result.
    """
    keyed = docs.select(*text_key(F.col(text_col)), F.col(id_col).alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = materialize(arrow_map(keyed, _signature_work(size, bands, rows), "n int, bands array<long>",
                                   "text", ("k1", "k2", "id"))
                         .withColumn("t", F.monotonically_increasing_id()))
    texts = materialize(signed.where("n > 0").groupBy("k1", "k2").agg(F.min("t").alias("t")))
    buckets = (signed.join(texts.select("t"), "t")
               .select("t", "n", F.explode("bands").alias("b")))
    shared = (buckets.groupBy("b").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    buckets = materialize(buckets.join(shared, "b"))
    central = buckets.groupBy("t").agg(F.sum("members").alias("degree"))
    leaders = (buckets.join(central, "t").groupBy("b")
               .agg(F.max(F.struct("degree", "t")).alias("top")).select("b", F.col("top.t").alias("a")))
    buckets = materialize(buckets.select("b", "t").join(leaders, "b"))
    pairs = buckets.where("t <> a").select("a", F.col("t").alias("b")).distinct()

    # shingles of the texts that meet another in a bucket
    met = buckets.select("t").distinct().join(texts, "t")
    # at most one row for each text and task meets here; any of them will do
    found = (_first_copies(keyed.select("k1", "k2", "text")).join(met, ["k1", "k2"])
             .dropDuplicates(["k1", "k2"]).select("t", "text"))
    sets = materialize(arrow_map(found, _shingle_work(size), "sh array<long>", "text", ("t",)))
    stars = materialize(_compared(pairs, sets))
    links = materialize(stars.where(_likeness() >= threshold).select("a", "b"))
    labels = connected_components(links)

    more = _compared(_across(buckets, labels, stars, sets, threshold), sets)
    more = materialize(more.where(_likeness() >= threshold).select("a", "b"))
    if more.limit(1).count():
        labels = connected_components(links.unionByName(more))
    of_text = (texts.join(labels.withColumnRenamed("node", "t"), "t", "left")
               .select("k1", "k2", F.coalesce("label", "t").alias("label")))
    rows_ = signed.join(of_text, ["k1", "k2"], "left").select(
        "id", "t", F.coalesce("label", "t").alias("label"))
    first = (rows_.groupBy("label")
             .agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                  F.min(F.struct(F.col("id").isNull(), "id", "t")).alias("least")))
    return (rows_.join(first, "label")
            .select(F.col("id").alias(id_col), "class_id", "class_size",
                    (F.col("t") == F.col("least.t")).alias("keep")))


def _across(buckets: DataFrame, labels: DataFrame, stars: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs between different components of one bucket that may still reach the threshold.

    The texts that meet one leader are a star; its *core* M is the set of shingles that more
    than half of them have.  A text x lacks ``gone`` shingles of the core and has ``own`` ones
    beyond it.  Two texts share |M| - gone_x - gone_y shingles, plus those of the core that
    both lack, plus those beyond it that both have.  Neither of the last two can exceed the
    number of differences of x, or of y, that are not its own alone in the star.  In a large
    group of copies with edits of their own, these numbers settle nearly every pair before any
    row is made of it; what is left is emitted once, in the first bucket that both share.
    """
    known = labels.withColumnRenamed("node", "t")
    member = (buckets.join(known, "t", "left").select("b", "t", "a", F.coalesce("label", "t").alias("label"))
              .join(labels.select(F.col("node").alias("a"), F.col("label").alias("main")), "a", "left")
              .withColumn("main", F.coalesce("main", "a")))
    split = member.where("label <> main").select("b").distinct()
    member = materialize(member.join(split, "b"))
    star = materialize(member.groupBy("a", "t").agg(F.array_sort(F.collect_set("b")).alias("bs")))

    each = star.select("a", "t").join(sets, "t").select("a", "t", F.explode("sh").alias("s"))
    width = star.groupBy("a").agg(F.count(F.lit(1)).alias("width"), F.bit_xor("t").alias("all"))
    having = (each.groupBy("a", "s").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("t").alias("those"))
              .join(width, "a").withColumn("core", F.col("n") * 2 > F.col("width")))
    # the only text that lacks a core shingle, or that has one beyond the core
    lone = F.when(F.col("core") & (F.col("n") == F.col("width") - 1), F.col("all").bitwiseXOR(F.col("those"))) \
        .when(~F.col("core") & (F.col("n") == 1), F.col("those"))
    having = materialize(having.select("a", "s", "core", lone.alias("t")).where("core or t is not null"))
    core = having.where("core").groupBy("a").agg(F.collect_list("s").alias("core"))
    alone = (having.where("t is not null").groupBy("a", "t")
             .agg(F.count_if("core").alias("lone_gone"), F.count_if(~F.col("core")).alias("lone_own")))
    share = threshold / (1 + threshold)     # of both sizes, what a linked pair has in common
    none = F.array().cast("array<bigint>")
    facts = (star.join(sets, "t").join(core, "a", "left").join(alone, ["a", "t"], "left")
             .withColumn("core", F.coalesce("core", none))
             .withColumn("both", F.size(F.array_intersect("sh", "core")))
             .select("a", "t", "bs", F.size("core").alias("m"), F.size("sh").alias("n"),
                     (F.size("core") - F.col("both")).alias("gone"), (F.size("sh") - F.col("both")).alias("own"),
                     F.coalesce("lone_gone", F.lit(0)).alias("lone_gone"), F.coalesce("lone_own", F.lit(0)).alias("lone_own"))
             .withColumn("c_gone", F.col("gone") - F.col("lone_gone")).withColumn("c_own", F.col("own") - F.col("lone_own"))
             # a pair needs shared differences of at least lack_x + cost_y = lack_y + cost_x
             .withColumn("lack", share * F.col("n") - (1 - share) * F.col("m") + F.col("gone"))
             .withColumn("cost", (1 - share) * F.col("gone") + share * F.col("own"))
             .withColumn("slack", F.col("c_gone") + F.col("c_own") - F.col("cost"))
             .drop("lone_gone", "lone_own", "own", "cost"))
    member = materialize(member.where("t <> a").join(facts, ["a", "t"]))
    reach = member.groupBy("b").agg(F.max("slack").alias("most"), F.min(F.when(F.col("label") != F.col("main"), F.col("lack"))).alias("least"))
    member = member.join(reach, "b")
    asks = member.where("label <> main").where(F.col("most") >= F.col("lack") - 1e-6).where(F.col("c_gone") + F.col("c_own") >= F.col("lack") - 1e-6)
    answers = member.where(F.col("slack") >= F.col("least") - 1e-6)
    names = ("t", "n", "label", "gone", "c_gone", "c_own", "bs")
    x = asks.select("b", "m", "main", *(F.col(c).alias("x_" + c) for c in names))
    y = answers.select("b", *(F.col(c).alias("y_" + c) for c in names))
    shared = F.least("x_c_gone", "y_c_gone") + F.least("x_c_own", "y_c_own")
    pairs = (x.join(y, "b").where(F.col("x_label") != F.col("y_label"))
             # of two members outside the leader's component, one asks
             .where((F.col("y_label") == F.col("main")) | (F.col("x_t") < F.col("y_t")))
             .where(F.col("m") - F.col("x_gone") - F.col("y_gone") + shared >= share * (F.col("x_n") + F.col("y_n")) - 1e-6)
             .where(F.array_min(F.array_intersect("x_bs", "y_bs")) == F.col("b"))
             .select(F.col("x_t").alias("a"), F.col("y_t").alias("b")))
    return materialize(pairs.distinct())


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
                         size: int = SHINGLE, order_col: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, with one document of each class: the
    smallest ``order_col`` (null last), ties by a hash of the text.

    Rows are known by that order value and the key of their text, so the input is neither
    numbered nor written; of rows equal in both, one stays.
    """
    order = F.col(order_col) if order_col else F.lit(0)
    x = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"), *text_key(F.col(text_col)), order.alias("o"))
    ids = x.select(F.struct(F.col("o").isNull().alias("none"), "o", "k1", "k2").alias("_id"), "_text")
    rows = near_duplicate_classes(ids, "_id", "_text", threshold, size)
    kept = materialize(rows.groupBy("_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if("keep").alias("kept"))
                       .where("kept > 0").select(*(F.col(f"_id.{c}").alias("r_" + c) for c in ("o", "k1", "k2")), "rows", "kept"))
    same = F.col("o").eqNullSafe(F.col("r_o")) & (F.col("k1") == F.col("r_k1")) & (F.col("k2") == F.col("r_k2"))
    out = x.join(kept.where("kept = rows"), same, "left_semi").select("_row.*")
    repeated = kept.where("kept < rows")
    if repeated.limit(1).count():
        some = x.join(repeated, same, "left_semi").dropDuplicates(["o", "k1", "k2"])
        out = out.unionByName(some.select("_row.*"))
    return out
