"""Packing of documents into training sequences (operator 1).

A document's ids and an end id are cut into pieces.  Whole multiples of the
capacity are sequences of their own; the rest of a document is cut into pieces of
``capacity / CUT`` and a shorter last one, which are packed by Karmarkar-Karp differencing:
every piece starts as a partition of k windows with one full window; the two
partitions with the largest imbalance are merged, the fullest window of one with
the emptiest of the other, until one partition of near-equal windows is left.  If
its fullest window exceeds the capacity, k rises and differencing starts again.

Only piece lengths take part in the packing, in blocks of about ``BLOCK`` windows
dealt out by hash, so a block is bounded whatever the documents are.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import Texts, arrow_map
from .tokens import encoder

CAPACITY = 2048
END_ID = 1
CUT = 8         # the rest of a document is cut every capacity / CUT ids
BLOCK = 192     # windows of one differencing run, about


def differencing(sizes: Sequence[int], k: int) -> np.ndarray:
    """Karmarkar-Karp: the window (0..k-1) of each item, with near-equal sums."""
    n = len(sizes)
    sizes = np.asarray(sizes, dtype=np.int64)
    heap, merges = [], []
    node = 0
    for i in range(n):      # sums ascending, and which tree node each window is
        sums = np.zeros(k, dtype=np.int64)
        sums[-1] = sizes[i]
        nodes = np.full(k, -1, dtype=np.int64)
        nodes[-1] = node
        node += 1
        heap.append((-int(sizes[i]) if k > 1 else 0, i, sums, nodes))
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(sums, kind="stable")
        new = np.arange(node, node + k)
        merges.append((node, an, bn[::-1]))
        node += k
        sums = sums[order]
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), serial, sums - sums[0], new[order]))
        serial += 1
    label = np.full(node + 1, -1, dtype=np.int64)   # the last cell takes what the empty windows get
    if heap:
        last = heap[0][3]
        label[last] = np.arange(k)
        label[-1] = -1
        for base, an, bn in reversed(merges):
            own = label[base:base + k]
            label[an] = own
            label[bn] = own
            label[-1] = -1
    return label[:n]


def windows_of(sizes: Sequence[int], capacity: int) -> np.ndarray:
    """The window of each piece: as few windows as differencing fits within the capacity."""
    sizes = np.asarray(sizes, dtype=np.int64)
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    if sizes.max() > capacity:
        raise ValueError("a piece is longer than the capacity")
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, weights=sizes, minlength=k).max() <= capacity:
            return window
        k += 1


def cut_points(n: int, capacity: int, cut: int = CUT) -> list[tuple[int, int, bool]]:
    """(start, length, whole sequence?) of the pieces of a document of n ids."""
    full = n // capacity
    out = [(i * capacity, capacity, True) for i in range(full)]
    step = max(1, capacity // cut)
    return out + [(at, min(step, n - at), False) for at in range(full * capacity, n, step)]


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per document: ``id_col``, doc_tokens and its pieces (start, length, ids_crc32,
    whole and, ``with_ids``, the ids as little-endian unsigned 32-bit binary)."""
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    piece = "start:bigint,length:bigint,ids_crc32:bigint,whole:boolean" + (",ids:binary" if with_ids else "")

    def start():
        encode = encoder(tokenizer_path).encode

        def work(_, texts: Texts) -> dict:
            ids, bounds = encode(texts)
            end = np.array([end_id], dtype="<u4").tobytes()
            rows, per_text, sizes = [], [0], []
            for i in range(texts.n):
                raw = ids[bounds[i]:bounds[i + 1]].tobytes() + end
                sizes.append(len(raw) // 4)
                for at, n, whole in cut_points(sizes[-1], capacity):
                    part = raw[4 * at:4 * (at + n)]
                    rows.append((at, n, zlib.crc32(part), whole, part))
                per_text.append(len(rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            names = ["start", "length", "ids_crc32", "whole", "ids"]
            columns = list(zip(*rows)) if rows else [[]] * 5
            fields = [pa.array(c, type=t) for c, t in zip(columns, kinds)][: 5 if with_ids else 4]
            return {"doc_tokens": np.array(sizes, dtype=np.int64),
                    "pieces": pa.ListArray.from_arrays(pa.array(per_text, type=pa.int32()),
                                                       pa.StructArray.from_arrays(fields, names=names[:len(fields)]))}

        return work

    return (arrow_map(x, start, f"doc_tokens long, pieces array<struct<{piece}>>", "_text", ("_id",),
                      max_bytes=1 << 19, per_task=True)
            .withColumnRenamed("_id", id_col))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
                   block: int = BLOCK) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids with ``with_ids``).

    Every id of every document lies in exactly one piece; the pieces of a sequence fill it
    from offset 0 without gaps, at most ``capacity`` ids.  A null or empty text is its end id
    alone.  Ids of documents may be null or repeat (each row is packed by itself); other
    columns are ignored; an empty table gives an empty result.
    """
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids)
    pieces = materialize(pieces.select(F.col(id_col).alias("doc"), "doc_tokens", F.explode("pieces").alias("p"))
                         .select("doc", "doc_tokens", "p.*").withColumn("piece", F.monotonically_increasing_id()))
    whole = pieces.where("whole").select("piece", (F.col("piece") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where("not whole").select("piece", "length")
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, round(tokens / (block * capacity)))

    def pack(table: pa.Table) -> pa.Table:
        piece = table.column("piece").to_numpy()
        order = np.argsort(piece)
        piece, length = piece[order], table.column("length").to_numpy()[order]
        window = windows_of(length, capacity)
        at = np.argsort(window, kind="stable")
        size = length[at]
        before = np.cumsum(size) - size
        first = np.ones(len(at), dtype=bool)
        first[1:] = window[at][1:] != window[at][:-1]
        offset = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(at))))
        number = table.column("block")[0].as_py()
        return pa.table({"piece": piece[at], "sequence_id": ((number << 20) + window[at]) * 2 + 1, "offset": offset})

    packed = (rest.withColumn("block", F.pmod(F.xxhash64("piece"), F.lit(blocks)))
              .groupBy("block").applyInArrow(pack, "piece long, sequence_id long, offset long"))
    placed = whole.unionByName(packed)
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return (pieces.drop("whole").join(placed, "piece")
            .select(F.col("doc").alias(id_col), *columns))


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows of ``pack_documents(..., with_ids=True)`` as sequences: sequence_id, n_tokens, ids."""
    part = F.struct("offset", "ids")
    return (packed.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(part)).alias("parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
