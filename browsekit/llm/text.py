"""Words, lines and hashes of whole batches of texts, vectorised in numpy.

A batch is the raw UTF-8 buffer of an Arrow string column: the separators used
here are ASCII bytes, which never occur inside a multi-byte character, so words
and lines can be found byte by byte without decoding.  Work is done in slices
of about ``SLICE_BYTES`` so that temporaries stay small however large the batch;
one text is never split (a longer text is a slice of its own).
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19
BATCH_BYTES = 2 << 20   # bytes of rows that Spark sends a Python worker at a time, at most (or one row)
_P1, _P2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93   # odd multipliers of the rolling hashes
BLOCK = 1 << 16     # values hashed at a time: what a hash holds beside its result does not grow with a text
U64 = np.uint64


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process."""
    name = "browsekit_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def byte_table(separators) -> np.ndarray:
    """256 booleans: True for bytes that belong to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


def space_table() -> np.ndarray:
    """Words are ``[^\\x20\\x09-\\x0D]+``."""
    return byte_table([0x20, *range(0x09, 0x0E)])


def powers(p: int) -> tuple[np.ndarray, np.ndarray]:
    """``p**i`` and ``p**-i`` modulo 2**64 for i up to ``BLOCK``, kept per worker."""
    cache = worker_cache()
    if ("powers", p) not in cache:
        both = []
        for base in (p, pow(p, -1, 1 << 64)):
            x = np.full(BLOCK + 1, base, dtype=U64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=U64))
        cache[("powers", p)] = tuple(both)
    return cache[("powers", p)]


def prefix_at(n: int, at: np.ndarray, sums: Callable[[int, int], np.ndarray], grow: int = 1) -> np.ndarray:
    """Prefix sums of n values at the positions ``at`` (0..n), holding one block at a time.

    ``sums(a, b)`` gives the running sums of the values a..b-1 of a block; the sums of block
    k count ``grow**(k * BLOCK)`` times (modulo 2**64).
    """
    order = None
    if len(at) > 1 and (at[1:] < at[:-1]).any():
        order = np.argsort(at, kind="stable")
        at = at[order]
    out = np.zeros(len(at), dtype=U64)
    cuts = np.searchsorted(at, np.arange(0, n + BLOCK, BLOCK), side="right")
    carry, scale, step = 0, 1, pow(grow, BLOCK, 1 << 64)
    for k, a in enumerate(range(0, n, BLOCK)):
        part = sums(a, min(n, a + BLOCK))
        lo, hi = cuts[k], cuts[k + 1] if k + 1 < len(cuts) else len(at)
        out[lo:hi] = U64(carry) + U64(scale) * part[at[lo:hi] - a - 1].astype(U64)
        carry = (carry + scale * int(part[-1])) % (1 << 64)
        scale = scale * step % (1 << 64)
    if order is None:
        return out
    back = np.empty_like(out)
    back[order] = out
    return back


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, p: int = _P1) -> np.ndarray:
    """Rolling (prefix) polynomial hash of ``values[start:end]`` for each span."""
    up, down = powers(p)
    start, end = np.asarray(start), np.asarray(end)

    def sums(a, b):
        x = values[a:b].astype(U64)
        x += U64(1)
        x *= up[1:b - a + 1]
        return np.cumsum(x, out=x)

    n = len(values)
    between = prefix_at(n, end, sums, p) - prefix_at(n, start, sums, p)
    back = down[start & (BLOCK - 1)]        # p**-start, from its low and high bits
    if n > BLOCK:
        high, base = np.ones(n // BLOCK + 1, dtype=U64), int(down[BLOCK])
        for i in range(1, len(high)):
            high[i] = int(high[i - 1]) * base % (1 << 64)
        back = back * high[start // BLOCK]
    return mix(between * back ^ mix((end - start).astype(U64)))


def window_hash(values: np.ndarray, n: int, p: int = _P2) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values (``len - n + 1`` of them)."""
    if len(values) < n:
        return np.zeros(0, dtype=U64)
    up, down = powers(p)
    out = np.empty(len(values) - n + 1, dtype=U64)
    prefix = np.zeros(BLOCK + 1, dtype=U64)
    for a in range(0, len(out), BLOCK - n + 1):
        part = values[a:a + BLOCK]
        sums = prefix[:len(part) + 1]
        np.cumsum(part * up[1:len(part) + 1], out=sums[1:])
        got = sums[n:] - sums[:-n]
        got *= down[:len(got)]
        out[a:a + len(got)] = mix(got)
    return out


class Texts:
    """Some texts of an Arrow string column: ``data`` is their UTF-8, ``bounds`` the n + 1 offsets."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds, self.n = data, bounds, len(bounds) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text in which each byte offset lies."""
        return np.searchsorted(self.bounds, at, side="right") - 1

    def runs(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end offsets of the maximal runs of True, cut at the texts' bounds."""
        start, end = mask.copy(), mask.copy()
        start[1:] &= ~mask[:-1]
        end[:-1] &= ~mask[1:]
        first, last = self.bounds[self.bounds < len(mask)], self.bounds[self.bounds > 0] - 1
        start[first], end[last] = mask[first], mask[last]
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def chars_before(self, at: np.ndarray) -> np.ndarray:
        """Number of code points that begin before each of the byte offsets ``at``."""
        return self.count_before((np.arange(256) & 0xC0) != 0x80, at)

    def count_before(self, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of bytes for which ``table`` is True before each of the byte offsets ``at``."""
        return prefix_at(len(self.data), np.asarray(at), lambda a, b: np.cumsum(table[self.data[a:b]], dtype=np.int64)).view(np.int64)


class Words:
    """The words of some texts: byte spans, owning text, 64-bit hash, and where each text's words begin."""

    def __init__(self, texts: Texts, table: np.ndarray):
        self.start, self.end = texts.runs(table[texts.data])
        self.doc = texts.owner(self.start)
        self.hash = span_hash(texts.data, self.start, self.end)
        self.bounds = np.searchsorted(self.doc, np.arange(texts.n + 1))
        self.count = np.diff(self.bounds)

    def windows(self, n: int) -> np.ndarray:
        """Positions at which ``n`` consecutive words of one text begin."""
        if len(self.doc) < n:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.doc[: len(self.doc) - n + 1] == self.doc[n - 1:])


def slices(array: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """(first row, texts) for consecutive rows of a string column; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    n = len(array)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], dtype=kind)[array.offset: array.offset + n + 1].astype(np.int64)
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, Texts(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends rows to Python in batches of at most ``BATCH_BYTES``.  Spark's
    own bounds (10,000 rows, 64 MB) let each task hold whole partitions of texts, in the JVM beside
    its heap and again in the worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch, Texts], dict], schema: str,
              text_col: str, keep: tuple[str, ...] = (), max_bytes: int = SLICE_BYTES,
              per_task: bool = False) -> DataFrame:
    """``mapInArrow`` over slices: ``work(rows, texts)`` gives one array per new column, and the
    columns in ``keep`` are carried over.  ``schema`` is the DDL of the new columns.  With
    ``per_task``, ``work()`` is called once a task and gives that function (for state)."""
    kept = df.select(*keep).schema
    new = df.sparkSession.createDataFrame([], schema).schema
    out = type(new)([*kept.fields, *new.fields])

    def run(batches):
        step = work() if per_task else work
        for batch in batches:
            for at, texts in slices(batch.column(batch.schema.get_field_index(text_col)), max_bytes):
                rows = batch.slice(at, texts.n)
                made = step(rows, texts)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(rows.schema.get_field_index(c)) for c in keep),
                     *(made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name])
                       for f in new.fields)],
                    names=[*keep, *(f.name for f in new.fields)])

    return bound_batches(df).mapInArrow(run, out)


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows ``values[bounds[i]:bounds[i + 1]]`` as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(values))


def group_sum(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer values per group 0..n-1."""
    return np.bincount(group, weights=values, minlength=n).astype(np.int64)


def in_groups(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: True where the key equals its predecessor; True where its group has two or more."""
    again = np.zeros(len(sorted_keys), dtype=bool)
    again[1:] = sorted_keys[1:] == sorted_keys[:-1]
    many = again.copy()
    many[:-1] |= again[1:]
    return again, many


def in_share(share: float, *columns) -> Column:
    """True for about the given share of the values of some columns, by hash: cuts a table down
    before the first rows in some order are taken, so that few rows meet whatever its size."""
    return F.pmod(F.xxhash64(F.lit("share"), *columns), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)) + 1


def text_key(text: Column) -> list[Column]:
    """128-bit identity of a text (null counts as empty), computed in the JVM: columns k1 and k2."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(20240229), text).alias("k2")]
