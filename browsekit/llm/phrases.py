"""Phrase collocations by multikey three-way quicksort of suffix pointers (operator 13).

A text is split into pieces and words; every word position is a suffix pointer, and
the phrases that begin there are its leading words.  The count of a phrase is
the size of the partition of pointers with equal leading words that a multikey
three-way quicksort ends up with.  The sort goes a depth further only below
partitions that are large enough, so the work is split by depth:

1. Tasks cut their suffixes at the present depth, sort the pointers and send each
   equal partition once, with its size (a hot phrase costs one row for each few stretches
   of text, not one for each occurrence).
2. Rows are routed by a hash of all their leading words into groups of about
   ``GROUP`` rows, so neither a hot word nor a hot phrase fills a group.
3. Each group is sorted again; sizes are global now, and partitions of fewer than
   ``min_count`` are abandoned.
4. The next depth skips suffixes whose leading or following words were abandoned.
   Tasks know these from a bitmap of fixed size; what it lets through by accident is
   counted and abandoned in step 3, so the bitmap costs time at worst, never a count.

Words are 64-bit keys of language and word.  A group that finds two words behind one
key says so, and counting starts again under another seed: counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .importance import lower_ascii
from .text import Texts, byte_table, mix, slices, span_hash

MIN_WORDS, MAX_WORDS = 2, 3
MIN_COUNT = 10
COVER = 50          # a phrase goes if a longer one has at least this percentage of its count
TOP = 2000
GROUP = 1 << 19     # rows of one routed group, about
STRETCH = 1 << 21   # bytes of text whose pointers are sorted together
MERGE = 1 << 20     # rows a task gathers from its stretches before it merges and sends them
LEAF = 1 << 12      # smaller partitions are finished by a plain sort
FILTER_BITS = 1 << 26
_PER_ROW = 1 << 15  # bits of one row of Spark's bitmap aggregate
U64 = np.uint64
_MULTIPLIERS = [0x9E3779B97F4A7C15 + 2 * i for i in range(8)]   # of the word hash under each seed; odd
_APART = 0xD6E8FEB86659FD93


def equal_partitions(keys: list[np.ndarray], size: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of pointers 0..n-1 by their keys, one array for each depth.

    Returns (a pointer, total size) of every partition of pointers equal at all depths whose
    size is at least ``least``; partitions that fall below it on the way are not sorted on.
    """
    found, total = [], []
    todo = [(np.arange(len(size)), 0)]
    while todo:
        part, depth = todo.pop()
        if not len(part) or (weight := int(size[part].sum())) < least:
            continue
        if depth == len(keys):
            found.append(part[:1])
            total.append([weight])
        elif len(part) <= LEAF:
            part = part[np.lexsort([k[part] for k in reversed(keys[depth:])])]
            new = np.zeros(len(part), dtype=bool)
            new[0] = True
            for k in keys[depth:]:
                new[1:] |= k[part[1:]] != k[part[:-1]]
            first = np.flatnonzero(new)
            weights = np.add.reduceat(size[part], first)
            found.append(part[first[weights >= least]])
            total.append(weights[weights >= least])
        else:
            key = keys[depth][part]
            pivot = np.partition(key[[0, len(key) // 2, -1]], 1)[1]
            less, more = key < pivot, key > pivot
            todo += [(part[less], depth), (part[more], depth), (part[~(less | more)], depth + 1)]
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found), np.concatenate(total).astype(np.int64)


class Suffixes:
    """The words of some texts: byte spans, owning text, key of each, and whether the next
    word follows in the same piece."""

    def __init__(self, texts: Texts, seed: int, langs: np.ndarray):
        self.data = lower_ascii(texts.data)
        blank, stop = byte_table([0x20, 0x09]), byte_table([*b".,;:!?", *range(0x0A, 0x0E)])
        self.start, self.end = texts.runs((blank & stop)[self.data])
        self.doc = texts.owner(self.start)
        self.key = mix(span_hash(self.data, self.start, self.end, _MULTIPLIERS[seed]) + mix(langs[self.doc] + U64(seed)))
        before = Texts(self.data, texts.bounds).count_before
        self.joined = np.zeros(len(self.start), dtype=bool)
        if len(self.start):
            apart = before(~stop, self.start[1:]) - before(~stop, self.end[:-1])
            self.joined[:-1] = (self.doc[1:] == self.doc[:-1]) & (apart == 0)

    def at_depth(self, depth: int) -> np.ndarray:
        """Positions at which ``depth`` words follow one another in a piece."""
        n = len(self.start) - depth + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        whole = np.ones(n, dtype=bool)
        for i in range(depth - 1):
            whole &= self.joined[i:i + n]
        return np.flatnonzero(whole)


def _phrase_key(keys: list[np.ndarray]) -> np.ndarray:
    return reduce(lambda a, b: mix(a * U64(0x9E3779B97F4A7C15) + b), keys)


def _lang_keys(langs: list[str]) -> np.ndarray:
    raw = [x.encode() for x in langs]
    end = np.cumsum([len(x) for x in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return span_hash(data, np.append(0, end[:-1]), end)


def _partials(docs: DataFrame, depth: int, seed: int, known: np.ndarray | None) -> DataFrame:
    """Equal partitions of the stretches of text of a task, merged as they come: key (depth longs), n; at depth 1 also lang and word."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(known) if known is not None else None     # FILTER_BITS / 8 bytes

    def seen(keys: np.ndarray) -> np.ndarray:
        at = (keys & U64(FILTER_BITS - 1)).astype(np.int64)
        return (bits.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def merged(held: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(held).combine_chunks()
        keys = [table.column(f"k{i}").to_numpy().view(U64) for i in range(depth)]
        apart = [table.column("apart").to_numpy().view(U64)] if depth == 1 else []
        chosen, n = equal_partitions(keys + apart, table.column("n").to_numpy())
        return table.take(pa.array(chosen)).set_column(table.column_names.index("n"), "n", pa.array(n))

    def sent(table: pa.Table):
        yield from (table.drop_columns(["apart"]) if depth == 1 else table).to_batches()

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for at, texts in slices(batch.column("text"), STRETCH):
                held.append(_stretch(texts, names[at:at + texts.n], depth, seed, seen if bits is not None else None))
                rows += len(held[-1])
                if rows > MERGE:
                    held = [merged(held)]
                    rows = len(held[0])
                    if rows > MERGE // 2:
                        yield from sent(held[0])
                        held, rows = [], 0
        if held:
            yield from sent(merged(held))

    return docs.mapInArrow(run, _schema(depth))


def _stretch(texts: Texts, langs: list[str], depth: int, seed: int, seen) -> pa.Table:
    """The equal partitions of one stretch of text."""
    kinds = sorted(set(langs))
    place = {x: i for i, x in enumerate(kinds)}
    lang = np.array([place[x] for x in langs], dtype=np.int64)
    s = Suffixes(texts, seed, _lang_keys(kinds)[lang])
    where = s.at_depth(depth)
    if seen is not None:
        leading = seen(_phrase_key([s.key[i:len(s.key) - depth + 2 + i] for i in range(depth - 1)]))
        where = where[leading[where] & leading[where + 1]]
    keys = [s.key[where + i] for i in range(depth)]
    # words behind one key stay apart here, so that the group they meet in can tell
    apart = [span_hash(s.data, s.start, s.end, _APART)[where]] if depth == 1 else []
    chosen, n = equal_partitions(keys + apart, np.ones(len(where), dtype=np.int64))
    columns = {f"k{i}": pa.array(np.ascontiguousarray(k[chosen]).view(np.int64)) for i, k in enumerate(keys)}
    columns["n"] = pa.array(n)
    if depth == 1:
        columns["lang"] = pa.array(kinds, type=pa.string()).take(pa.array(lang[s.doc[where[chosen]]]))
        columns["word"] = _strings(s.data, s.start[where[chosen]], s.end[where[chosen]])
        columns["apart"] = pa.array(apart[0][chosen].view(np.int64))
    return pa.table(columns)


def _schema(depth: int) -> str:
    return ", ".join(f"k{i} long" for i in range(depth)) + ", n long" + (", lang string, word string" if depth == 1 else "")


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """``data[start:end]`` of each span as an Arrow string column."""
    size = end - start
    bounds = np.append(0, np.cumsum(size))
    flat = data[np.repeat(start - bounds[:-1], size) + np.arange(bounds[-1])]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes()))


def _counted(partials: DataFrame, depth: int, least: int, groups: int) -> DataFrame:
    """Phrases of ``depth`` words with ``least`` or more occurrences, from routed equal partitions.

    At depth 1 there are also a row of each group and language with a null key and the
    number of its words, and the number of words that share a key with another (``clashes``).
    """
    names = [f"k{i}" for i in range(depth)]
    extra = ", clashes long" if depth == 1 else ""

    def keys_of(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
        return [table.column(c).to_numpy().view(U64) for c in names], table.column("n").to_numpy()

    def clashes_in(table: pa.Table, key: np.ndarray) -> int:
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        a, b = (table.select(["lang", "word"]).take(pa.array(order[at])) for at in (same, same + 1))
        differ = pc.or_(pc.not_equal(a["lang"], b["lang"]), pc.not_equal(a["word"], b["word"]))
        return int(pc.sum(differ).as_py() or 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what is held is bounded by the group's different phrases, however often its rows repeat
        held, rows, limit, clashes = [], 0, 2 * GROUP, 0
        for batch in batches:
            held.append(batch.drop_columns(["route"]))
            rows += len(batch)
            if rows > limit:
                table = pa.Table.from_batches(held).combine_chunks()
                keys, n = keys_of(table)
                clashes += clashes_in(table, keys[0]) if depth == 1 else 0
                chosen, total = equal_partitions(keys, n)
                table = table.take(pa.array(chosen)).set_column(table.column_names.index("n"), "n", pa.array(total))
                held, rows = table.to_batches(), len(table)
                limit = max(limit, 2 * rows)
        table = pa.Table.from_batches(held).combine_chunks()
        keys, n = keys_of(table)
        chosen, total = equal_partitions(keys, n, least)
        out = table.take(pa.array(chosen)).set_column(table.column_names.index("n"), "n", pa.array(total))
        if depth == 1:
            clashes += clashes_in(table, keys[0])
            sums = table.group_by("lang").aggregate([("n", "sum")])
            every = pa.table({"k0": pa.nulls(len(sums), pa.int64()), "n": sums["n_sum"], "lang": sums["lang"],
                              "word": pa.nulls(len(sums), pa.string()),
                              "clashes": pa.array([clashes] + [0] * (len(sums) - 1), type=pa.int64())})
            out = pa.concat_tables([out.append_column("clashes", pa.nulls(len(out), pa.int64())), every])
        yield from out.to_batches()

    route = F.pmod(F.xxhash64(*names), F.lit(groups))
    return partials.withColumn("route", route).groupBy("route").applyInArrow(count, _schema(depth) + extra)


def _bitmap(phrases: DataFrame, depth: int) -> np.ndarray:
    """FILTER_BITS bits, set at the keys of the given phrases; merged by aggregation."""
    def place(batches):
        for batch in batches:
            keys = [batch.column(i).to_numpy().view(U64) for i in range(depth)]
            at = (_phrase_key(keys) & U64(FILTER_BITS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at + 1)], names=["at"])

    at = phrases.select(*(f"k{i}" for i in range(depth))).mapInArrow(place, "at long")
    rows = (at.groupBy(F.bitmap_bucket_number("at").alias("row"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())   # FILTER_BITS / 32768 rows at most
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        a = (r["row"] - 1) * (_PER_ROW // 8)
        out[a:a + _PER_ROW // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                  min_count: int = MIN_COUNT, group: int = GROUP) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """(n of each lang; for each depth 1..max_words the phrases of min_count or more occurrences
    as k0, k1, ... and n; lang and word of each k0)."""
    x = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = x.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    for seed in range(len(_MULTIPLIERS)):
        found = materialize(_counted(_partials(x, 1, seed, None), 1, min_count, _groups(size // 8, group)))
        if not found.agg(F.sum("clashes")).first()[0]:
            break
    else:
        raise RuntimeError("words share a 64-bit key under every seed")
    totals = found.where("k0 is null").groupBy("lang").agg(F.sum("n").alias("n_words"))
    known = found.where("k0 is not null")
    levels = [known.select("k0", "n")]
    n = totals.agg(F.sum("n_words")).first()[0] or 0
    for depth in range(2, max_words + 1):
        rows = _partials(x, depth, seed, _bitmap(levels[-1], depth - 1))
        levels.append(materialize(_counted(rows, depth, min_count, _groups(n, group))))
    return totals, levels, known.select("k0", "lang", "word")


def _groups(rows: int, group: int) -> int:
    """Into how many groups at most so many rows are routed."""
    return max(1, -(-rows // group))


def _first_of_each(rows: DataFrame, group: str, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each group with their rank, by ranges of the order that are sorted
    side by side: no task holds a whole group."""
    sorted_ = materialize(rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
                          .withColumn("part", F.spark_partition_id()).withColumn("mono", F.monotonically_increasing_id()))
    sizes = sorted_.groupBy(group, "part").agg(F.count(F.lit(1)).alias("size"), F.min("mono").alias("start"))
    before = F.sum("size").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(group, "part", "start", F.coalesce(before, F.lit(0)).alias("before")).where(F.col("before") < top)
    return (sorted_.join(sizes, [group, "part"]).withColumn("rank", F.col("before") + F.col("mono") - F.col("start") + 1)
            .where(F.col("rank") <= top))


def score_of(a: str, l: str, r: str) -> Column:
    """floor(10**6 a a / (l r)) as a long, exact for counts up to 10**16."""
    wide = "cast({} as decimal(38,0))"
    return F.expr(f"({wide.format(a)} * {wide.format(a)} * cast(1000000 as decimal(7,0))) div ({wide.format(l)} * {wide.format(r)})")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_words: int = MIN_WORDS,
                 max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, cover: int = COVER, top: int = TOP,
                 group: int = GROUP) -> DataFrame:
    """Each language's first ``top`` collocations: lang, rank, phrase, a, l, r, n, score.

    A phrase of ``min_words`` to ``max_words`` words with a >= ``min_count`` occurrences is cut
    where floor(10**6 a a / (l r)) is smallest (the first such place), and dropped if a longer
    candidate around it has at least ``cover`` percent of its count.  Ties in rank go to more
    occurrences, then to the phrase's bytes.  A null text has no words, a null language is
    ``und``; repeated rows count again; other columns are ignored; no rows, no result.
    """
    totals, levels, words = phrase_counts(docs, text_col, lang_col, max_words, min_count, group)

    def names(a: int, b: int) -> list[str]:
        return [f"k{i}" for i in range(a, b)]

    def level(depth: int, at: int, n: str) -> DataFrame:
        """Counts of the phrases of some depth, under the key names of a part that begins at ``at``."""
        return levels[depth - 1].select(*(F.col(f"k{i}").alias(f"k{at + i}") for i in range(depth)), F.col("n").alias(n))

    scored = []
    for depth in range(min_words, max_words + 1):
        x = level(depth, 0, "a")
        cuts = []
        for k in range(1, depth):
            x = x.join(level(k, 0, f"l{k}"), names(0, k)).join(level(depth - k, k, f"r{k}"), names(k, depth))
            cuts.append(F.struct(score_of("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"),
                                 F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        x = x.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
        longer = [level(d, 0, "m").select(*(F.col(f"k{at + i}").alias(f"k{i}") for i in range(depth)), "m")
                  for d in range(depth + 1, max_words + 1) for at in range(d - depth + 1)]
        if longer:
            around = reduce(DataFrame.unionByName, longer).groupBy(*names(0, depth)).agg(F.max("m").alias("m"))
            x = x.join(around, names(0, depth), "left").where(
                F.coalesce(F.lit(100) * F.col("m") < F.lit(cover) * F.col("a"), F.lit(True)))
        x = x.select(*names(0, depth), "a", "cut.l", "cut.r", "cut.score")
        for i in range(depth):
            x = x.join(words.select(F.col("k0").alias(f"k{i}"), F.col("word").alias(f"w{i}"),
                                    *([F.col("lang")] if i == 0 else [])), f"k{i}")
        scored.append(x.select("lang", F.concat_ws(" ", *(f"w{i}" for i in range(depth))).alias("phrase"), "a", "l", "r", "score"))
    ranked = _first_of_each(reduce(DataFrame.unionByName, scored), "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score")


def collocations_sql(min_count: int = MIN_COUNT, cover: int = COVER, top: int = TOP) -> str:
    """DuckDB twin for phrases of 2 to 3 words."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    score = "CAST({a} AS HUGEINT) * {a} * 1000000 // (CAST({l} AS HUGEINT) * {r})"
    return rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
one AS (SELECT lang, unnest(w) AS x FROM w),
f1 AS (SELECT lang, x, count(*) AS n FROM one GROUP BY ALL),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f1 GROUP BY ALL),
two AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) AS p FROM w WHERE len(w) > 1),
f2 AS (SELECT lang, p[1] AS x, p[2] AS y, count(*) AS n FROM two GROUP BY ALL HAVING count(*) >= {min_count}),
three AS (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS p FROM w WHERE len(w) > 2),
f3 AS (SELECT lang, p[1] AS x, p[2] AS y, p[3] AS z, count(*) AS n FROM three GROUP BY ALL HAVING count(*) >= {min_count}),
around AS (
  SELECT lang, x, y, max(n) AS m FROM (SELECT lang, x, y, n FROM f3 UNION ALL SELECT lang, y, z, n FROM f3) GROUP BY ALL),
pair AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.n AS a, l.n AS l, r.n AS r, {score.format(a='f2.n', l='l.n', r='r.n')} AS score
  FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.x = f2.x JOIN f1 r ON r.lang = f2.lang AND r.x = f2.y
  LEFT JOIN around m ON m.lang = f2.lang AND m.x = f2.x AND m.y = f2.y
  WHERE m.m IS NULL OR 100 * m.m < {cover} * f2.n),
cut AS (
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z AS phrase, f3.n AS a, l1.n AS l1, r1.n AS r1, l2.n AS l2, r2.n AS r2,
         {score.format(a='f3.n', l='l1.n', r='r1.n')} AS s1, {score.format(a='f3.n', l='l2.n', r='r2.n')} AS s2
  FROM f3 JOIN f1 l1 ON l1.lang = f3.lang AND l1.x = f3.x JOIN f2 r1 ON r1.lang = f3.lang AND r1.x = f3.y AND r1.y = f3.z
  JOIN f2 l2 ON l2.lang = f3.lang AND l2.x = f3.x AND l2.y = f3.y JOIN f1 r2 ON r2.lang = f3.lang AND r2.x = f3.z),
scored AS (
  SELECT * FROM pair UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cut),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       total.n AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= {top}
"""
