"""Quality rules by repetition coverage (operator 5).

For several n-gram lengths the rolling hash of every run of n words is taken;
runs that occur twice or more in the text mark their words, and the code points
of marked words over those of all words are the coverage at that length.  The
same is done for lines.  Documents above a limit at any length are rejected, as
are those that fail the base rules (fewer than 20 words, or over 30 % of the
words inside repeated 8-word windows).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import (Texts, Words, arrow_map, byte_table, group_sum, in_groups, mix, space_table, span_hash,
                   window_hash)

# n-gram length -> largest share of a document's word characters that may lie in
# n-grams found twice or more (first included).
NGRAM_LIMITS = {3: 0.40, 5: 0.35, 8: 0.30, 13: 0.30}
LINE_LIMIT = 0.30       # largest share of characters in lines equal to an earlier line
MIN_WORDS = 20
BASE_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "dup_line_chars long, ngram_chars map<int,long>, base_failed boolean, kept boolean")


def _covered(words: Words, n: int) -> np.ndarray:
    """True for words inside a run of n words that occurs twice or more in the same text."""
    cover = np.zeros(len(words.doc) + 1, dtype=np.int32)
    at = words.windows(n)
    if len(at):
        key = mix(window_hash(words.hash, n)[at] ^ mix(words.doc[at].astype(np.uint64) + np.uint64(n)))
        order = np.argsort(key)
        repeated = at[order[in_groups(key[order])[1]]]
        cover[repeated] += 1
        cover[repeated + n] -= 1
    return np.cumsum(cover[:-1]) > 0


def repetition_of(texts: Texts, ngram_limits: dict[int, float], line_limit: float) -> dict:
    """The columns of ``STATS`` for some texts."""
    table = space_table()
    words = Words(texts, table)
    chars = texts.chars_before(words.end) - texts.chars_before(words.start)
    word_chars = group_sum(chars, words.doc, texts.n)
    symbols = ~byte_table(SYMBOLS)
    hits = np.flatnonzero(symbols[texts.data])
    n_symbols = np.bincount(texts.owner(hits), minlength=texts.n).astype(np.int64)

    line_start, line_end = texts.runs(byte_table(b"\n")[texts.data])
    full = texts.count_before(table, line_end) > texts.count_before(table, line_start)
    line_start, line_end = line_start[full], line_end[full]
    in_line = texts.chars_before(line_end) - texts.chars_before(line_start)
    line_doc = texts.owner(line_start)
    key = span_hash(texts.data, line_start, line_end)
    order = np.lexsort((key, line_doc))
    same_doc = np.zeros(len(order), dtype=bool)
    same_doc[1:] = line_doc[order][1:] == line_doc[order][:-1]
    again = order[in_groups(key[order])[0] & same_doc]
    n_dup_lines = np.bincount(line_doc[again], minlength=texts.n)
    dup_line_chars = group_sum(in_line[again], line_doc[again], texts.n)
    line_chars = group_sum(in_line, line_doc, texts.n)

    def share_over(part, whole, limit):
        return part > limit * whole

    failed = np.zeros(texts.n, dtype=bool)
    by_length = []
    for n, limit in sorted(ngram_limits.items()):
        covered = _covered(words, n)
        by_length.append(group_sum(chars * covered, words.doc, texts.n))
        failed |= share_over(by_length[-1], word_chars, limit)
    failed |= share_over(dup_line_chars, line_chars, line_limit)
    repeat_words = group_sum(_covered(words, BASE_WINDOW), words.doc, texts.n)
    base_failed = (words.count < MIN_WORDS) | (100 * repeat_words > 30 * words.count)
    lengths = sorted(ngram_limits)
    return {
        "n_words": words.count.astype(np.int64), "word_chars": word_chars, "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines.astype(np.int64), "n_repeat_words": repeat_words,
        "dup_line_chars": dup_line_chars,
        "ngram_chars": pa.MapArray.from_arrays(
            pa.array(np.arange(texts.n + 1) * len(lengths), type=pa.int32()),
            pa.array(np.tile(lengths, texts.n), type=pa.int32()),
            pa.array(np.stack(by_length, axis=1).ravel() if lengths else np.zeros(0, dtype=np.int64))),
        "base_failed": base_failed, "kept": ~base_failed & ~failed,
    }


def repetition_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     ngram_limits: dict[int, float] = NGRAM_LIMITS,
                     line_limit: float = LINE_LIMIT) -> DataFrame:
    """One row per document: ``id_col`` and the columns of ``STATS``.

    A null text has no words and so fails the base rules; a null id is carried
    through; repeated rows give repeated rows; other columns are ignored, so their
    names cannot clash; an empty table gives an empty result.  One pass, no shuffle.
    """
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    limits = dict(ngram_limits)
    return arrow_map(x, lambda rows, texts: repetition_of(texts, limits, line_limit), STATS,
                     "_text", ("_id",)).withColumnRenamed("_id", id_col)


def drop_repetitive(docs: DataFrame, text_col: str = "text",
                    ngram_limits: dict[int, float] = NGRAM_LIMITS,
                    line_limit: float = LINE_LIMIT) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text passes the rules."""
    limits = dict(ngram_limits)
    x = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    judged = arrow_map(x, lambda rows, texts: {"_kept": repetition_of(texts, limits, line_limit)["kept"]},
                       "_kept boolean", "_text", ("_row",))
    return judged.where("_kept").select("_row.*")
