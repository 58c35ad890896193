"""License scan (operator 8).

An Aho-Corasick automaton over the words of a text finds notice phrases and
identifier tags, all in one pass.  What follows a tag is read as a license
expression by a shunting-yard parser (``with`` binds closest, then ``and``, then
``or``) and evaluated: which licenses it names, and how restrictive it is at best,
an ``or`` being the reader's choice and an ``and`` an obligation.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Texts, arrow_map

# Phrases whose places are counted as base, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notice phrases of the scanner's own.
NOTICES = {
    "the mit license": "mit",
    "licensed under mit": "mit",
    "apache 2 0": "apache-2",
    "apache license 2 0": "apache-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license": "mpl-2",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "boost software license": "bsl-1",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0": "cc0",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
# Identifiers of expressions whose label differs from the identifier itself.
IDENTIFIERS = {
    "apache-2.0": "apache-2", "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2",
    "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3", "agpl-3.0": "agpl-3",
    "agpl-3.0-only": "agpl-3", "agpl-3.0-or-later": "agpl-3", "lgpl-2.1": "lgpl", "lgpl-2.1-only": "lgpl",
    "lgpl-2.1-or-later": "lgpl", "lgpl-3.0-only": "lgpl", "lgpl-3.0-or-later": "lgpl", "mpl-2.0": "mpl-2",
    "bsl-1.0": "bsl-1", "cc0-1.0": "cc0", "cc-by-4.0": "cc-by", "cc-by-sa-4.0": "cc-by-sa",
    "cc-by-nc-4.0": "cc-by-nc", "epl-2.0": "epl",
}
# How restrictive a label is: 0 free, 1 keeps notices, 2 weak, 3 strong copyleft, 4 limits use.
LEVELS = {
    "cc0": 0, "unlicense": 0, "0bsd": 0, "mit": 1, "apache-2": 1, "bsd-2-clause": 1, "bsd-3-clause": 1, "isc": 1,
    "bsl-1": 1, "cc-by": 1, "lgpl": 2, "mpl-2": 2, "epl": 2, "cc-by-sa": 3, "gpl": 3, "gpl-2": 3, "gpl-3": 3,
    "agpl-3": 3, "cc-by-nc": 4, "cc-by-nd": 4, "proprietary": 4,
}
UNKNOWN_LEVEL = 4
TAG_TRUST, BASE_TRUST, NOTICE_TRUST = 0.9, 0.8, 0.6     # how sure one place makes us

_TOKEN = re.compile(r"\s*([()/]|[a-z0-9][a-z0-9.+\-:]*)")
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str) -> list[str]:
    """The longest well-formed license expression at the start of ``text`` in postfix order (shunting-yard).

    Reading stops at a token that cannot follow; operators left without an operand and
    brackets left open are given up.  A slash between two names is the older way to write
    ``or``.  [] if there is no license.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next, at = True, 0

    def reduce_to(limit):
        while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= limit:
            out.append(stack.pop())

    text = text.lower()
    while hit := _TOKEN.match(text, at):
        token = "or" if hit[1] == "/" and hit.end() < len(text) and not text[hit.end()].isspace() else hit[1]
        if operand_next:
            if token == "(":
                stack.append(token)
            elif token in _BINDS or token == ")":
                break
            else:
                out.append(token)
                operand_next = False
        elif token in _BINDS:
            reduce_to(_BINDS[token])
            stack.append(token)
            operand_next = True
        elif token == ")" and "(" in stack:
            reduce_to(0)
            stack.pop()
        else:
            break
        at = hit.end()
    if operand_next:        # brackets and operators that wait for an operand
        while stack and stack[-1] == "(":
            stack.pop()
        if stack and out:
            stack.pop()
    while stack:
        if (token := stack.pop()) != "(":
            out.append(token)
    return out


def evaluate(postfix: list[str]) -> tuple[set[str], int]:
    """(labels named, level) of a postfix expression: the least level of the sides of an ``or``,
    the greatest of an ``and``; an exception (``with``) softens strong copyleft to weak."""
    stack: list[tuple[set[str], int]] = []
    for token in postfix:
        if token in _BINDS:
            if len(stack) < 2:
                continue
            (right, b), (left, a) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, 2 if a == 3 else a))
            else:
                stack.append((left | right, min(a, b) if token == "or" else max(a, b)))
        else:
            plain = token.rstrip("+")      # "or any later version"
            label = IDENTIFIERS.get(token, IDENTIFIERS.get(plain, plain))
            stack.append(({label}, LEVELS.get(label, UNKNOWN_LEVEL)))
    labels = set().union(*(s[0] for s in stack)) if stack else set()
    return labels, max((s[1] for s in stack), default=-1)


def _word_bytes() -> bytes:
    """Translation of bytes: A-Z to lower case, what is in no word to a space."""
    keep = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table = bytearray(b" " * 256)
    for b in keep:
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return bytes(table)


def _automaton(base: dict[str, str], notices: dict[str, str]):
    import ahocorasick

    found: dict[str, list] = {}
    for kind, phrases in (("base", base), ("notice", notices), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            found.setdefault(f" {phrase} ", []).append((kind, label))
    automaton = ahocorasick.Automaton()
    for phrase, what in found.items():
        automaton.add_word(phrase, (len(phrase), what))
    automaton.make_automaton()
    return automaton


def _inside(found: list[tuple]) -> list[bool]:
    """For finds (start, -last, ...) in order: does a longer find hold this one whole?"""
    out, reach, widest = [], -1, (-1, -1)      # the farthest end so far, and the span that has it
    for at, last, *_ in found:
        out.append(-last <= reach and (at, -last) != widest)
        if -last > reach:
            reach, widest = -last, (at, -last)
    return out


_TAG_LINE = re.compile(r"spdx[^a-z0-9\n]{0,3}license[^a-z0-9\n]{0,3}identifier[^a-z0-9(\n]*([^\n]*)", re.I)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base: dict[str, str] = BASE_PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_base, first_word, last_word, base_labels, labels,
    score, level, expressions.

    ``score`` is how sure the finds make us that the text carries a license (0 without any),
    ``level`` the strictest obligation found (null without any), ``expressions`` the postfix
    forms of the tags' expressions.  A notice that lies within a longer find is not counted: the
    longest phrase speaks.  Repeated rows are scanned alike.  A null text has no words and no finds; ids are carried
    through; other columns are ignored; an empty table gives an empty result.
    """
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    base, notices = dict(base), dict(notices)
    schema = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, level int, expressions array<string>")
    names = [c.split()[0] for c in schema.split(", ")]

    def start():
        automaton, table = _automaton(base, notices), _word_bytes()

        def one(raw: bytes) -> tuple:
            words = raw.translate(table).split()
            line = (b" " + b" ".join(words) + b" ").decode("latin-1")
            found, tagged = [], False
            for end, (size, what) in automaton.iter(line):
                for kind, label in what:
                    if kind == "tag":
                        tagged = True
                    else:
                        found.append((end + 1 - size, -end, kind, label))
            base_at, base_labels, labels, doubt, levels = [], set(), set(), 1.0, []
            found.sort()
            for (at, end, kind, label), inside in zip(found, _inside(found)):
                if kind == "base":
                    base_at.append(at)
                    base_labels.add(label)
                elif inside:        # a notice within a longer find says nothing of its own
                    continue
                labels.add(label)
                levels.append(LEVELS.get(label, UNKNOWN_LEVEL))
                doubt *= 1 - (BASE_TRUST if kind == "base" else NOTICE_TRUST)
            places = []
            if base_at:     # word numbers: spaces before each place
                space = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 0x20)
                places = np.searchsorted(space, base_at).tolist()
            expressions = []
            if tagged:
                for hit in _TAG_LINE.finditer(raw.decode("utf-8")):
                    if postfix := parse_expression(hit[1]):
                        named, level = evaluate(postfix)
                        labels |= named
                        levels.append(level)
                        doubt *= 1 - TAG_TRUST
                        expressions.append(" ".join(postfix))
            return (len(words), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base_labels)), ",".join(sorted(labels)), 1 - doubt,
                    max(levels, default=None), expressions)

        def work(_, texts: Texts) -> dict:
            rows = [one(texts.text(i)) for i in range(texts.n)]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int32(), pa.list_(pa.string())]
            return {n: pa.array([r[j] for r in rows], type=t) for j, (n, t) in enumerate(zip(names, kinds))}

        return work

    return arrow_map(x, start, schema, "_text", ("_id",), per_task=True).withColumnRenamed("_id", id_col)
