"""Byte-level BPE ids of whole batches of texts.

The vocabulary is a tokenizer file of the ``tokenizers`` library, given by path.  A
batch is cut into the pattern's pieces in numpy; each distinct piece is encoded
once per task and its ids are dealt back to all places.  Words repeat so often that
this costs a fraction of encoding whole texts, with the same ids.

Pieces (the pattern of the byte-level pre-tokenizer): runs of letters, of digits and
of other marks, each with one space before it if there is one; ``'s 't 're 've 'm
'll 'd`` at the start of a run of marks; white space without the last character
before a run.  What is a letter, digit or space beyond ASCII is asked of the
tokenizer itself, once per character.

Added tokens of the file (``<|endoftext|>``) are found in the texts first, as the
library does, and the parts around them are encoded like texts of their own.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from .text import Texts, span_hash, worker_cache

LETTER, DIGIT, MARK, SPACE, UNKNOWN = 0, 1, 2, 3, 255
ARENA_BYTES = 1 << 24       # known pieces a worker keeps, about
PART = 1 << 20              # bytes of a long text encoded at a time
_ASCII_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])


def byte_alphabet() -> dict[int, int]:
    """Byte -> the character that stands for it in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others for code points from 256 on, in order."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts under one tokenizer file; keep one for each worker with ``encoder``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.kinds = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self._forget()
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content.encode(): i for i, t in added.items()}
        # a token that takes in spaces, asks for whole words or is matched after others is left to the library
        self.plain = not any(t.lstrip or t.rstrip or t.single_word for t in added.values()) and len({t.normalized for t in added.values()}) <= 1
        self.marks = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        self._learn(range(128))

    def _forget(self) -> None:
        """Empty the arena of known pieces: sorted keys, and where the ids of each lie in ``flat``."""
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = self.size = np.zeros(0, dtype=np.int32)
        self.flat = np.zeros(0, dtype="<u4")

    def _known(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key in the arena, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(key), dtype=np.int64), np.zeros(len(key), dtype=bool)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return place, self.keys[place] == key

    def _remember(self, key: np.ndarray, lists: list[list[int]]) -> None:
        size = np.fromiter(map(len, lists), dtype=np.int32, count=len(lists))
        flat = np.fromiter(chain.from_iterable(lists), dtype="<u4", count=int(size.sum()))
        keys = np.concatenate([self.keys, key])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.at = np.concatenate([self.at, (len(self.flat) + np.cumsum(size) - size).astype(np.int32)])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.flat = np.concatenate([self.flat, flat])

    def _learn(self, points) -> None:
        """Ask the pre-tokenizer what each character is: does it join a letter, a digit, a mark?"""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for p in points:
            c = chr(p)
            self.kinds[p] = next((kind for kind, mate in ((LETTER, "a"), (DIGIT, "1"), (MARK, "!"))
                                  if len(split(mate + c)) == 1), SPACE)

    def _piece(self, piece: str) -> list[int]:
        """Ids of one piece, from the tokenizer's own model."""
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.alphabet))]

    def _starts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the pieces of some texts begin (code points, text bounds)."""
        n = len(points)
        kind = self.kinds[points]
        if (kind == UNKNOWN).any():
            self._learn(np.unique(points[kind == UNKNOWN]).tolist())
            kind = self.kinds[points]
        first = np.zeros(n + 1, dtype=bool)
        first[bounds] = True
        run = first[:-1].copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = np.append(run, True)
        # runs that follow white space in the same text
        after = np.flatnonzero(run[1:] & ~first[1:-1] & (kind[:-1] == SPACE)) + 1
        start[after - 1] = True
        start[after[points[after - 1] == 0x20]] = False
        # contractions
        quote = np.flatnonzero((points == 0x27) & run & start[:-1])
        padded = np.append(points, [0, 0])
        ended = np.append(first, [True, True])

        def letter(at, options):
            return np.isin(padded[at], [ord(c) for c in options])

        one = quote[~ended[quote + 1] & letter(quote + 1, "stmd")]
        two = quote[~ended[quote + 1] & ~ended[quote + 2]]
        two = two[((letter(two + 1, "rv") & letter(two + 2, "e")) | (letter(two + 1, "l") & letter(two + 2, "l")))]
        for at, size in ((one, 2), (two, 3)):
            start[at + 1] = False
            start[at + size] = True
        return np.flatnonzero(start[:-1])

    def _marked(self, texts: Texts) -> list[tuple[int, int, list[int]]]:
        """(start, end, ids) of the spans whose ids are not those of their pieces: added tokens."""
        raw = texts.data.tobytes()
        if self.marks is None or not self.marks.search(raw):
            return []
        spans = list(zip(texts.bounds[:-1].tolist(), texts.bounds[1:].tolist()))
        if self.plain:
            return [(m.start(), m.end(), [self.added[m.group()]]) for a, b in spans for m in self.marks.finditer(raw, a, b)]
        return [(a, b, self.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids)
                for a, b in spans if self.marks.search(raw, a, b)]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, n + 1 bounds)."""
        marked = self._marked(texts)
        if not marked:
            return self._encode(texts)
        start, end, given = zip(*marked)
        parts = np.unique(np.concatenate([texts.bounds, start, end]))
        ids, bounds = self._encode(Texts(texts.data, parts))
        place = np.searchsorted(parts, start)
        is_mark = np.zeros(len(parts) - 1, dtype=bool)
        is_mark[place] = True
        size = np.diff(bounds)
        kept = ids[np.repeat(~is_mark, size)]
        size[place] = [len(x) for x in given]
        of_mark = np.repeat(is_mark, size)
        out = np.empty(len(of_mark), dtype=ids.dtype)
        out[of_mark], out[~of_mark] = list(chain.from_iterable(given)), kept
        return out, np.append(0, np.cumsum(size))[np.searchsorted(parts, texts.bounds)]

    def _encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens: long ones in parts, cut before a single space
        between ASCII letters, where a piece begins whatever stands around."""
        data, parts = texts.data, [texts.bounds]
        for i in np.flatnonzero(np.diff(texts.bounds) > 2 * PART):
            a, b = int(texts.bounds[i]), int(texts.bounds[i + 1])
            while b - a > 2 * PART:
                near = data[a + PART:a + 2 * PART]
                letter = _ASCII_LETTER[near]
                cut = np.flatnonzero((near[1:-1] == 0x20) & letter[:-2] & letter[2:])
                if not len(cut):
                    a += PART       # no such place here: the part grows
                    continue
                a += PART + 1 + int(cut[0])
                parts.append(np.array([a]))
        if len(parts) == 1:
            return self._pieces(texts)
        bounds = np.sort(np.concatenate(parts), kind="stable")
        ids, sizes, at = [], [], 0
        while at < len(bounds) - 1:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 2 * PART, side="right")) - 1)
            got, inner = self._pieces(Texts(data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at]))
            ids.append(got)
            sizes.append(np.diff(inner))
            at = to
        place = np.append(0, np.cumsum(np.concatenate(sizes)))
        return np.concatenate(ids), place[np.searchsorted(bounds, texts.bounds, side="left")]

    def _pieces(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The same for some texts at once."""
        string = texts.data.tobytes().decode("utf-8")
        points = np.frombuffer(string.encode("utf-32-le"), dtype=np.uint32)
        bounds = texts.chars_before(texts.bounds)
        start = self._starts(points, bounds)
        end = np.append(start[1:], len(points)) if len(start) else start
        key, place, which = np.unique(span_hash(points, start, end), return_index=True, return_inverse=True)
        if self.keys.nbytes + self.at.nbytes + self.size.nbytes + self.flat.nbytes > ARENA_BYTES:
            self._forget()          # bounds the worker's memory, not the result
        new = np.flatnonzero(~self._known(key)[1])
        if len(new):
            self._remember(key[new], [self._piece(string[a:b]) for a, b in zip(start[place[new]].tolist(), end[place[new]].tolist())])
        here, _ = self._known(key)
        base, size = self.at[here].astype(np.int64), self.size[here].astype(np.int64)
        length = size[which]
        at = np.cumsum(length) - length
        total = int(length.sum())
        ids = self.flat[np.repeat(base[which] - at, length) + np.arange(total)]
        of_text = np.searchsorted(start, bounds)
        return ids, np.append(at, total)[of_text]


def encoder(path: str) -> Encoder:
    cache = worker_cache()
    if ("encoder", path) not in cache:
        cache[("encoder", path)] = Encoder(path)
    return cache[("encoder", path)]
