"""Toxicity of texts that hide their words (operator 11).

Noisy channel.  A writer's letters pass a channel that swaps letters for look-alikes
(``1d10t``), masks them (``f**l``), repeats them (``foooool``) or spaces them out
(``f o o l``, ``f.o.o.l``).  A suspicious stretch becomes a lattice: each place offers the
letters that may have been meant, once or doubled, with or without a word break before,
at the channel's price.  Viterbi decoding under a character trigram model of all
texts picks the likeliest path.  The rest of a text has one reading and is kept.

Score.  Texts are scored as restored.  From labelled rows come the character runs (3
to 8 within a word, its ends marked, and whole words) that toxic texts have significantly more
often than others; a word is as toxic as its strongest run, and a text is described by how
many of its words pass a few levels, and at what rate.  A logistic curve
fitted on labelled texts that the runs were not chosen from gives the score.

The trigram counts cover the whole corpus and are collected as 64**3 numbers at most.
Learning takes at most ``SAMPLE`` labelled rows of each class, whole texts, and keeps at most
``MAX_RUNS`` runs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .compression import FOLDS, HELD_FOLD, _logistic, fold_of
from .text import Texts, arrow_map, in_share, slices, span_hash, window_hash, worker_cache

SAMPLE = 4000           # labelled rows of each class to learn from, at most
MAX_RUNS = 4096         # character runs of the model, at most
CUT = 0.5               # predicted is 1 from this score on
RUNS = range(3, 9)      # lengths of character runs within a word, its ends included
SIGNIFICANT = 3.0       # standard errors of a run's log odds
LEVELS = (1.0, 2.0, 3.0, 4.0)   # levels of word toxicity that are counted
CLASSES = 64            # character classes of the trigram model; 0 is a break
PART = 64               # longer lattices are decoded in parts of so many places
_KNOWN = 1 << 16        # restored stretches a worker remembers
U64 = np.uint64

# What a symbol may stand for
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "¡": "i", "€": "e", "£": "l",
    "*": "aeiou", "#": "aeiou",
}
PUNCTUATION = "!#+(¡"    # at either end of a stretch these are no letters
# The channel's log prices
KEPT_BREAK, DROPPED_BREAK, SWAPPED, MASKED, SYMBOL, DOUBLED, HALVED = -2.0, -0.5, -1.0, -2.0, -4.0, -0.2, -1.5

SPACE, LETTER, SIGN, OTHER = 0, 1, 2, 3


def kinds() -> np.ndarray:
    """Kind of every code point: white space, letter, sign that may stand for a letter, other."""
    cache = worker_cache()
    if "toxicity_kinds" not in cache:
        out = np.full(0x110000, OTHER, dtype=np.uint8)
        for p in range(0x110000):
            c = chr(p)
            if c.isalpha():
                out[p] = LETTER
            elif c.isspace():
                out[p] = SPACE
        out[[ord(c) for c in LOOK_ALIKES]] = SIGN
        cache["toxicity_kinds"] = out
    return cache["toxicity_kinds"]


def char_classes(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Class of each code point: 1-26 for a-z, 27-59 for U+00DF-U+00FF, 60-63 for other letters, else 0."""
    out = 60 + (points & 3)
    out = np.where((points >= 0xDF) & (points <= 0xFF), points - 0xDF + 27, out)
    out = np.where((points >= 0x61) & (points <= 0x7A), points - 0x60, out)
    return np.where(kind == LETTER, out, 0).astype(np.int64)


class Lowered:
    """Some texts in lower case, as code points: ``string``, in which a line break ends each text,
    and ``bounds`` of the texts in it."""

    def __init__(self, texts: Texts):
        parts = [texts.text(i).decode().lower() + "\n" for i in range(texts.n)]
        self.string = "".join(parts)
        self.points = np.frombuffer(self.string.encode("utf-32-le"), dtype=np.uint32)
        self.bounds = np.append(0, np.cumsum([len(p) for p in parts], dtype=np.int64))


def _trigrams(classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Trigram numbers of texts, with a break before and after each and runs of breaks as one; a
    class after a break has two breaks for its context, so words do not lean on words before."""
    padded = np.insert(classes, bounds, 0)
    c = padded[np.append(True, (padded[1:] != 0) | (padded[:-1] != 0))]
    two, one = np.append(0, c[:-2]), c[:-1]
    return (np.where(one == 0, 0, two) * CLASSES + one) * CLASSES + c[1:]


def char_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probability of a class after two others, (64, 64, 64), from the trigrams of all texts."""
    def run(batches):
        kind, total = kinds(), np.zeros(CLASSES ** 3, dtype=np.int64)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                x = Lowered(texts)
                grams = _trigrams(char_classes(x.points, kind[x.points]), x.bounds)
                total += np.bincount(grams, minlength=CLASSES ** 3)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["gram", "n"])

    rows = docs.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES ** 3)
    counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return log_probabilities(counts.reshape(CLASSES, CLASSES, CLASSES))


def log_probabilities(counts: np.ndarray, hold: float = 4.0) -> np.ndarray:
    """Trigram log probabilities, smoothed by bigrams, and these by single classes."""
    one = counts.sum(axis=(0, 1)) + 1
    one /= one.sum()
    two = counts.sum(axis=0)
    two = (two + hold * one) / (two.sum(axis=1, keepdims=True) + hold)
    out = np.log((counts + hold * two) / (counts.sum(axis=2, keepdims=True) + hold)).astype(np.float32)
    out[:, 0] = out[0, 0]       # before a break nothing counts
    return out


# -- the channel --------------------------------------------------------------------------
def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """The places of a stretch: what may have been meant there, never empty, and its price.

    Neighbours of one kind are one place: a run of a letter or sign, also with breaks in between
    where letters are spaced out.  A break that may be no break is offered with the next place.
    """
    kind = kinds()
    spaced = _is_spaced(stretch, kind)
    units = [(c, len(list(g))) for c, g in groupby(c for c in stretch if not spaced or kind[ord(c)] in (LETTER, SIGN))]
    places = []
    for i, (c, n) in enumerate(units):
        k = kind[ord(c)] if 0 < i < len(units) - 1 or c not in PUNCTUATION else OTHER
        if k == LETTER:
            meant = [(c, 0.0)] if n == 1 else [(c, HALVED if n == 2 else 0.0), (c + c, DOUBLED)]
        elif k == SIGN:
            price = MASKED if len(LOOK_ALIKES[c]) > 2 else SWAPPED
            meant = [(x * m, price) for x in LOOK_ALIKES[c] for m in ((1,) if n == 1 else (1, 2))] + [(" ", SYMBOL)]
        else:
            meant = [(" ", 0.0)]
        if spaced and i:
            meant = [(x, p + DROPPED_BREAK) for x, p in meant] + [(" " + x, p + KEPT_BREAK) for x, p in meant if x != " "]
        places.append(meant)
    return places


def _is_spaced(stretch: str, kind: np.ndarray) -> bool:
    """Are letters and signs, one at a time, parted by other characters all along?"""
    parts = [kind[ord(c)] in (LETTER, SIGN) for c in stretch]
    return len(parts) > 2 and all(a != b for a, b in zip(parts, parts[1:])) and parts[0] and parts[-1]


def viterbi(lattices: list[list[list[tuple[str, float]]]], model: np.ndarray) -> list[str]:
    """The likeliest reading of each lattice under a trigram model, all lattices side by side."""
    kind = kinds()
    n, depth = len(lattices), max(map(len, lattices))
    width = max(len(p) for x in lattices for p in x)
    code = np.zeros((n, depth + 1, width, 3), dtype=np.int64)
    size = np.ones((n, depth + 1, width), dtype=np.int64)
    price = np.full((n, depth + 1, width), -np.inf, dtype=np.float32)
    price[:, 0, 0] = 0          # place 0 is the break before the stretch
    for i, x in enumerate(lattices):
        for j, place in enumerate(x):
            for a, (text, p) in enumerate(place):
                points = np.array([ord(c) for c in text])
                code[i, j + 1, a, :len(text)] = char_classes(points, kind[points])
                size[i, j + 1, a], price[i, j + 1, a] = len(text), p
    length = np.array([len(x) for x in lattices])
    every = np.arange(n)
    last = np.take_along_axis(code, size[..., None] - 1, axis=3)[..., 0]
    # the letter before an offer's last one: its own, or the last of the offer before
    own = np.take_along_axis(code, np.maximum(size[..., None] - 2, 0), axis=3)[..., 0]
    best = np.full((n, width, width), -np.inf, dtype=np.float32)
    best[:, 0, 0] = 0
    back = np.zeros((n, depth + 1, width, width), dtype=np.int16)
    final = np.zeros((n, 2), dtype=np.int64)
    for j in range(1, depth + 1):
        q = last[:, j - 1]
        before = np.where(size[:, j - 1][:, None, :] > 1, own[:, j - 1][:, None, :], last[:, max(j - 2, 0)][:, :, None])
        a, b = before[:, :, :, None], q[:, None, :, None]
        step = model[a, b, code[:, j, :, 0][:, None, None, :]]
        c1, c2, c3 = (code[:, j, :, i][:, None, None, :] for i in range(3))
        step = step + np.where((size[:, j] > 1)[:, None, None, :], model[b, c1, c2], 0) \
            + np.where((size[:, j] > 2)[:, None, None, :], model[c1, c2, c3], 0)
        total = best[:, :, :, None] + step + price[:, j][:, None, None, :]
        back[:, j] = total.argmax(axis=1)
        best = total.max(axis=1)
        done = np.flatnonzero(length == j)
        if len(done):
            before = np.where(size[done, j][:, None, :] > 1, own[done, j][:, None, :], last[done, j - 1][:, :, None])
            end = best[done] + model[before, last[done, j][:, None, :], 0]
            flat = end.reshape(len(done), -1).argmax(axis=1)
            final[done] = np.column_stack([flat // width, flat % width])
    out = []
    for i in every:
        p, q = final[i]
        chosen = []
        for j in range(length[i], 0, -1):
            chosen.append(lattices[i][j - 1][q][0])
            p, q = back[i, j, p, q], p
        out.append("".join(reversed(chosen)))
    return out


def suspicious(x: Lowered, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches to decode: tokens with a sign next to a letter in it, a letter three
    times running or letters parted one by one, and three or more tokens of one character in a row."""
    n = len(x.points)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    t = Texts(np.zeros(n, dtype=np.uint8), x.bounds)
    start, end = t.runs(kind != SPACE)
    wide = np.concatenate([kind, np.zeros(5, dtype=np.uint8)])
    letter, sign = wide == LETTER, wide == SIGN
    word = letter | sign
    p = np.append(x.points, np.zeros(5, dtype=np.uint32))
    digit = (p >= 0x30) & (p <= 0x39)
    mark = np.zeros(n, dtype=bool)
    mark |= sign[:n] & letter[1:n + 1]
    mark[1:] |= digit[1:n] & letter[:n - 1]
    mark |= letter[:n] & (p[:n] == p[1:n + 1]) & (p[:n] == p[2:n + 2])
    odd = (wide == OTHER) | (wide == SIGN)
    parted = letter[:n] & odd[1:n + 1] & letter[2:n + 2] & odd[3:n + 3] & letter[4:n + 4]
    parted[1:] &= ~word[:n - 1]
    mark |= parted & ~word[5:n + 5]
    marked = np.append(0, np.cumsum(mark))
    flagged = marked[end] > marked[start]
    single = (end - start == 1) & word[start]
    owner = t.owner(start)
    edge = np.ones(len(start) + 1, dtype=bool)
    edge[1:-1] = ~(single[1:] & single[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(edge[:-1])
    last = np.append(first[1:], len(start)) - 1
    rows = single[first] & (last - first >= 2)
    a = np.concatenate([start[flagged], start[first[rows]]])
    b = np.concatenate([end[flagged], end[last[rows]]])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


class Restorer:
    """Restores texts under one character model; remembers some of what it has restored."""

    def __init__(self, model: np.ndarray):
        self.model, self.kind, self.known = model, kinds(), {}

    def _decode(self, stretches: list[str]) -> None:
        """Decode new stretches, those of like width together."""
        parts = []
        for s in stretches:
            x = lattice(s)
            parts += [(s, x[i:i + PART]) for i in range(0, len(x), PART)]
        made = {s: [] for s in stretches}
        batches = {}
        for nth, (s, x) in enumerate(parts):
            shape = (max(map(len, x)).bit_length(), len(x).bit_length())
            batches.setdefault(shape, []).append(nth)
        read = [""] * len(parts)
        for (width, _), members in batches.items():
            step = max(1, (1 << 16) >> (3 * width))
            for i in range(0, len(members), step):
                some = members[i:i + step]
                for nth, text in zip(some, viterbi([parts[m][1] for m in some], self.model)):
                    read[nth] = text
        for (s, _), text in zip(parts, read):
            made[s].append(text)
        for s, texts in made.items():
            self.known[s] = "".join(texts)

    def restore(self, texts: Texts) -> list[str]:
        """The texts in lower case with suspicious stretches as decoded."""
        x = Lowered(texts)
        start, end = suspicious(x, self.kind[x.points])
        spans = list(zip(start.tolist(), end.tolist()))
        new = sorted({x.string[a:b] for a, b in spans} - self.known.keys())
        if len(self.known) + len(new) > _KNOWN:     # bounds the worker's memory, not the result
            self.known.clear()
            new = sorted({x.string[a:b] for a, b in spans})
        self._decode(new)
        out, nth = [], 0
        bounds = x.bounds.tolist()
        for a, b in zip(bounds, bounds[1:]):
            parts, at = [], a
            while nth < len(spans) and spans[nth][0] < b:
                parts += [x.string[at:spans[nth][0]], self.known[x.string[spans[nth][0]:spans[nth][1]]]]
                at = spans[nth][1]
                nth += 1
            out.append("".join([*parts, x.string[at:b - 1]]))
        for s in [s for s in new if len(s) > 256]:  # long stretches are not worth remembering
            del self.known[s]
        return out


def restore_texts(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``restored``: the text in lower case with hidden words restored (null: empty)."""
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def start():
        r = Restorer(model)
        return lambda _, texts: {"restored": pa.array(r.restore(texts), type=pa.string())}

    return arrow_map(x, start, "restored string", "_text", ("_id",), per_task=True).withColumnRenamed("_id", id_col)


# -- the score ----------------------------------------------------------------------------
class WordRuns:
    """Words of letters of some texts, and the hashed character runs of the distinct ones."""

    def __init__(self, texts: list[str], kind: np.ndarray):
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        bounds = np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))
        t = Texts(np.zeros(len(points), dtype=np.uint8), bounds)
        start, end = t.runs(kind[points] == LETTER)
        self.doc = t.owner(start)
        key = span_hash(points, start, end)
        _, place, self.which = np.unique(key, return_index=True, return_inverse=True)
        start, end = start[place], end[place]
        self.n = len(place)
        size = end - start + 2      # both ends are marked: 1 before, 2 after
        self.first = np.cumsum(size) - size
        spread = np.repeat(np.arange(self.n), size)
        offset = np.arange(int(size.sum())) - self.first[spread]
        at = np.clip(start[spread] + offset - 1, 0, max(len(points) - 1, 0))
        value = points[at].astype(U64) + U64(3) if len(points) else np.zeros(0, dtype=U64)
        value[self.first] = 1
        value[self.first + size - 1] = 2
        left = size[spread] - offset    # marked characters from here to the word's end
        self.word, self.hash = [], []
        for n in RUNS:
            ok = np.flatnonzero(left[: max(0, len(value) - n + 1)] >= n)
            self.word.append(spread[ok])
            self.hash.append(window_hash(value, n)[ok])
        whole = np.flatnonzero(size > RUNS[-1])     # shorter words are runs themselves
        self.word.append(whole)
        self.hash.append(span_hash(value, self.first[whole], (self.first + size)[whole]))
        self.word, self.hash = np.concatenate(self.word), np.concatenate(self.hash)


@dataclass
class Model:
    chars: np.ndarray                       # character trigram log probabilities
    runs: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=U64))        # sorted hashes
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    curve: tuple[float, ...] = ()           # empty without labels of both classes
    mean: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()


def text_features(texts: list[str], runs: np.ndarray, weight: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """How many words pass each level (as log and as a rate), the strongest and five strongest words, words."""
    x = WordRuns(texts, kind)
    toxic = np.zeros(x.n)
    if len(runs):
        at = np.minimum(np.searchsorted(runs, x.hash), len(runs) - 1)
        hit = runs[at] == x.hash
        np.maximum.at(toxic, x.word[hit], weight[at[hit]])
    value, n = toxic[x.which], len(texts)
    words = np.bincount(x.doc, minlength=n)
    out = []
    for level in LEVELS:
        hits = np.bincount(x.doc, weights=value >= level, minlength=n)
        out += [np.log1p(hits), 50 * hits / (words + 10)]
    order = np.lexsort((-value, x.doc))
    nth = np.arange(len(order)) - np.searchsorted(x.doc[order], x.doc[order])
    top = np.bincount(x.doc[order], weights=value[order] * (nth < 5), minlength=n)
    most = np.bincount(x.doc[order], weights=value[order] * (nth < 1), minlength=n)
    return np.column_stack([*out, most, top, np.log1p(words)])


def _run_counts(restored: DataFrame) -> DataFrame:
    """(run, toxic, clean): in how many texts (y, restored) of each class a run occurs."""
    def run(batches):
        kind = kinds()
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column("restored").to_pylist()
            for a in range(0, len(texts), 256):
                x = WordRuns(texts[a:a + 256], kind)
                pairs = np.unique(x.doc * np.int64(x.n) + x.which)      # distinct words of each text
                doc, word = pairs // max(x.n, 1), pairs % max(x.n, 1)
                order = np.argsort(x.word, kind="stable")
                lo, hi = np.searchsorted(x.word[order], word), np.searchsorted(x.word[order], word, side="right")
                many = hi - lo
                flat = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                hashes, owner = x.hash[order][flat], np.repeat(doc, many)
                key, which = np.unique(hashes, return_inverse=True)
                once = np.unique(which * np.int64(256) + owner)
                kind_of = y[a + once % 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.bincount(once // 256, weights=kind_of, minlength=len(key)).astype(np.int64)),
                     pa.array(np.bincount(once // 256, weights=1 - kind_of, minlength=len(key)).astype(np.int64))],
                    names=["run", "toxic", "clean"])

    counts = restored.select("y", "restored").mapInArrow(run, "run long, toxic long, clean long")
    return counts.groupBy("run").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample: int = SAMPLE, max_runs: int = MAX_RUNS) -> Model:
    """Learn the character model from all texts, and the score from the labelled rows outside the
    held-out fold, at most ``sample`` of each class in hash order: runs from two thirds of them, the
    curve from the others, weighted to the classes' numbers in the labels.

    Null ids, null labels and labels other than 0 and 1 teach nothing; an id labelled both ways
    counts as 1, one with several texts as the greatest of them.  Empty tables give a model that
    scores every text 0.5.
    """
    chars = char_model(docs, text_col)
    usable = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
              .where(F.col("y").isin(0, 1)).where(fold_of(F.col("id"), FOLDS) != HELD_FOLD)
              .groupBy("id").agg(F.max("y").alias("y")))
    counts = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    few = [usable.where(F.col("y") == y).where(in_share(3 * sample / max(counts.get(y, 0), 1), "id"))
           .orderBy(*order).limit(sample) for y in (0, 1)]
    chosen = few[0].unionByName(few[1])
    texts = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "id")       # at most 2 * sample ids
             .groupBy("id").agg(F.max("y").cast("int").alias("y"), F.max("text").alias("text")))
    ids = materialize(texts)
    # a third of each class, by hash, is kept for the curve
    held = F.pmod(F.xxhash64(F.lit("curve"), "id"), F.lit(3)) == 0
    restored = materialize(restore_texts(ids, chars, "id").join(ids.select("id", "y"), "id").withColumn("held", held))
    sizes = {(r["held"], r["y"]): r["n"] for r in restored.groupBy("held", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 4:
        return Model(chars)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (sizes[False, 1] + 1) / (b / (sizes[False, 0] + 1)))
    runs = (_run_counts(restored.where("not held")).withColumn("odds", odds)
            .withColumn("z", F.col("odds") / F.sqrt(1 / a + 1 / b)).where(F.col("z") > SIGNIFICANT)
            .orderBy(F.desc("z"), "run").limit(max_runs).select("run", "odds").toArrow())
    key = runs.column("run").to_numpy().view(U64)
    at = np.argsort(key)
    key, weight = key[at], runs.column("odds").to_numpy()[at]
    rows = _featured(restored.where("held"), key, weight)
    x, y = np.array([r["f"] for r in rows]), np.array([float(r["y"]) for r in rows])
    share = counts[1] / (counts[1] + counts[0])
    importance = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum()) * len(y)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    curve = _logistic((x - mean) / scale, y, importance, ridge=0.1)
    return Model(chars, key, weight, tuple(curve), tuple(mean), tuple(scale))


def _featured(restored: DataFrame, runs: np.ndarray, weight: np.ndarray) -> list:
    """(id, y, features) of restored texts, in order of id."""
    def run(batches):
        kind = kinds()
        for batch in batches:
            f = text_features(batch.column("restored").to_pylist(), runs, weight, kind)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(f.tolist(), type=pa.list_(pa.float64()))],
                                             names=["id", "y", "f"])

    kind = restored.schema["id"].dataType.simpleString()
    rows = restored.select("id", "y", "restored").mapInArrow(run, f"id {kind}, y int, f array<double>").collect()
    return sorted(rows, key=lambda r: str(r["id"]))


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, held_out, score, predicted, and n_restored, the number of
    code points of the restored text.

    A null text counts as empty and scores like one; null ids are not held out; repeated rows
    score alike; stretches of more than ``PART`` places are decoded in parts; other columns are
    ignored; a model without labels of both classes scores 0.5.
    """
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def start():
        r, kind = Restorer(model.chars), kinds()
        curve, mean, scale = map(np.array, (model.curve, model.mean, model.scale))

        def work(_, texts: Texts) -> dict:
            restored = r.restore(texts)
            size = np.array([len(t) for t in restored], dtype=np.int64)
            if not len(curve):
                return {"score": np.full(texts.n, 0.5), "n_restored": size}
            z = curve[0] + ((text_features(restored, model.runs, model.weight, kind) - mean) / scale) @ curve[1:]
            return {"score": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "n_restored": size}

        return work

    out = arrow_map(x, start, "score double, n_restored long", "_text", ("_id",), per_task=True)
    return out.select(F.col("_id").alias(id_col),
                      F.coalesce(fold_of(F.col("_id"), FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "n_restored")
