"""Language identification by a bidirectional GRU over bytes (operator 10).

The network reads a word's bytes (ASCII folded to lower case) forwards and
backwards and gives every position a probability of each language; a document's
probabilities are the mean over all its positions.  It is trained here in numpy by
backpropagation through time on at most ``SAMPLE_WORDS`` words, hash-drawn from the whole
texts of at most ``SAMPLE_DOCS`` documents, of each language in the table.  The state starts anew with each word, so equal words get equal labels:
each distinct word of a task goes through the network once and counts as often as it
stands in the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .compression import fold_of
from .text import Texts, arrow_map, byte_table, list_array, mix, span_hash

FOLDS, HELD_FOLD = 4, 2
SAMPLE_DOCS = 400       # documents of each language to learn from, at most
SAMPLE_WORDS = 12_000   # words of each language to learn from, at most
HIDDEN = 16
MAX_BYTES = 24          # longer words are cut
EPOCHS, BATCH, RATE = 5, 256, 0.01
UNKNOWN = "und"

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_LETTERS = byte_table([*range(0x61), *range(0x7B, 0x80)])    # of lower-cased text


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class BiGRU:
    """Parameters and passes; words of one batch have the same length.

    Each direction d has byte tables ``x{d}`` (256, 3h) and matrices ``u{d}`` (h, 2h) for the
    reset and update gates and ``v{d}`` (h, h) for the candidate; ``o`` (2h, n) and ``b`` (n)
    label a position.
    """

    def __init__(self, n_labels: int, hidden: int = HIDDEN, seed: int = 0):
        r = np.random.default_rng(seed)
        self.h, self.n = hidden, n_labels
        scale = 1 / np.sqrt(hidden)
        self.p = {"o": r.normal(0, scale, (2 * hidden, n_labels)), "b": np.zeros(n_labels)}
        for d in "fb":
            self.p["x" + d] = r.normal(0, 0.3, (256, 3 * hidden))
            self.p["u" + d] = r.normal(0, scale, (hidden, 2 * hidden))
            self.p["v" + d] = r.normal(0, scale, (hidden, hidden))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, words: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (length, words, h) of one direction; ``keep`` collects what the way back needs."""
        h, n = self.h, len(words)
        x, u, v = self.p["x" + d], self.p["u" + d], self.p["v" + d]
        steps = range(words.shape[1]) if d == "f" else range(words.shape[1] - 1, -1, -1)
        state = np.zeros((n, h), dtype=x.dtype)
        out = np.empty((words.shape[1], n, h), dtype=x.dtype)
        for t in steps:
            given = x[words[:, t]]
            gates = _sigmoid(given[:, :2 * h] + state @ u)
            r, z = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h:] + (r * state) @ v)
            if keep is not None:
                keep.append((t, state, r, z, new))
            state = new + z * (state - new)
            out[t] = state
        return out

    def label(self, words: np.ndarray) -> np.ndarray:
        """Probabilities (length, words, labels) for a (words, length) array of bytes."""
        return self._softmax(np.concatenate([self._run(words, "f"), self._run(words, "b")], axis=2))

    def _softmax(self, states):
        z = states @ self.p["o"] + self.p["b"]
        e = np.exp(z - z.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True)

    def gradients(self, words: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """(mean loss over positions, its gradients), by backpropagation through time."""
        h, n = self.h, len(words)
        kept = {d: [] for d in "fb"}
        states = np.concatenate([self._run(words, d, kept[d]) for d in "fb"], axis=2)
        prob = self._softmax(states)
        places = prob.shape[0] * n
        at = np.arange(n)
        loss = -np.log(np.maximum(prob[:, at, y], 1e-12)).sum() / places
        dz = prob.copy()
        dz[:, at, y] -= 1
        dz /= places
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"] = np.tensordot(states, dz, axes=([0, 1], [0, 1]))
        g["b"] = dz.sum(axis=(0, 1))
        ds = dz @ self.p["o"].T
        for j, d in enumerate("fb"):
            u, v = self.p["u" + d], self.p["v" + d]
            back = np.zeros((n, h), dtype=ds.dtype)
            for t, state, r, z, new in reversed(kept[d]):
                dh = ds[t][:, j * h:(j + 1) * h] + back
                dn = dh * (1 - z) * (1 - new * new)
                drs = dn @ v.T
                da = np.concatenate([drs * state * r * (1 - r), dh * (state - new) * z * (1 - z)], axis=1)
                g["v" + d] += (r * state).T @ dn
                g["u" + d] += state.T @ da
                np.add.at(g["x" + d], words[:, t], np.concatenate([da, dn], axis=1))
                back = dh * z + drs * r + da @ u.T
        return float(loss), g

    def fit(self, words: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = RATE, seed: int = 0) -> None:
        """Adam over batches; ``words[i]`` is a (words, length) array, ``labels[i]`` its labels."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            batches = []
            for i, w in enumerate(words):
                order = r.permutation(len(w))
                batches += [(i, order[a:a + BATCH]) for a in range(0, len(w), BATCH)]
            for k in r.permutation(len(batches)):
                i, rows = batches[k]
                _, g = self.gradients(words[i][rows], labels[i][rows])
                step += 1
                now = rate * (0.5 ** epoch) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for key, grad in g.items():
                    m[key] += 0.1 * (grad - m[key])
                    s[key] += 0.001 * (grad * grad - s[key])
                    self.p[key] -= (now * m[key] / (np.sqrt(s[key]) + 1e-8)).astype(np.float32)


def _segments(texts: Texts) -> tuple[Texts, np.ndarray, np.ndarray]:
    """Lower-cased texts, and the byte spans of their words of letters, cut to at most MAX_BYTES."""
    lower = Texts(np.frombuffer(texts.data.tobytes().translate(_LOWER), dtype=np.uint8), texts.bounds)
    start, end = lower.runs(_LETTERS[lower.data])
    parts = -(-(end - start) // MAX_BYTES)
    word = np.repeat(np.arange(len(start)), parts)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)
    a = start[word] + nth * MAX_BYTES
    b = np.minimum(a + MAX_BYTES, end[word])
    return lower, a, b


def _has_letter(texts: Texts) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = np.zeros(256, dtype=bool)
    ascii_letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    out = np.bincount(texts.owner(np.flatnonzero(ascii_letter[texts.data])), minlength=texts.n) > 0
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in texts.text(i).decode())
    return out


def train(texts: dict[str, list[str]], hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 0,
          sample_words: int = SAMPLE_WORDS) -> tuple[list[str], BiGRU]:
    """(languages, network) from some texts of each language."""
    r = np.random.default_rng(seed)
    words = {}
    for lang in sorted(texts):
        raw = [t.encode() for t in texts[lang]]
        lower, a, b = _segments(Texts(np.frombuffer(b"".join(raw), dtype=np.uint8),
                                      np.append(0, np.cumsum([len(x) for x in raw], dtype=np.int64)).astype(np.int64)))
        words[lang] = [lower.data[a[i]:b[i]].tobytes() for i in r.permutation(len(a))[:sample_words]]
    return train_words(words, hidden, epochs, seed)


def train_words(words: dict[str, list[bytes]], hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 0) -> tuple[list[str], BiGRU]:
    """(languages, network) from some words of each language, as ``_segments`` cuts them."""
    languages = sorted(words)
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for k, lang in enumerate(languages):
        for word in words[lang]:
            by_length.setdefault(len(word), []).append((word, k))
    arrays = [np.frombuffer(b"".join(w for w, _ in by_length[n]), dtype=np.uint8).reshape(-1, n) for n in sorted(by_length)]
    labels = [np.array([k for _, k in by_length[n]]) for n in sorted(by_length)]
    net = BiGRU(max(1, len(languages)), hidden, seed)
    if len(languages) > 1:
        net.fit(arrays, labels, epochs, seed=seed)
    return languages, net


def _drawn(docs: DataFrame, most: int) -> DataFrame:
    """(lang, h, word) of (lang, salt, text): the ``most`` words of each text with the least hashes
    of text and place, which hold every word that can be among the ``most`` of its language."""

    def work(rows, texts: Texts) -> dict:
        lower, a, b = _segments(texts)
        salt = np.array(rows.column(rows.schema.get_field_index("salt")).to_pylist(), dtype=np.int64).astype(np.uint64)
        doc = texts.owner(a)
        h = mix(salt[doc] ^ mix((a - texts.bounds[doc]).astype(np.uint64)))
        order = np.lexsort((h, doc))
        nth = np.arange(len(order)) - np.searchsorted(doc, doc)
        order = order[nth < most]
        bounds = np.searchsorted(doc[order], np.arange(texts.n + 1))
        words = [lower.data[x:y].tobytes() for x, y in zip(a[order].tolist(), b[order].tolist())]
        return {"h": list_array(h[order].view(np.int64), bounds),
                "word": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(words, pa.binary()))}

    made = arrow_map(docs.select("lang", "salt", "text"), work, "h array<long>, word array<binary>", "text", ("lang",))
    return (made.select("lang", F.explode(F.arrays_zip("h", "word")).alias("w"))
            .select("lang", F.col("w.h").alias("h"), F.col("w.word").alias("word")))


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  sample: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> tuple[list[str], BiGRU]:
    """Learn every language from rows with a text, a language and an id outside the held-out
    fold: ``sample_words`` words of each, hash-drawn from the whole texts of the first ``sample``
    rows in hash order.  One row a language and the drawn words reach the driver."""
    x = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
         .where("text is not null and lang is not null")
         .where(fold_of(F.col("id"), FOLDS) != HELD_FOLD))
    counts = {r["lang"]: r["count"] for r in x.groupBy("lang").count().collect()}
    if not counts:
        return train_words({})
    salt = F.xxhash64("id", "text")
    share = F.pmod(F.xxhash64(F.lit("share"), salt), F.lit(1 << 30))
    # only about 3 * sample rows of a language meet, whatever its size
    cuts = docs.sparkSession.createDataFrame(
        [(lang, int(min(1.0, 3 * sample / n) * (1 << 30)) + 1) for lang, n in counts.items()], "lang string, cut long")
    some = (x.withColumn("salt", salt).join(F.broadcast(cuts), "lang").where(share < F.col("cut"))
            .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("salt", "id", "text")))
            .where(F.col("nth") <= sample).select("lang", "salt", "text"))
    drawn = (_drawn(some, sample_words)
             .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h", "word")))
             .where(F.col("nth") <= sample_words).select("lang", "nth", "word").collect())
    words: dict[str, list[bytes]] = {lang: [] for lang in counts}
    for r in sorted(drawn, key=lambda r: (r["lang"], r["nth"])):
        words[r["lang"]].append(bytes(r["word"]))
    return train_words(words)


def predict_languages(docs: DataFrame, model: tuple[list[str], BiGRU], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, held_out, lang_pred, score (the pooled probability).

    Null texts and texts without a letter, and all texts if no language was learnt, are ``und``
    with score 0; null ids are not held out; repeated rows are predicted alike; other columns
    are ignored.
    """
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    languages, net = model

    def start():
        places: dict[int, int] = {}
        table = np.zeros((1 << 12, net.n), dtype=np.float32)    # summed probabilities of each word

        def look_up(lower, a, b):
            """The table's row of each word; new words go through the network."""
            nonlocal table
            key, first, which = np.unique(span_hash(lower.data, a, b), return_index=True, return_inverse=True)
            if len(places) > min(400_000, (1 << 25) // net.n):   # bounds the task's memory, not the result
                places.clear()
            keys = key.tolist()
            new = np.array([k not in places for k in keys], dtype=bool)
            base = len(places)
            for i, k in enumerate(key[new].tolist()):
                places[k] = base + i
            if base + new.sum() > len(table):
                table = np.concatenate([table, np.zeros((max(len(table), int(new.sum())), net.n), dtype=np.float32)])
            at, size = a[first[new]], (b - a)[first[new]]
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                for some in np.array_split(rows, -(-len(rows) // max(1, min(4096, (1 << 18) // net.n)))):
                    words = lower.data[at[some][:, None] + np.arange(n)]
                    table[base + some] = net.label(words).sum(axis=0)
            return np.array([places[k] for k in keys], dtype=np.int64)[which]

        def work(_, texts: Texts) -> dict:
            lower, a, b = _segments(texts)
            known = _has_letter(texts) & bool(languages)
            pooled = np.zeros((texts.n, net.n))
            if len(a):
                doc, row = texts.owner(a), look_up(lower, a, b)
                size = np.maximum(np.bincount(doc, weights=b - a, minlength=texts.n), 1)
                for k in range(net.n):
                    pooled[:, k] = np.bincount(doc, weights=table[row, k], minlength=texts.n) / size
            best = pooled.argmax(axis=1)
            return {"lang_pred": [languages[k] if ok else UNKNOWN for k, ok in zip(best, known)],
                    "score": np.where(known, np.clip(pooled[np.arange(texts.n), best], 0, 1), 0.0)}

        return work

    out = arrow_map(x, start, "lang_pred string, score double", "_text", ("_id",), max_bytes=1 << 20, per_task=True)
    return out.select(F.col("_id").alias(id_col),
                      F.coalesce(fold_of(F.col("_id"), FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"), "lang_pred", "score")
