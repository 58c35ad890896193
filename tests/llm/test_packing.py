import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from browsekit.llm import packing
from browsekit.llm.queries import tokenizer_path
from browsekit.llm.tokens import Encoder

from .cases import clashing, empty_docs, odd_docs


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def check(docs, tokenizer, capacity=2048, fill=None):
    rows = packing.pack_documents(docs, tokenizer_path(), capacity=capacity, with_ids=True).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(tokenizer.encode(t, add_special_tokens=False).ids + [1])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(want)
    for i, lists in want.items():
        # rows that share an id are taken apart by matching pieces to places
        left = sorted((r["start"], bytes(r["ids"]), r["doc_tokens"]) for r in by_doc[i])
        for ids in lists:
            raw, at = np.array(ids, dtype="<u4").tobytes(), 0
            while at < len(ids):
                hit = next(p for p in left if p[0] == at and p[2] == len(ids) and raw[4 * at:].startswith(p[1]))
                left.remove(hit)
                at += len(hit[1]) // 4
        assert not left
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    if fill:
        assert sum(r["length"] for r in rows) >= fill * capacity * len(by_seq)
    return rows


def test_odd_rows_and_clashing_names(spark, tokenizer):
    check(odd_docs(spark), tokenizer)
    check(clashing(odd_docs(spark)), tokenizer, capacity=64)
    assert check(empty_docs(spark), tokenizer) == []


def test_whole_table_with_little_padding(spark, tokenizer):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), tokenizer, fill=0.99)


def test_sequences_round_trip(spark, tokenizer):
    packed = packing.pack_documents(odd_docs(spark), tokenizer_path(), capacity=128, with_ids=True)
    rows = packing.sequences(packed, 128).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 512 for r in rows)
    ends = sum((np.frombuffer(r["ids"], dtype="<u4") == 1).sum() for r in rows)
    assert ends >= odd_docs(spark).count()


def test_pieces_as_the_tokenizer_cuts(tokenizer):
    """Random strings over awkward characters give the ids of the library."""
    from browsekit.llm.text import Texts

    r = random.Random(4)
    alphabet = list("ab'stmdrevl  \n\t 　\x1c\x85.,!#09") + ["'s", "'ll", "'re", "é", "ß", "日", "٣", "Ⅷ", "²", "́", "😀", "​", "ǅ", "　"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 40))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ids, bounds = Encoder(tokenizer_path()).encode(Texts(data, np.append(0, np.cumsum([len(x) for x in raw]))))
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_added_tokens_as_the_tokenizer_finds_them():
    """Literals of added tokens give the ids of the library in its default settings."""
    from tokenizers import AddedToken, Tokenizer

    from browsekit.llm.text import Texts

    library = Tokenizer.from_file(tokenizer_path())
    assert library.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    r = random.Random(5)
    alphabet = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", "b's", "é", "日", "1", "<|", ""]
    texts = ["a<|endoftext|>b", "<|endof", "text|>", "", "<|endoftext|>"]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 12))) for _ in range(500)]
    raw = [t.encode() for t in texts]
    data = Texts(np.frombuffer(b"".join(raw), dtype=np.uint8), np.append(0, np.cumsum([len(x) for x in raw])))
    plain, wide = Encoder(tokenizer_path()), Encoder(tokenizer_path())
    wide.tokenizer.add_special_tokens([AddedToken("b's", lstrip=True, rstrip=True)])
    wide.added[b"b's"] = wide.tokenizer.token_to_id("b's")
    wide.plain = False
    wide.marks = re.compile(rb"<\|endoftext\|>|b's")
    for encoder in (plain, wide):
        ids, bounds = encoder.encode(data)
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_documents_with_added_tokens(spark):
    text = "one<|endoftext|>two <|endoftext|>"
    from tokenizers import Tokenizer

    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = packing.pack_documents(docs, tokenizer_path(), with_ids=True).first()
    want = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids + [1]
    assert np.frombuffer(row["ids"], dtype="<u4").tolist() == want and 50256 in want


def test_differencing_is_a_partition_with_near_equal_sums():
    r = random.Random(2)
    for k in (1, 2, 7, 30):
        sizes = [r.randrange(1, 300) for _ in range(400)]
        window = packing.differencing(sizes, k)
        sums = np.bincount(window, weights=sizes, minlength=k)
        assert len(window) == 400 and set(window) <= set(range(k))
        assert sums.max() - sums.min() <= 40
    assert packing.differencing([4, 5, 6, 7, 8], 2).tolist().count(0) in (2, 3)
    assert sorted(np.bincount(packing.differencing([8, 7, 6, 5, 4], 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    window = packing.windows_of([60, 60, 60], 100)      # two windows would hold 180, but no two fit
    assert len(set(window.tolist())) == 3


def test_long_texts_are_encoded_in_parts(monkeypatch):
    """Texts of megabytes, cut inside: the same ids as the tokenizer's, also when pieces are forgotten."""
    from tokenizers import Tokenizer

    import pyarrow as pa

    from browsekit.llm import tokens
    from browsekit.llm.text import slices

    monkeypatch.setattr(tokens, "PART", 1 << 14)
    monkeypatch.setattr(tokens, "ARENA_BYTES", 1 << 12)
    r = random.Random(3)
    words = ["the", "they're", "né", "日本", "x1", "  ", "\n", "--", "a's", "٣٣", "don't", "Word", "<|endoftext|>"]
    mixed = " ".join(r.choice(words) + r.choice(words) for _ in range(60_000))
    texts = ["short", mixed, "", "nospace" * 20_000, "a b", "日本語" * 20_000 + " and so on " * 5_000]
    library = Tokenizer.from_file(tokenizer_path())
    encoder, got = Encoder(tokenizer_path()), []
    for _, part in slices(pa.array(texts)):
        ids, bounds = encoder.encode(part)
        got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
