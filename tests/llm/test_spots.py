import base64
import hashlib
from collections import Counter

import numpy as np
import pytest

from browsekit.llm import spots

from .cases import SCHEMA, clashing, empty_docs, odd_docs, prose


def as_set(fingerprint):
    return set(np.frombuffer(base64.b64decode(fingerprint), dtype="<u4").tolist())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, docs):
    rows = spots.neighbour_likeness(docs).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts)
    print_of = {}
    for r in spots.fingerprints(docs.select("text"), "text", "text").collect():
        assert print_of.setdefault(r["text"] or "", r["fingerprint"]) == r["fingerprint"]
    ids = [i for i, _ in texts]
    if len(set(ids)) < len(ids):        # the order among equal ids is the operator's own
        assert Counter(r["fingerprint"] for r in rows) == Counter(print_of[t] for _, t in texts)
        return rows
    texts.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    got = {r["doc_id"]: r for r in rows}
    want, edits = [], []
    for (i, t), (_, after) in zip(texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        edit = t[:len(t) - half] + after[:half]
        edits.append((edit,))
        want.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), print_of[t], edit, after))
    edited = spark.createDataFrame(edits, "text string")
    edit_print = {r["text"]: r["fingerprint"] for r in spots.fingerprints(edited, "text", "text").collect()}
    for i, n, sha, own, edit, after in want:
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (n, sha, own, edit_print[edit])
        assert r["near_edited"] == pytest.approx(likeness(as_set(own), as_set(edit_print[edit])))
        assert r["near_next"] == pytest.approx(likeness(as_set(own), as_set(print_of[after])))
    return rows


def test_odd_rows_and_clashing_names(spark):
    check(spark, odd_docs(spark))
    check(spark, clashing(odd_docs(spark)))
    check(spark, odd_docs(spark).where("doc_id < 7 or doc_id is null and text is null"))
    assert check(spark, empty_docs(spark)) == []
    one = check(spark, odd_docs(spark).where("doc_id = 5"))
    assert one[0]["near_next"] == 1.0


def test_whole_table_tells_edits_from_strangers(spark):
    rows = check(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    apart = sum(r["near_edited"] > r["near_next"] for r in rows if r["n_chars"] > 200)
    assert apart >= 0.95 * sum(r["n_chars"] > 200 for r in rows)


def test_signatures_follow_the_definition(spark):
    """Chains of content words after anchors, on a text small enough to read."""
    text = "The cat sat on a mat. The dog, the dog and THE DOG ran far from home"
    words = text.lower().replace(".", "").replace(",", "").split()
    content = [i for i, w in enumerate(words) if w not in spots.ANCHORS]
    chains = set()
    for i, w in enumerate(words):
        after = [j for j in content if j > i][:2]
        if w in spots.ANCHORS and len(after) == 2:
            chains.add((w, *(words[j] for j in after)))
    row = spots.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(row["spots"]) == len(chains) == len(as_set(row["fingerprint"]))


def test_few_anchors_share_signatures_with_many(spark):
    """A half without anchors stays recognisable whatever the number of anchors in the other half."""
    table = " ".join(f"item{i} price{i}" for i in range(20))
    sparse = "the " + table
    talk = " ".join(f"the dog{i} of cat{i}" for i in range(40))
    docs = spark.createDataFrame([(1, table, None, None, None), (2, talk, None, None, None),
                                  (3, sparse, None, None, None), (4, talk, None, None, None)], SCHEMA)
    rows = {r["doc_id"]: r for r in spots.neighbour_likeness(docs).collect()}
    assert all(rows[i]["near_edited"] > 0.2 > rows[i]["near_next"] for i in (1, 3))
    both = spark.createDataFrame([(5, table + " " + talk, None, None, None)], SCHEMA)
    whole = set(spots.fingerprints(both).first()["spots"])
    assert as_set(rows[1]["fingerprint"]) <= whole and as_set(rows[2]["fingerprint"]) <= whole


def test_similar_pairs_against_brute_force(spark):
    rows = []
    for g in range(6):
        base = ("the " + prose(g, 160).replace(" ", " of ", 40)).split()
        for i in range(8):
            w = list(base)
            for j in range(i):
                w[(17 * j + 5 * i) % len(w)] = f"q{g}{i}{j}"
            rows.append((10 * g + i, " ".join(w), None, None, None))
    docs = spark.createDataFrame(rows + rows[:3] + [(99, "", None, None, None)], SCHEMA)
    sets = {r["doc_id"]: frozenset(r["spots"]) for r in spots.fingerprints(docs).collect()}
    want = {frozenset((sets[a], sets[b])) for a in sets for b in sets
            if sets[a] != sets[b] and sets[a] and likeness(sets[a], sets[b]) >= 0.7}
    pairs, members = spots.similar_pairs(docs, 0.7)
    of = {r["f"]: sets[r["doc_id"]] for r in members.collect()}
    got = [frozenset((of[r["a"]], of[r["b"]])) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
