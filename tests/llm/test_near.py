import random
import re
from collections import Counter, defaultdict

import numpy as np

from browsekit.llm import near
from browsekit.llm.components import connected_components

from .cases import clashing, empty_docs, odd_docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=5):
    w = WORD.findall(text or "")
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute_classes(rows, threshold=0.8):
    """Partition of row numbers: components of all pairs at or above the threshold."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in at[x] if j < i)
        for j, n in both.items():
            if n / (len(s) + len(sets[j]) - n) >= threshold:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return list(groups.values())


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = Counter()
    for g in brute_classes(rows):
        ids = [rows[i][0] for i in g]
        known = [i for i in ids if i is not None]
        least = min(known) if known else None
        for i in ids:
            want[(i, least, len(g))] += 1
    got = near.near_duplicate_classes(docs).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == want
    assert sum(r["keep"] for r in got) == len(brute_classes(rows))


def test_odd_rows_and_clashing_names(spark):
    check(odd_docs(spark))
    check(clashing(odd_docs(spark)))
    check(empty_docs(spark))


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_chain_and_spread_group(spark):
    """Copies of copies, and a group whose members are mostly under the threshold to each other."""
    r = random.Random(7)
    base = prose(11, 200).split()
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(i % 9):
            w[r.randrange(len(w))] = f"x{r.random()}"
        rows.append((i, " ".join(w)))
    w = list(base)
    for i in range(60, 90):
        w[r.randrange(len(w))] = f"y{i}"
        rows.append((i, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_sketch_estimates_weighted_jaccard():
    r = np.random.default_rng(5)
    element = r.integers(0, 1 << 62, 400).astype(np.uint64)
    wa, wb = r.uniform(0, 6, 400), r.uniform(0, 6, 400)
    wa[::5], wb[::7] = 0, 0
    k = 4096
    sketch = near.dart_sketch(np.repeat([0, 1], 400), np.tile(element, 2), np.append(wa, wb), 2, k)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sketch[0] == sketch[1]).mean() - true) < 0.03
    alone = near.dart_sketch(np.zeros(400, dtype=int), element, wa, 1, k)
    assert (alone[0] == sketch[0]).all()


def test_drop_keeps_one_of_each_class(spark):
    docs = clashing(odd_docs(spark))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = near.drop_near_duplicates(docs, order_col="doc_id")
    assert kept.columns == docs.columns
    groups = brute_classes(rows)
    want = Counter(min((rows[i][0] for i in g if rows[i][0] is not None), default=None) for g in groups)
    assert Counter(r["doc_id"] for r in kept.collect()) == want
    assert near.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    got = {x["node"]: x["label"] for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[a] == got[b] for a, b in links if a != b)
    assert all(got[v] == v for v in set(got.values()))
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(50))
