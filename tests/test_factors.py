"""Factors of transitions: ranks against brute force, what they learn, the comparison with counts."""

import random

import numpy as np
import pytest
from conftest import SF_SMALL

from browsekit.operators import affinity, factors
from browsekit.plans import jobs
from browsekit.sources.fixtures import FixtureTables

SEQ = "email string, activity_type string, chunk int, items array<int>"


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 4)])
def test_ranks_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(factors, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(factors, "ITEM_BLOCK", blocks[1])
    r = random.Random(5)
    dim, top = 3, {"pid": 20, "cgid": 8}
    vec = {(side, t, i): [float(r.randint(-2, 2)) for _ in range(dim)]      # whole numbers: many ties
           for side in ("src", "dst") for t in top for i in range(1, top[t], 2 if side == "src" else 3)}
    model = {side: spark.createDataFrame([(t, i, v) for (s, t, i), v in vec.items() if s == side],
                                         "activity_type string, id int, factors array<float>")
             for side in ("src", "dst")}
    tests = [(f"u{n % 7}", t, n, [0, 0, r.randint(0, top[t]), r.randint(1, top[t])])
             for n in range(40) for t in top]
    universe = spark.createDataFrame(list(top.items()), "activity_type string, max_item int")
    got = factors.reciprocal_ranks(spark.createDataFrame(tests, SEQ), model, universe)
    zero = [0.0] * dim
    want = []
    for e, t, c, items in tests:
        src, dst = items[-2:]
        left = np.array(vec.get(("src", t, src), zero))
        scores = [left @ np.array(vec.get(("dst", t, i), zero)) for i in range(top[t] + 1)]
        above = sum(s > scores[dst] for s in scores)
        same = sum(s == scores[dst] for s in scores)
        want.append((t, e, c, src, dst, round(1 / (1 + above + (same - 1) / 2), 9)))
    assert sorted((*tuple(x)[:5], round(x.rr, 9)) for x in got.collect()) == sorted(want)


def test_factors_find_unseen_pairs_of_like_items(spark):
    """Two groups of items that follow each other: a pair never seen inside a group ranks above the other group."""
    rows = [("pid", a, b, 5) for g in (range(1, 9), range(9, 17)) for a in g for b in g if a != b and (a, b) != (1, 2)]
    pairs = spark.createDataFrame(rows, "activity_type string, src int, dst int, pair_count bigint")
    model = factors.fit(pairs, rank=4)
    universe = spark.createDataFrame([("pid", 16)], "activity_type string, max_item int")
    test = spark.createDataFrame([("u", "pid", 0, [1, 2]), ("u", "pid", 1, [1, 12])], SEQ)
    rr = {x.item: x.rr for x in factors.reciprocal_ranks(test, model, universe).collect()}
    assert rr[2] >= 1 / 8 > rr[12]
    again = factors.fit(pairs, rank=4)
    for side in model:
        a, b = (dict(((x.activity_type, x.id), x.factors) for x in m[side].collect()) for m in (model, again))
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-4) for k in a)


def test_nothing_to_learn(spark):
    pairs = spark.createDataFrame([], "activity_type string, src int, dst int, pair_count bigint")
    model = factors.fit(pairs)
    universe = spark.createDataFrame([("pid", 4)], "activity_type string, max_item int")
    test = spark.createDataFrame([("u", "pid", 0, [1, 2])], SEQ)
    assert [x.rr for x in factors.reciprocal_ranks(test, model, universe).collect()] == [1 / 3]


def test_both_models_on_the_test_part(spark):
    got = {(r.model, r.activity_type): r for r in jobs.compare_models(FixtureTables(spark, SF_SMALL)).collect()}
    t = jobs.build_training(FixtureTables(spark, SF_SMALL))
    for r in affinity.mean_reciprocal_rank(t.reciprocal_ranks).collect():
        counts, by_factors = got["counts", r.activity_type], got["factors", r.activity_type]
        assert counts.mrr == pytest.approx(r.mrr) and counts.sequences == by_factors.sequences == r.sequences
        assert 0 < by_factors.mrr <= 1
