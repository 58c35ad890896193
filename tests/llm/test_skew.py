"""Joins by known counts, against a plain join."""

import random

from browsekit.llm.skew import PARTS, join_by_count


def check(spark, rows, table):
    left = spark.createDataFrame(rows, "k long, j string, v long")
    right = spark.createDataFrame([(k, j, x, sum((a, b) == (k, j) for a, b, _ in rows)) for k, j, x in table],
                                  "k long, j string, x long, n long")
    got = join_by_count(left, right, ["k", "j"], "n")
    assert got.columns == ["k", "j", "v", "x"]
    want = sorted((k, j, v, x) for k, j, v in rows for a, b, x in table if (a, b) == (k, j))
    assert sorted(map(tuple, got.collect())) == want


def test_hot_and_rare_keys(spark):
    rng = random.Random(5)
    rows = [(1, "hot", i) for i in range(700)] + [(2, "hot", i) for i in range(300)]
    rows += [(rng.randrange(3, 600), "rare", i) for i in range(1500)]
    check(spark, rows, [(k, "rare" if k > 2 else "hot", -k) for k in range(0, 700)])


def test_all_hot_repeated_and_null(spark):
    check(spark, [(1, "a", 1), (1, "a", 1), (None, "a", 2), (1, None, 3)], [(1, "a", 9), (4, "a", 8)])


def test_empty(spark):
    check(spark, [], [])
    check(spark, [(1, "a", 1)], [])
    check(spark, [], [(1, "a", 1)])


def test_the_broadcast_side_is_bounded(spark):
    rows = spark.range(PARTS * 4).selectExpr(f"id % {PARTS * 2} as k")
    table = rows.groupBy("k").count()
    plan = join_by_count(rows, table, ["k"], "count")
    assert plan.count() == PARTS * 4
    total = PARTS * 4
    assert table.where(f"count * {PARTS} > {total}").count() < PARTS
