"""Next-item factors beside the counts (M4, M6, A13): implicit matrix factorisation of transitions.

Rows of the matrix are predecessors, columns the items that follow, cells the next-item
counts of ``affinity.fit`` as confidences, factorised by Spark's alternating least squares.  Where the
counts know nothing of a pair, factors still place items followed by like items together.  Models are
compared by M6 on the same test sequences.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, materialize
from .sequences import TYPES

RANK = 16
ITERATIONS = 10
ALPHA = 10.0            # confidence per observed transition
REGULARISATION = 0.05
QUERY_BLOCK = 1024      # rows of a block of targets
ITEM_BLOCK = 4096       # rows of a block of items: scores of two blocks are 32 MB
TILE = 32               # blocks of either side that one group scores: 32,768 targets with 131,072 items


def fit(pairs: DataFrame, rank: int = RANK, iterations: int = ITERATIONS, alpha: float = ALPHA,
        regularisation: float = REGULARISATION, seed: int = 0, types=TYPES) -> dict[str, DataFrame]:
    """Factors of ``(activity_type, src, dst, pair_count)``, one model a type: ``src`` and ``dst``, each
    ``(activity_type, id, factors)``.  A type without transitions has no factors."""
    spark = pairs.sparkSession
    checkpoint_dir(spark)       # the iterations cut their lineage there
    sides: dict[str, list[DataFrame]] = {"src": [], "dst": []}
    for t in types:
        counts = pairs.where(F.col("activity_type") == t).select(
            "src", "dst", F.col("pair_count").cast("float").alias("pair_count"))
        if counts.isEmpty():
            continue
        model = ALS(rank=rank, maxIter=iterations, regParam=regularisation, implicitPrefs=True, alpha=alpha,
                    userCol="src", itemCol="dst", ratingCol="pair_count", seed=seed).fit(counts)
        for side, df in (("src", model.userFactors), ("dst", model.itemFactors)):
            sides[side].append(df.select(F.lit(t).alias("activity_type"), "id", F.col("features").alias("factors")))
    empty = spark.createDataFrame([], "activity_type string, id int, factors array<float>")
    out = {}
    for side, parts in sides.items():
        df = empty
        for p in parts:
            df = df.unionByName(p)
        out[side] = materialize(df)
    return out


def _counter(query_block: int, item_block: int):
    # a function made here travels to the Python workers whole, without this package
    def above(queries: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        gt = np.zeros(len(queries), dtype=np.int64)
        eq = np.zeros(len(queries), dtype=np.int64)
        if len(queries) and len(items):
            left = np.stack(queries["left"]).astype(np.float64)
            factors = np.stack(items["factors"]).astype(np.float64)
            # a score equals the target's where, in units of 1e-9, it rounds (half to even) to the same number
            unit = np.rint(queries["score"].to_numpy(dtype=np.float64) * 1e9)
            odd = unit % 2 != 0
            high = np.where(odd, np.nextafter(unit + 0.5, -np.inf), unit + 0.5)[:, None]
            low = np.where(odd, unit - 0.5, np.nextafter(unit - 0.5, -np.inf))[:, None]
            for i in range(0, len(left), query_block):
                part = slice(i, i + query_block)
                for j in range(0, len(factors), item_block):
                    scores = left[part] @ factors[j:j + item_block].T
                    scores *= 1e9
                    more = np.count_nonzero(scores > high[part], axis=1)
                    gt[part] += more
                    eq[part] += np.count_nonzero(scores > low[part], axis=1) - more
        return pd.DataFrame({"q": queries["q"], "gt": gt, "eq": eq})

    return above


def count_above(queries: DataFrame, items: DataFrame) -> DataFrame:
    """``(q, gt, eq)``: how many items score above and like the target of each query, in parts to be summed.

    The table of queries by items is cut into tiles of ``TILE`` blocks a side, one group a tile, so that
    work and memory of a task are bounded and all tasks of the cluster take part, also when all
    rows are of one type.
    """
    cut = [df.groupBy("activity_type").agg(F.ceil(F.count(F.lit(1)) / (TILE * size)).cast("int").alias(name))
           for df, size, name in ((queries, QUERY_BLOCK, "_nq"), (items, ITEM_BLOCK, "_ni"))]
    tiles = materialize(cut[0].join(cut[1], "activity_type"))     # one row a type
    n = tiles.agg(F.sum(F.col("_nq") * F.col("_ni"))).first()[0] or 1

    def each(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def dealt(col: str, count: str):
        return F.pmod(F.xxhash64(col), F.col(count)).cast("int")

    tile = ["activity_type", "_qt", "_it"]
    left = (queries.join(F.broadcast(tiles), "activity_type")
            .select("activity_type", dealt("q", "_nq").alias("_qt"), each("_ni").alias("_it"), "q", "left", "score"))
    right = (items.join(F.broadcast(tiles), "activity_type")
             .select("activity_type", each("_nq").alias("_qt"), dealt("item", "_ni").alias("_it"), "factors"))
    return (left.repartition(n, *tile).groupBy(*tile).cogroup(right.repartition(n, *tile).groupBy(*tile))
            .applyInPandas(_counter(QUERY_BLOCK, ITEM_BLOCK), "q bigint, gt bigint, eq bigint"))


def reciprocal_ranks(test: DataFrame, model: dict[str, DataFrame], universe: DataFrame) -> DataFrame:
    """M6 by factors: reciprocal rank of each test sequence's last item among the items 0..max_item of
    ``universe``, scored from the item before it; ties take the average rank.

    The distinct (predecessor, target) pairs of the test are scored against all items in tiles, each
    tile of targets with each tile of items of its type (``count_above``).  A predecessor or item without
    factors scores 0; items without any are counted, not listed.  Scores are compared to nine
    decimals.  Columns as ``affinity.reciprocal_ranks``.
    """
    rank = model["dst"].select(F.size("factors")).first()
    zero = F.array_repeat(F.lit(0.0).cast("float"), rank[0] if rank else 1)
    t = test.select("activity_type", "email", "chunk", F.element_at("items", -2).alias("src"),
                    F.element_at("items", -1).alias("item"))
    wanted = materialize(t.select("activity_type", "src", "item").distinct()
                         .withColumn("q", F.monotonically_increasing_id()))
    left = model["src"].select("activity_type", F.col("id").alias("src"), F.col("factors").alias("left"))
    items = (model["dst"].join(F.broadcast(universe), "activity_type")      # one row a type
             .where(F.col("id") <= F.col("max_item")).select("activity_type", F.col("id").alias("item"), "factors"))
    products = F.zip_with("left", "_right", lambda a, b: a.cast("double") * b)
    queries = materialize(
        wanted.join(left, ["activity_type", "src"], "left")
        .join(items.withColumnRenamed("factors", "_right"), ["activity_type", "item"], "left")
        .withColumn("left", F.coalesce("left", zero)).withColumn("_right", F.coalesce("_right", zero))
        .withColumn("score", F.round(F.aggregate(products, F.lit(0.0), lambda s, x: s + x), 9))
        .select("activity_type", "q", "src", "item", "left", "score"))
    counted = count_above(queries, items).groupBy("q").agg(F.sum("gt").alias("gt"), F.sum("eq").alias("eq"))
    listed = items.groupBy("activity_type").agg(F.count(F.lit(1)).alias("_listed"))
    rest = F.col("max_item") + 1 - F.coalesce("_listed", F.lit(0))
    gt = F.coalesce("gt", F.lit(0)) + F.when(F.col("score") < 0, rest).otherwise(0)
    eq = F.coalesce("eq", F.lit(0)) + F.when(F.col("score") == 0, rest).otherwise(0)
    ranked = (queries.join(counted, "q", "left").join(F.broadcast(universe), "activity_type")
              .join(F.broadcast(listed), "activity_type", "left")
              .select("activity_type", "src", "item",
                      (1 / (1 + gt + (F.greatest(eq, F.lit(1)) - 1) / 2)).alias("rr")))
    return (t.join(ranked, ["activity_type", "src", "item"])
            .select("activity_type", "email", "chunk", "src", "item", "rr"))
