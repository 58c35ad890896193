"""Item affinity from sequences (M4-M7, S11 -> T8).

The reference trains a neural next-item model on the padded sequences; the
Spark job keeps its inputs and outputs and replaces the network with
next-item counts, smoothed by popularity (SURVEY section 7):

    P(i | j) = (c_ji + alpha * pop_i) / (c_j + alpha),   pop_i = c_i / N

``c_ji`` counts j directly followed by i inside one sequence (padding
excluded), ``c_j`` counts j as a predecessor, ``c_i`` counts i over all
sequence items and ``N`` is the number of sequence items, per activity
type.  Fitting is three aggregations; scoring is equi-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .. import config
from ..session import materialize_many

K = ("activity_type",)


def _items(sequences: DataFrame) -> DataFrame:
    """Non-padding items of every sequence, one row each."""
    return (sequences.select(*K, F.explode("items").alias("item"))
            .where(F.col("item") != 0))


def _pairs(sequences: DataFrame) -> DataFrame:
    """Adjacent (src, dst) items inside each sequence; padding is on the left,
    so a pair is real when its src is not 0."""
    n = F.size("items") - 1
    z = F.arrays_zip(F.slice("items", 1, n).alias("src"), F.slice("items", 2, n).alias("dst"))
    return (sequences.select(*K, F.explode(z).alias("p"))
            .select(*K, F.col("p.src").alias("src"), F.col("p.dst").alias("dst"))
            .where(F.col("src") != 0))


def fit(sequences: DataFrame) -> dict[str, DataFrame]:
    """M4: item and transition count tables per activity type.

    ``items``: ``(activity_type, item, item_count, total)``;
    ``transitions``: ``(activity_type, src, dst, pair_count, src_count)``.
    Every count is a map-side-combined aggregate, so a hot item costs one
    partial row per task before the shuffle.  The item and pair counts (the
    fitted model) are written once to the checkpoint folder, as two
    concurrent jobs; totals and predecessor counts are derived from them.
    """
    counts, pairs = materialize_many(
        _items(sequences).groupBy(*K, "item").agg(F.count(F.lit(1)).alias("item_count")),
        _pairs(sequences).groupBy(*K, "src", "dst").agg(F.count(F.lit(1)).alias("pair_count")))
    return tables_of(counts, pairs)


def tables_of(counts: DataFrame, pairs: DataFrame) -> dict[str, DataFrame]:
    """The model tables from written item and pair counts."""
    totals = counts.groupBy(*K).agg(F.sum("item_count").alias("total"))
    src = pairs.groupBy(*K, "src").agg(F.sum("pair_count").alias("src_count"))
    # one row per activity type in ``totals``; ``src`` is re-aggregated from
    # the written pair counts, so both derived tables stay cheap scans
    return {"items": counts.join(F.broadcast(totals), list(K)),
            "transitions": pairs.join(src, [*K, "src"])}


def transition_probabilities(model: dict[str, DataFrame],
                             alpha: float = config.AFFINITY_ALPHA) -> DataFrame:
    """Smoothed ``P(dst | src)`` for every observed transition."""
    it = model["items"].select(*K, F.col("item").alias("dst"), "item_count", "total")
    t = model["transitions"].join(it, [*K, "dst"])
    prob = ((F.col("pair_count") + F.lit(alpha) * F.col("item_count") / F.col("total"))
            / (F.col("src_count") + F.lit(alpha)))
    return t.select(*K, "src", "dst", "pair_count", "src_count", prob.alias("prob"))


def last_items(sequences: DataFrame) -> DataFrame:
    """Newest item of each user's newest sequence (chunk 0, last slot)."""
    return (sequences.where(F.col("chunk") == 0)
            .select("email", *K, F.element_at("items", -1).alias("src")))


def score(candidates: DataFrame, sequences: DataFrame, model: dict[str, DataFrame],
          alpha: float = config.AFFINITY_ALPHA) -> DataFrame:
    """M5: ``pred`` for each ``(email, activity_type, activity, item)`` the
    user viewed, given the newest item of the user's sequences.

    An unseen predecessor or candidate falls back to popularity (or 0).
    """
    last = last_items(sequences)
    c = candidates.join(last, ["email", *K])
    it = model["items"].select(*K, F.col("item"), "item_count", "total")
    tr = model["transitions"].select(*K, "src", F.col("dst").alias("item"), "pair_count")
    srcs = model["transitions"].select(*K, "src", "src_count").distinct()
    totals = model["items"].select(*K, "total").distinct()
    j = (c.join(it.drop("total"), [*K, "item"], "left")
         .join(F.broadcast(totals), list(K), "left")
         .join(tr, [*K, "src", "item"], "left")
         .join(srcs, [*K, "src"], "left"))
    pop = F.coalesce(F.col("item_count") / F.col("total"), F.lit(0.0))
    pred = ((F.coalesce(F.col("pair_count"), F.lit(0)) + F.lit(alpha) * pop)
            / (F.coalesce(F.col("src_count"), F.lit(0)) + F.lit(alpha)))
    return j.select("email", "activity", *K, pred.alias("pred"))


def reciprocal_ranks(test: DataFrame, model: dict[str, DataFrame],
                     universe: DataFrame, alpha: float = config.AFFINITY_ALPHA) -> DataFrame:
    """M6: reciprocal rank of each test sequence's last item among all items
    of ``universe`` (``(activity_type, max_item)``: items 0..max_item),
    scored from the item before it; ties take the average rank.

    Scores compare as the integer pair ``(c_ji, c_i)`` (the smoothing term
    is below 1), so ranks are exact and need no pairwise comparison:

    That holds while ``alpha`` times an item's share stays below one whole pair, which
    every ``0 < alpha <= 1`` ensures; another ``alpha`` raises.

    * target seen after j: items above it are j's successors with a larger
      pair, found by a running sum over j's distinct count pairs;
    * target never after j: all of j's successors are above it, plus items
      with a larger popularity among the others -- a running sum over the
      distinct item counts of the universe minus those of j's successors.
    """
    if not 0 < alpha <= 1:
        raise ValueError("ranks by count pairs need 0 < alpha <= 1")
    tr = model["transitions"].select(*K, "src", F.col("dst").alias("item"), "pair_count")
    cnt = model["items"].select(*K, "item", "item_count")
    q = (test.select(*K, F.element_at("items", -2).alias("src"),
                     F.element_at("items", -1).alias("item"), "email", "chunk")
         .join(cnt, [*K, "item"], "left")
         .join(tr, [*K, "src", "item"], "left")
         .select(*K, "email", "chunk", "src", "item",
                 F.coalesce("item_count", F.lit(0)).alias("ct"),
                 F.coalesce("pair_count", F.lit(0)).alias("cjt")))

    # successors of j, keyed by (pair_count, item_count)
    succ = tr.join(cnt, [*K, "item"]).groupBy(*K, "src", "pair_count", "item_count").agg(
        F.count(F.lit(1)).alias("m"))
    w_pair = (Window.partitionBy(*K, "src").orderBy(F.desc("pair_count"), F.desc("item_count"))
              .rowsBetween(Window.unboundedPreceding, -1))
    case_a = succ.select(*K, "src", F.col("pair_count").alias("cjt"), F.col("item_count").alias("ct"),
                         F.coalesce(F.sum("m").over(w_pair), F.lit(0)).alias("a_gt"),
                         F.col("m").alias("a_eq"))
    degree = succ.groupBy(*K, "src").agg(F.sum("m").alias("deg"))

    # successors of j by item count, with the query counts inserted (m = 0)
    by_c = (succ.select(*K, "src", F.col("item_count").alias("c"), "m")
            .unionByName(q.where(F.col("cjt") == 0)
                         .select(*K, "src", F.col("ct").alias("c"), F.lit(0).cast("long").alias("m")))
            .groupBy(*K, "src", "c").agg(F.sum("m").alias("m")))
    w_c = (Window.partitionBy(*K, "src").orderBy(F.desc("c"))
           .rowsBetween(Window.unboundedPreceding, -1))
    h = by_c.select(*K, "src", F.col("c").alias("ct"),
                    F.coalesce(F.sum("m").over(w_c), F.lit(0)).alias("h_gt"),
                    F.col("m").alias("h_eq"))

    # the universe by item count: seen items plus the never-seen ids 0..max
    seen = cnt.groupBy(*K, "item_count").agg(F.count(F.lit(1)).alias("e"))
    n_seen = cnt.groupBy(*K).agg(F.count(F.lit(1)).alias("_n"))
    zeros = (universe.join(n_seen, list(K), "left")
             .select(*K, F.lit(0).cast("long").alias("item_count"),
                     (F.col("max_item") + 1 - F.coalesce("_n", F.lit(0))).alias("e")))
    by_count = seen.unionByName(zeros).groupBy(*K, "item_count").agg(F.sum("e").alias("e"))
    w_u = (Window.partitionBy(*K).orderBy(F.desc("item_count"))
           .rowsBetween(Window.unboundedPreceding, -1))
    g = by_count.select(*K, F.col("item_count").alias("ct"),
                        F.coalesce(F.sum("e").over(w_u), F.lit(0)).alias("g_gt"),
                        F.col("e").alias("g_eq"))

    x = (q.join(case_a, [*K, "src", "cjt", "ct"], "left")
         .join(degree, [*K, "src"], "left")
         .join(h, [*K, "src", "ct"], "left")
         .join(g, [*K, "ct"], "left"))
    seen_after = F.col("cjt") >= 1
    gt = F.when(seen_after, F.col("a_gt")).otherwise(
        F.coalesce("deg", F.lit(0)) + F.col("g_gt") - F.coalesce("h_gt", F.lit(0)))
    eq = F.when(seen_after, F.col("a_eq")).otherwise(F.col("g_eq") - F.coalesce("h_eq", F.lit(0)))
    rank = F.lit(1.0) + gt + (eq - F.lit(1)) / F.lit(2.0)
    return x.select(*K, "email", "chunk", "src", "item", (F.lit(1.0) / rank).alias("rr"))


def mean_reciprocal_rank(rr: DataFrame) -> DataFrame:
    """Mean reciprocal rank per activity type."""
    return rr.groupBy(*K).agg(F.avg("rr").alias("mrr"), F.count(F.lit(1)).alias("sequences"))


def universe_of(sequences: DataFrame) -> DataFrame:
    """Item id range a model scores over: 0..max item seen, per type."""
    return (sequences.select(*K, F.explode("items").alias("item"))
            .groupBy(*K).agg(F.max("item").alias("max_item")))


# -- S11 / M7: artefacts ---------------------------------------------------------
def save_model(model: dict[str, DataFrame], path: str) -> None:
    """Write the count tables as parquet under ``path`` (any Hadoop FS)."""
    for name, df in model.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_model(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}")
            for name in ("items", "transitions")}


def model_record(mrr: DataFrame, version: int) -> DataFrame:
    """M7: one row per model type: name ``seq_<type>_model<version>`` and metrics."""
    return mrr.select(F.concat(F.lit("seq_"), F.col("activity_type"), F.lit("_model"),
                               F.lit(str(version))).alias("name"),
                      "activity_type", "mrr", "sequences")
