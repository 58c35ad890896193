"""Sequences and affinity counts carried from batch to batch (W3, M4 -> T8).

Everything kept between batches is a mergeable summary, so a batch reads its own clicks and
the kept tables, never the clicks before:

* ``recent``: the newest ``n`` items of every user and type (``last_n``).  The newest n of
  two sets are the newest n of their own newest n, so merging is exact in any split and
  for late rows too, and W3's chunk 0 is read straight from it.
* ``items``, ``pairs``: item and next-item counts.  They add up over batches when a batch's
  first item follows the user's newest item of the batches before, which ``recent`` holds.

The pairs are those of unbroken sequences: W3 pads its windows from the newest item back, so
the cut between two windows moves with every new click and a fit on windows of ten loses
the pair at each cut.  ``carry`` over any split of the rows equals ``affinity.fit`` on sequences
long enough to hold a user's whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..session import materialize_many
from . import affinity
from .sequences import ORDER, minute

GROUP = ("email", "activity_type")


def last_n(rows: DataFrame, n: int, group_cols: Sequence[str] = GROUP, item_col: str = "item",
           order: Sequence[str] = ORDER) -> DataFrame:
    """The newest ``n`` rows of each group, as rows.

    ``row_number() <= n`` is planned with a limit in every task before the shuffle, so a hot
    user sends at most ``n`` rows a task.
    """
    g = list(group_cols)
    newest = Window.partitionBy(*g).orderBy(*[F.col(c).desc() for c in order])
    return (rows.select(*g, item_col, *order).withColumn("_r", F.row_number().over(newest))
            .where(F.col("_r") <= n).drop("_r"))


def merge_last_n(kept: DataFrame | None, rows: DataFrame, n: int, group_cols: Sequence[str] = GROUP,
                 item_col: str = "item", order: Sequence[str] = ORDER) -> DataFrame:
    """``last_n`` of everything seen so far, from the kept rows and a batch."""
    names = [*group_cols, item_col, *order]
    both = rows.select(*names) if kept is None else kept.select(*names).unionByName(rows.select(*names))
    return last_n(both, n, group_cols, item_col, order)


def newest_sequences(recent: DataFrame, length: int = config.MAX_SEQUENCE_LENGTH,
                     group_cols: Sequence[str] = GROUP, item_col: str = "item",
                     order: Sequence[str] = ORDER) -> DataFrame:
    """W3's chunk 0 from kept rows: ``(group..., chunk, items)``, left-padded with 0.  ``recent`` must
    keep at least ``length`` rows a group."""
    g = list(group_cols)
    in_order = F.array_sort(F.collect_list(F.struct(*order, F.col(item_col).alias("_v"))))
    seqs = (last_n(recent, length, group_cols, item_col, order).groupBy(*g)
            .agg(F.transform(in_order, lambda s: s["_v"]).alias("_items")))
    pad = F.array_repeat(F.lit(0), F.lit(length) - F.size("_items"))
    return seqs.select(*g, F.lit(0).alias("chunk"), F.concat(pad, F.col("_items")).alias("items"))


def adjacent_pairs(rows: DataFrame, recent: DataFrame | None = None, group_cols: Sequence[str] = GROUP,
                   item_col: str = "item", order: Sequence[str] = ORDER) -> DataFrame:
    """``(group..., src, dst)``: each row's item with the item right before it in its group, the
    first one's predecessor being the newest of ``recent``, whose rows are all older.

    A group is never sorted in one task: neighbours are found inside minutes, and between
    minutes from the first and last item of each, one row a minute.
    """
    g = list(group_cols)
    x = rows.select(*g, item_col, *order).withColumn("_minute", minute(F.col(order[0])))
    inside = x.select(*g, F.lag(item_col).over(Window.partitionBy(*g, "_minute").orderBy(*order)).alias("src"),
                      F.col(item_col).alias("dst"))
    at = F.struct(*order)
    ends = x.groupBy(*g, "_minute").agg(F.min_by(item_col, at).alias("_first"), F.max_by(item_col, at).alias("_last"))
    if recent is not None:
        # a null minute sorts first; it has no item that could follow another
        before = last_n(recent, 1, group_cols, item_col, order).select(
            *g, F.lit(None).cast("bigint").alias("_minute"), F.lit(None).cast("int").alias("_first"),
            F.col(item_col).alias("_last"))
        # users without a row in this batch have nothing to continue
        ends = ends.unionByName(before.join(x.select(*[F.col(c).alias(f"_{c}") for c in g]).distinct(),
                                            [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in g], "left_semi"))
    across = ends.select(*g, F.lag("_last").over(Window.partitionBy(*g).orderBy("_minute")).alias("src"),
                         F.col("_first").alias("dst"))
    return inside.unionByName(across).where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def carry(state: dict[str, DataFrame] | None, rows: DataFrame,
          n: int = config.MAX_SEQUENCE_LENGTH) -> dict[str, DataFrame]:
    """The state after a batch of encoded rows ``(email, activity_type, item, activity_dt, session_id,
    activity)``, none of them older than the batches before: ``items``, ``pairs`` and ``recent``,
    each written once (three concurrent jobs)."""
    kept = state or {}
    items = rows.groupBy("activity_type", "item").agg(F.count(F.lit(1)).alias("item_count"))
    pairs = (adjacent_pairs(rows, kept.get("recent")).groupBy("activity_type", "src", "dst")
             .agg(F.count(F.lit(1)).alias("pair_count")))
    items, pairs, recent = materialize_many(
        add_counts(kept.get("items"), items, "item_count"), add_counts(kept.get("pairs"), pairs, "pair_count"),
        merge_last_n(kept.get("recent"), rows, n))
    return {"items": items, "pairs": pairs, "recent": recent}


def add_counts(kept: DataFrame | None, counts: DataFrame, col: str) -> DataFrame:
    """Two count tables of the same keys as one."""
    if kept is None:
        return counts
    keys = [c for c in counts.columns if c != col]
    return kept.select(counts.columns).unionByName(counts).groupBy(*keys).agg(F.sum(col).alias(col))


def model(state: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """M4's tables from a state."""
    return affinity.tables_of(state["items"], state["pairs"])


def state_of(served: dict[str, DataFrame], recent: DataFrame) -> dict[str, DataFrame]:
    """A state from M4's tables, which hold its counts, and the kept rows."""
    return {"items": served["items"].select("activity_type", "item", "item_count"),
            "pairs": served["transitions"].select("activity_type", "src", "dst", "pair_count"),
            "recent": recent}
