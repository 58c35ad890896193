"""Connected components of a link table, as joins and minima.

Each round every node takes the smallest label among itself and its neighbours,
then the label of its label (pointer jumping), so chains shorten by more than
half each round.  A hub with very many links is one key of a join that Spark's
skew split deals out and of a minimum that combines map-side.  The labels are
written to the shared checkpoint folder each round: lineage stays short, and
nothing but the number of changed rows reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node in a link; label is the smallest node of its component.

    Links with a null end or two equal ends are ignored; an empty table gives an empty result.
    """
    one_way = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    both = materialize(one_way.union(one_way.select("other", "node")).distinct())
    labels = materialize(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other")
        least = near.groupBy("node").agg(F.min("label").alias("near"))
        step = (labels.join(least, "node")
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = materialize(
            step.join(jump, "label", "left")
            .select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "old"))
        changed = moved.where("label <> old").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
