"""Joins whose hot keys are known by count before they run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 512     # a key with more than one part in so many of all rows is hot


def join_by_count(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one narrow row for each key and in ``count``
    how many of ``rows`` it meets (that column is left out of the result).

    Keys that meet more than one in ``PARTS`` of all matching rows are fewer than ``PARTS``, whatever the data hold:
    these alone are broadcast, and their rows stay where they are.  The others are shuffled, so
    no task gets more of one key than that share.  Both inputs are read twice and should be
    written tables; keys that are null meet nothing; an empty table gives an empty result.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = table.where(F.col(count) * PARTS > total).drop(count)
    rest = table.where(F.col(count) * PARTS <= total).drop(count)
    by_hot = rows.join(F.broadcast(hot), keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return by_hot.unionByName(others.join(rest, keys))
