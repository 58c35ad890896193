"""Exact ranks inside groups without putting a whole group into one task.

A plain ``row_number().over(partitionBy(g).orderBy(o))`` sends every row of
a group to one task; one user with a third of all clicks would make that
task a third of the job.  ``rank_in_group`` instead needs a *bucket*
column that is monotone in the order (a time bucket, a hash prefix):

1. count rows per (group, bucket) -- a map-side-combined aggregate whose
   output per group is at most the number of buckets;
2. a running sum over those counts per group gives each bucket's offset;
3. ``row_number`` inside (group, bucket) -- small partitions -- plus the
   offset is the exact rank inside the group.

The same machinery gives exact hash-ordered samples (``hash_sample``) with
a 16-bit hash prefix as the bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BUCKET_HEX = 4   # 65,536 buckets


def rank_in_group(df: DataFrame, group_cols: Sequence[str], bucket: Column,
                  order: Sequence[Column], rank_col: str = "_rank",
                  total_col: str = "_total") -> DataFrame:
    """Add a 1-based rank of each row inside its group (by ``order``), and the
    group's row count.  ``bucket`` must be non-decreasing along ``order``."""
    g = list(group_cols)
    x = df.withColumn("_bucket", bucket)
    counts = x.groupBy(*g, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w_run = (Window.partitionBy(*g).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        *g, "_bucket",
        F.coalesce(F.sum("_n").over(w_run), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*g)).alias(total_col))
    ranked = x.withColumn("_in_bucket",
                          F.row_number().over(Window.partitionBy(*g, "_bucket").orderBy(*order)))
    # null-safe: a row with a null group column or bucket belongs to that group
    keys = [*g, "_bucket"]
    right = counts.select(*(F.col(c).alias(f"_r_{i}") for i, c in enumerate(keys)), "_before", total_col)
    same = [ranked[c].eqNullSafe(right[f"_r_{i}"]) for i, c in enumerate(keys)]
    return (ranked.join(right, same)
            .withColumn(rank_col, F.col("_before") + F.col("_in_bucket"))
            .drop("_bucket", "_before", "_in_bucket", *(f"_r_{i}" for i in range(len(keys)))))


def rank_by_range(df: DataFrame, order: Sequence[Column], rank_col: str = "_rank") -> DataFrame:
    """Add the 1-based rank of each row by ``order``: ranges of the order are sorted side by side
    and numbered on from the ranges before, so no task sees all rows."""
    from ..session import materialize
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_part", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id()))
    w_run = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)   # one row a range
    offsets = (rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(w_run), F.lit(0)).alias("_before")))
    local = F.col("_mono") - F.shiftleft(F.col("_part").cast("long"), 33)
    return (rows.join(F.broadcast(offsets), "_part")
            .withColumn(rank_col, F.col("_before") + local + 1).drop("_part", "_mono", "_before"))


def sample_hash(seed: str, key: Column) -> Column:
    """Sampling order: ``md5(seed || key)`` ascending, then the key."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def hash_sample(df: DataFrame, key: str, seed: str, take: Callable[[Column], Column],
                group_cols: Sequence[str] = ()) -> DataFrame:
    """Keep, per group, the first ``take(n)`` rows in hash order (n = group size).

    Exact and repeatable (the same rows on every run and on recompute after
    an executor loss), unlike ``rand``; ``take`` sees the group size as a
    Column, e.g. ``lambda n: F.bround(F.lit(0.45) * n)``.
    """
    h = sample_hash(seed, F.col(key))
    x = df.withColumn("_h", h)
    bucket = F.conv(F.substring("_h", 1, HASH_BUCKET_HEX), 16, 10).cast("int")
    ranked = rank_in_group(x, group_cols, bucket, [F.col("_h"), F.col(key)])
    return ranked.where(F.col("_rank") <= take(F.col("_total"))).drop("_h", "_rank", "_total")


def dense_index(df: DataFrame, col: str, index_col: str = "idx",
                partitions: int | None = None) -> DataFrame:
    """Sorted distinct values of ``col`` numbered 0..n-1 (a fitted label
    encoder), without a single-partition window.

    Distinct values are range-partitioned and sorted inside each partition;
    ``monotonically_increasing_id`` then gives the position inside a
    partition, and a running sum over the per-partition counts (one row per
    partition) gives each partition's offset.  The numbered values are
    written once to the shared checkpoint folder before the two uses, so
    both see the same range boundaries, also after a lost executor; a
    fitted vocabulary is a model artefact and is kept anyway.
    """
    from ..session import materialize
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    if partitions:
        values = values.repartitionByRange(partitions, col)
    else:
        values = values.repartitionByRange(col)
    values = materialize(values.sortWithinPartitions(col)
                         .withColumn("_part", F.spark_partition_id())
                         .withColumn("_mono", F.monotonically_increasing_id()))
    offsets = (values.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(
                   Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset")))
    local = F.col("_mono") - F.shiftleft(F.col("_part").cast("long"), 33)
    return (values.join(F.broadcast(offsets), "_part")
            .select(col, (F.col("_offset") + local).cast("int").alias(index_col)))
