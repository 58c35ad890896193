"""What a join sends to the driver and a task holds is measured, not estimated from compressed files."""

import pytest
from pyspark.sql import functions as F

from browsekit.operators import factors, inventory
from browsekit.sources.fixtures import FixtureTables


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    """60,000 parts: a file far under a megabyte, whose SKU rows are well over ten."""
    d = str(tmp_path_factory.mktemp("catalogue"))
    (spark.range(60_000).coalesce(1)
     .select(F.col("id").alias("p_partkey"), F.lit("large ring").alias("p_name"), F.lit("Brand#7").alias("p_brand"),
             F.lit("PROMO").alias("p_type"), F.lit(1).alias("p_size"), F.lit(900.0).alias("p_retailprice"))
     .write.parquet(f"{d}/part.parquet"))
    return FixtureTables(spark, d)


def test_rows_that_explode_makes_are_not_broadcast_by_file_size(catalogue):
    skus = catalogue.skus().select("upc", "identifier")
    active = catalogue.active_products().select(F.col("upc").alias("_upc"), "active_flag")
    j = skus.join(active, F.col("upc") == F.col("_upc"))
    n = 5 * 60_000
    assert len(j.select("upc").toPandas()) == n - len(range(0, n, 11))
    j.write.format("noop").mode("overwrite").save()
    assert "BroadcastExchange" not in j._jdf.queryExecution().executedPlan().toString()
    flagged = inventory.with_stock_flag(skus, active.select(F.col("_upc").alias("sku")))
    assert flagged.where("has_inventory = 0").count() == len(range(0, n, 11))


def test_a_small_side_is_still_broadcast_once_measured(spark, catalogue):
    few = spark.range(50).select(F.lpad(F.col("id").cast("string"), 12, "0").alias("_upc"))
    j = catalogue.skus().join(few, F.col("upc") == F.col("_upc"))
    assert j.count() == 50
    j.write.format("noop").mode("overwrite").save()
    # the plan of the last run is kept by its own execution: ask one that has run
    j.collect()
    assert "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()


def test_tasks_read_bounded_parts_of_a_shuffle(spark):
    """About 48 MB that do not compress are read in several parts."""
    rows = spark.range(3_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
    read = rows.groupBy("a").agg(F.max("b").alias("b")).select(F.spark_partition_id().alias("p")).distinct().count()
    assert read >= 2


def test_a_shuffle_below_the_advisory_size_still_uses_the_cores(spark):
    """About 24 MB, two parts of the advisory size, are read by all four cores of the test session."""
    rows = spark.range(1_500_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
    read = rows.groupBy("a").agg(F.max("b").alias("b")).select(F.spark_partition_id().alias("p")).distinct().count()
    assert read >= 4


def test_ranks_by_factors_of_one_type_are_counted_in_many_tasks(spark, monkeypatch):
    for name, size in (("QUERY_BLOCK", 4), ("ITEM_BLOCK", 5), ("TILE", 1)):
        monkeypatch.setattr(factors, name, size)
    left = [[float(n % 5), 1.0] for n in range(60)]
    item = [[float(n % 3), float(n % 4)] for n in range(70)]
    queries = spark.createDataFrame([("pid", n, v, float(n % 7)) for n, v in enumerate(left)],
                                    "activity_type string, q bigint, left array<double>, score double")
    items = spark.createDataFrame([("pid", n, v) for n, v in enumerate(item)],
                                  "activity_type string, item int, factors array<float>")
    counted = factors.count_above(queries, items)
    assert counted.select(F.spark_partition_id()).distinct().count() > 50       # of 15 x 14 tiles
    got = {r.q: (r.gt, r.eq) for r in counted.groupBy("q").agg(F.sum("gt").alias("gt"), F.sum("eq").alias("eq")).collect()}
    for n, v in enumerate(left):
        scores = [v[0] * a + v[1] * b for a, b in item]
        assert got[n] == (sum(s > n % 7 for s in scores), sum(s == n % 7 for s in scores))
