import pytest


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Small tables: few shuffle partitions keep the many small jobs short."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
