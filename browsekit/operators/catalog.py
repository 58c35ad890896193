"""Keyed datasets over the catalogue and sales.

The reference serves these as pandas frames, sets and dicts built in one
process; here each is a DataFrame keyed by its id, for callers to join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import parse
from .inventory import sales_rows


def resolve_table(spark: SparkSession, suffix: str, database: str | None = None) -> str:
    """Name of the table in ``database`` whose name ends with ``suffix``
    (the greatest such name, so the choice is repeatable).  Catalog
    metadata only; no data passes through the driver."""
    names = sorted(t.name for t in spark.catalog.listTables(database)
                   if t.name.endswith(suffix))
    if not names:
        raise LookupError(f"no table ending in {suffix!r}")
    return names[-1] if database is None else f"{database}.{names[-1]}"


def active_styles(active: DataFrame) -> DataFrame:
    """Distinct integer variant ids whose flag is ``active``."""
    return (active.where(F.col("active_flag") == "active")
            .select(F.col("pvid").cast("int").alias("pvid")).distinct())


def product_catalog(variants: DataFrame) -> DataFrame:
    """Shoe variants keyed by ``id`` with cleaned name, group key,
    short description ('' when absent) and launch year."""
    return (variants.where(F.col("category") == "Shoes")
            .select("id",
                    F.replace(F.col("product_name"), F.lit("  "), F.lit(" ")).alias("product_name"),
                    "material", "color", parse.group_key().alias("product_group_code"),
                    "color_code", "edition_code", "product_style_code", "retail_usd",
                    "factory_region", "filter_color", "variant_primary_image", "group_code",
                    F.coalesce(F.get_json_object("group_creative", "$.shortDescription"),
                               F.lit("")).alias("short_desc"),
                    F.year("plan_date").alias("launch_year"),
                    F.col("id").alias("pvid")))


def loyal_shoppers(orders: DataFrame, variants: DataFrame, skus: DataFrame,
                   min_units: int = config.MIN_SHOE_UNITS) -> DataFrame:
    """A10: shoe purchase rows of buyers (lower-cased email) with more than
    ``min_units`` non-null shoe purchases.  The per-email count is a
    map-side-combined aggregate; rows are kept with a semi join."""
    shoes = (sales_rows(orders, variants, skus, lower_email=True)
             .where(F.col("category") == "Shoes")
             .select("email", "identifier", "product_variant_id", "category", "order_date"))
    loyal = (shoes.where(F.col("email").isNotNull()).groupBy("email")
             .agg(F.count("product_variant_id").alias("_n"))
             .where(F.col("_n") > min_units).select("email"))
    return shoes.join(loyal, "email", "left_semi")


def viewed_variants(views: DataFrame, variants: DataFrame, view_columns=(),
                    variant_columns=()) -> DataFrame:
    """Page views joined to the variant their URL names.

    Style = first 7 characters of the ``pid=`` token, group = its characters
    9-18, colour = digits after ``color/``; a missing part is NULL (not '')
    so it never joins.  ``view_columns`` and ``variant_columns`` are carried along.
    """
    token = parse.regex_group_or_null("query_string", r"pid=([0-9_]+).*")
    v = views.select("user_uuid", "timestamp", "query_string",
                     F.substring(token, 1, 7).alias("style"),
                     parse.regex_group_or_null("query_string", r"pid=([0-9]+).*").alias("pv2"),
                     F.substring(token, 9, 10).alias("grp"),
                     parse.regex_group_or_null("url", r"color/([0-9]+)").alias("color_code"),
                     *view_columns)
    pv = variants.select(F.col("id").alias("product_variant_id"),
                         F.col("product_style_code").alias("_s"), F.col("group_code").alias("_g"),
                         F.col("color_code").alias("_c"), *variant_columns)
    j = v.join(pv, (v.style == pv._s) & (v.grp == pv._g) & (v.color_code == pv._c))
    return j.select("product_variant_id", F.col("style").alias("product_style_code"), "pv2",
                    F.col("grp").alias("group_code"), v["color_code"], "query_string",
                    "user_uuid", "timestamp", *view_columns, *variant_columns)
