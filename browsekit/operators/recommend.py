"""From scored activities to one product per user (A7, P15, J12, J13, J14, W2, U1 -> T6).

Product predictions get the user's viewed colours; category predictions
for a few landing pages are mapped to a stand-in product; both go through
the stock check (T5); raw category rows bypass it and compete in the
final best-row-per-user pick (W2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import parse
from . import inventory


def color_lists(pid_rows: DataFrame) -> DataFrame:
    """A7 + P18: per (email, activity) the sorted set of nonblank colours.

    The filter keeps NULL colours (only '' goes) and ``collect_set`` then
    skips them, so an all-NULL group gives an empty list, not NULL.
    """
    return (pid_rows.where(~F.col("color_code").eqNullSafe(""))
            .groupBy("email", "activity")
            .agg(F.array_sort(F.collect_set("color_code")).alias("color_code")))


def product_predictions(pid_scores: DataFrame, pid_rows: DataFrame) -> DataFrame:
    """Product scores with the colour lists (NULL when none)."""
    return (pid_scores.select("email", "activity", "pred")
            .join(color_lists(pid_rows), ["email", "activity"], "left")
            .withColumn("activity_type", F.lit("pid")))


def category_predictions(cat_scores: DataFrame,
                         categories=config.CATEGORIES_TO_SEND) -> DataFrame:
    """Category scores for the allowed landing pages; no colour list."""
    return (cat_scores.where(F.col("activity").isin(*categories))
            .select("email", "activity", "pred",
                    F.lit(None).cast("array<string>").alias("color_code"),
                    F.lit("cgid").alias("activity_type")))


def category_to_product(cat_preds: DataFrame, category_map: DataFrame) -> DataFrame:
    """A category row becomes a row for its stand-in product
    (activity := pid, colour list := NULL, type := ``pid``)."""
    m = category_map.select(F.col("category").alias("_cat"), F.col("pid").alias("_pid"))
    return (cat_preds.join(m, cat_preds.activity == m._cat)
            .select("email", F.col("_pid").alias("activity"), "pred",
                    F.lit(None).cast("array<string>").alias("color_code"),
                    F.lit("pid").alias("activity_type")))


def best_per_user(df: DataFrame, user: str = "email", score: str = "pred") -> DataFrame:
    """The highest-scoring row per user; NaN and NULL scores last; ties
    by activity, then sku, ascending.  ``row_number() == 1`` becomes a
    ``WindowGroupLimit``, so each task keeps one row per user before the
    shuffle."""
    s = F.nanvl(F.col(score), F.lit(None).cast("double"))
    # rows equal on (score, activity, sku) differ only where J6 fanned out;
    # ordering on those columns too keeps the pick the same on recompute
    extra = [F.asc_nulls_first(c) for c in ("dept", "identifier") if c in df.columns]
    w = Window.partitionBy(user).orderBy(F.desc_nulls_last(s), F.asc("activity"),
                                         F.asc_nulls_first("upc"), *extra)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


VARIANT_FIELDS = ("variant_primary_image", "product_id", "product_name", "color", "material",
                  "pv_color_code", "group_code", "product_style_code", "product_variant_id",
                  "retail_usd", "factory_region")


def variant_fields(variants: DataFrame, wanted: DataFrame) -> DataFrame:
    """Variant fields of the wanted product activities (J16 semi join)."""
    v = variants.select(
        "variant_primary_image", "product_id", "product_name", "color", "material",
        F.col("color_code").alias("pv_color_code"), "group_code", "product_style_code",
        F.col("id").alias("product_variant_id"), "retail_usd", "factory_region",
        parse.group_key().alias("activity"))
    keys = wanted.where(F.col("activity_type") == "pid").select("activity").distinct()
    return v.join(keys, "activity", "left_semi")


def with_variant_fields(best: DataFrame, variants: DataFrame) -> DataFrame:
    """Left join on (activity, colour); several variants of one colour
    give several rows, as in the reference."""
    vf = variant_fields(variants, best)
    return best.join(vf, (best.activity == vf.activity)
                     & (best.sksz_color_code == vf.pv_color_code), "left").drop(vf.activity)


def recommend(pid_scores: DataFrame, cat_scores: DataFrame, pid_rows: DataFrame,
              tables, stocked: DataFrame) -> DataFrame:
    """Best in-stock product (or allowed category) per user, with its
    variant fields."""
    pid_preds = product_predictions(pid_scores, pid_rows)
    cat_preds = category_predictions(cat_scores)
    mapped = category_to_product(cat_preds, tables.category_map())
    variants = tables.variants()
    checked = inventory.check_inventory(pid_preds.unionByName(mapped), variants, tables.skus(),
                                        tables.active_products(), tables.orders_fact(), stocked)
    out = checked.unionByName(cat_preds, allowMissingColumns=True)
    return with_variant_fields(best_per_user(out), variants)
