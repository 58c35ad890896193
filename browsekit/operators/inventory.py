"""Stock and size checks (S3-S5, S12, A8, A9, J3, J4, J6-J11, J18, P10, P11, P16, P17 -> T5).

Inventory arrives as documents of bounded size (an event log whose newest
``publish`` holds JSON arrays of ``{sku, qty}``, or reply maps ``sku -> {stock_level}``);
both become an ``(sku, qty)`` DataFrame by ``from_json`` + ``explode``, so
membership tests are semi/left joins, never driver-side sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .. import config
from ..functions import parse
from ..session import materialize_many

EVENT_SCHEMA = T.ArrayType(T.StructType([T.StructField("sku", T.StringType()),
                                         T.StructField("qty", T.LongType())]))
REPLY_SCHEMA = T.MapType(T.StringType(), T.StructType([T.StructField("stock_level", T.LongType())]))


# -- S3 / S4 / S5: inventory sources -------------------------------------------------
def latest_event(events: DataFrame, type_: str = config.INVENTORY_EVENT_TYPE) -> DataFrame:
    """S3: the rows of the newest publish of ``type_`` by id (PostgreSQL ``desc``: NULL id
    first).  A publish is one row or many of bounded size.

    The newest id is found first, from the id and type columns alone, and then filters the
    scan as a literal: the documents of earlier publishes are never read.
    """
    typed = events.where(F.col("type") == type_)
    newest = typed.agg(F.max(F.col("id").isNull()).alias("none"), F.max("id").alias("id")).first()
    if newest["none"] is None or newest["none"]:
        return typed.where(F.col("id").isNull())
    return typed.where(F.col("id") == F.lit(newest["id"]))


def inventory_from_events(events: DataFrame, upper_limit: float | None = None,
                          type_: str = config.INVENTORY_EVENT_TYPE) -> DataFrame:
    """``(sku, qty)`` from the newest publish.

    Entries are read in order of ``part`` (if the events have one) and place in the
    array; a missing qty counts 0; an entry with ``0 < qty <= upper_limit`` sets the sku,
    so a later valid duplicate overrides an earlier one while a later zero leaves it in
    place.  Each document is parsed in the task that holds it; one that is no JSON array
    of entries fails the query rather than emptying the stock.
    """
    doc = latest_event(events, type_)
    part = F.col("part") if "part" in events.columns else F.lit(0)
    e = doc.select(part.alias("part"), F.posexplode(
        F.from_json("event", EVENT_SCHEMA, {"mode": "FAILFAST"})).alias("pos", "e"))
    qty = F.coalesce(F.col("e.qty"), F.lit(0))
    keep = qty > 0
    if upper_limit is not None:
        keep = keep & (qty <= F.lit(upper_limit))
    return (e.where(keep).select(F.col("e.sku").alias("sku"), qty.alias("qty"), "part", "pos")
            .groupBy("sku").agg(F.max_by("qty", F.struct("part", "pos")).alias("qty")))


def inventory_from_reply(reply: DataFrame, minimum: int = config.INVENTORY_MIN) -> DataFrame:
    """Skus of a reply map whose ``stock_level >= minimum`` (re-aimed HTTP call).

    A broken reply gives no rows and spoils none of the others; ``broken_replies`` names it.
    """
    m = reply.select(F.explode(F.from_json("reply", REPLY_SCHEMA)).alias("sku", "v"))
    return m.where(F.col("v.stock_level") >= minimum).select(
        "sku", F.col("v.stock_level").alias("qty"))


def broken_replies(reply: DataFrame) -> DataFrame:
    """The replies that are no JSON map of stock levels (a null reply included), all columns."""
    return reply.where(F.from_json("reply", REPLY_SCHEMA).isNull())


def read_replies(reply: DataFrame, quarantine: str, minimum: int = config.INVENTORY_MIN) -> tuple[DataFrame, int]:
    """S5 as a job step: the stock of the readable replies, and how many were broken; those are
    written to the folder ``quarantine`` (replaced by each call) instead of vanishing."""
    broken_replies(reply).write.mode("overwrite").parquet(quarantine)
    return inventory_from_reply(reply, minimum), reply.sparkSession.read.parquet(quarantine).count()


def in_stock(inventory: DataFrame, minimum: int = config.INVENTORY_MIN) -> DataFrame:
    """P17 key set: skus with ``qty >= minimum`` (an absent sku counts 0)."""
    return inventory.where(F.col("qty") >= minimum).select("sku").distinct()


# -- catalogue ------------------------------------------------------------------
def variant_skus(skus: DataFrame) -> DataFrame:
    """``(identifier, product_variant_id, upc)``."""
    return skus.select("identifier", "product_variant_id", "upc")


def shoe_departments(variants: DataFrame) -> DataFrame:
    """``(activity, dept)`` for categories ending in ``Shoes``."""
    return (variants.where(F.col("category").endswith("Shoes"))
            .select("group_code", "product_style_code",
                    parse.group_key().alias("activity"), F.col("category").alias("dept"))
            .distinct().select("activity", "dept"))


def sku_sizes(variants: DataFrame, skus: DataFrame, active: DataFrame) -> DataFrame:
    """J4 + P11: variant x SKU x active-product rows with an undamaged SKU:
    ``(activity, sksz_color_code, pvid, identifier, upc, active_flag)``."""
    v = variants.select("id", parse.group_key().alias("activity"),
                        F.col("color_code").alias("sksz_color_code"))
    s = skus.where(F.col("damage_level_id") == 1).select(
        "product_variant_id", "identifier", "upc")
    a = active.select(F.col("upc").alias("_aupc"), "active_flag")
    return (v.join(s, v.id == s.product_variant_id)
            .join(a, F.col("upc") == F.col("_aupc"))
            .select("activity", "sksz_color_code", F.col("id").alias("pvid"),
                    "identifier", "upc", "active_flag"))


def sales_rows(orders: DataFrame, variants: DataFrame, skus: DataFrame,
               lower_email: bool = False) -> DataFrame:
    """Orders x SKU (on upc) x variant -> ``(email, identifier,
    product_variant_id, category, order_date, sku)``."""
    s = skus.select("upc", "identifier", "product_variant_id")
    v = variants.select(F.col("id").alias("_vid"), "category")
    email = F.lower("billing_email") if lower_email else F.col("billing_email")
    return (orders.join(s, orders.sales_order_sku == s.upc)
            .join(v, F.col("product_variant_id") == F.col("_vid"))
            .select(email.alias("email"), "identifier", "product_variant_id", "category",
                    "order_date", F.col("upc").alias("sku")))


def latest_sizes(orders: DataFrame, variants: DataFrame, skus: DataFrame,
                 emails: DataFrame | None = None, lower_email: bool = False) -> DataFrame:
    """Per (email, category), the size of the newest order
    (``DISTINCT ON ... ORDER BY order_date DESC``: NULL dates first; ties
    broken by the greatest sku).  ``emails`` restricts the buyers (J16).

    ``row_number() == 1`` is written literally so Spark plans a
    ``WindowGroupLimit``: each task keeps one row per key before the
    shuffle, so even a buyer with a third of all orders ships one row per
    task and category.
    """
    if emails is not None:
        # restrict the orders to the wanted buyers before the star join, so
        # only their lines meet the SKU and variant tables
        key = F.lower("billing_email") if lower_email else F.col("billing_email")
        wanted = emails.select(F.col("email").alias("_we")).distinct()
        orders = orders.join(wanted, key == wanted._we, "left_semi")
    s = sales_rows(orders, variants, skus, lower_email)
    w = Window.partitionBy("email", "category").orderBy(F.desc_nulls_first("order_date"),
                                                        F.desc("sku"))
    return (s.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select("email", F.col("category").alias("dept"), "identifier"))


def user_sizes(preds: DataFrame, variants: DataFrame, latest: DataFrame,
               null_safe: bool = False) -> DataFrame:
    """J6 + J7: attach the shoe department of each activity (fans out when an
    activity has two) and the user's latest size in it (NULL when none).

    SQL equality by default: a NULL department matches nothing.
    ``null_safe=True`` matches NULL to NULL, as a pandas merge does."""
    with_dept = preds.join(shoe_departments(variants), "activity", "left")
    if not null_safe:
        return with_dept.join(latest, ["email", "dept"], "left")
    l = latest.select(F.col("email").alias("_le"), F.col("dept").alias("_ld"), "identifier")
    cond = (with_dept.email == l._le) & with_dept.dept.eqNullSafe(l._ld)
    return with_dept.join(l, cond, "left").drop("_le", "_ld")


# -- predicates -------------------------------------------------------------------
def color_ok(color_list: str = "color_code", sku_color: str = "sksz_color_code",
             flag: str = "active_flag"):
    """No colour list and an active SKU, or the SKU colour in the list;
    anything else (NULL included) is false."""
    cl = F.col(color_list)
    return F.coalesce((cl.isNull() & (F.col(flag) == "active"))
                      | F.array_contains(cl, F.col(sku_color)), F.lit(False))


def with_stock_flag(rows: DataFrame, stocked: DataFrame) -> DataFrame:
    """``has_inventory`` 1/0 by a left join to the distinct in-stock skus."""
    s = stocked.select(F.col("sku").alias("_sku")).distinct()
    return (rows.join(s, rows.upc == s._sku, "left")
            .withColumn("has_inventory", F.col("_sku").isNotNull().cast("int")).drop("_sku"))


def color_stock_share(prods: DataFrame, stocked: DataFrame,
                      threshold: float = config.SIZE_THRESHOLD,
                      distinct_skus: bool = False) -> DataFrame:
    """Per (activity, colour) the share of SKU rows in stock; keep shares
    at or above ``threshold``.  Counts rows as the reference does, so a SKU
    wanted twice counts twice; ``distinct_skus`` counts each SKU once."""
    p = prods.select("activity", "sksz_color_code", "upc")
    if distinct_skus:
        p = p.distinct()
    flagged = with_stock_flag(p, stocked)
    agg = flagged.groupBy("activity", "sksz_color_code").agg(
        F.count("upc").alias("sku"), F.sum("has_inventory").alias("has_inventory"))
    return (agg.withColumn("frac_of_color", F.col("has_inventory") / F.col("sku"))
            .where(F.col("frac_of_color") >= threshold))


# -- T5 ----------------------------------------------------------------------------
def check_inventory(preds: DataFrame, variants: DataFrame, skus: DataFrame,
                    active: DataFrame, orders: DataFrame, stocked: DataFrame,
                    threshold: float = config.SIZE_THRESHOLD) -> DataFrame:
    """T5: prediction rows that can be sent.

    ``preds``: ``(email, activity, pred, activity_type, color_code array)``.
    Buyers (a known size in the department) need that size in stock and a
    colour that passes P16; leads need P16 and a colour whose SKU rows are
    at least ``threshold`` in stock (J8 + A9 + J11).  Lead rows stay one
    per SKU.  Returns the prediction columns plus the SKU columns.

    The sized predictions, their SKU rows and the in-stock SKU set are each
    used more than once; they are written once to the checkpoint folder
    (stage boundary), as concurrent jobs since none needs another.
    """
    pid, sizes, stocked = materialize_many(
        user_sizes(preds, variants, latest_sizes(orders, variants, skus,
                                                 emails=preds.select("email"))),
        sku_sizes(variants, skus, active).join(preds.select("activity").distinct(),
                                               "activity", "left_semi"),
        stocked.select("sku").distinct())
    wanted = pid.select("activity", F.col("identifier").alias("_want")).distinct()
    prods = (wanted.join(sizes, "activity")
             .where(F.col("_want").isNull() | (F.col("_want") == F.col("identifier"))))
    share = color_stock_share(prods, stocked, threshold).select("activity", "sksz_color_code")

    # catalogue-sized filters first, users after: only SKUs that can be sent meet them
    ready = sizes.join(stocked.select(F.col("sku").alias("upc")).distinct(), "upc", "left_semi")
    buyers = (pid.where(F.col("identifier").isNotNull())
              .join(ready, ["activity", "identifier"]).where(color_ok()))
    leads = (pid.where(F.col("identifier").isNull()).drop("identifier")
             .join(sizes.join(share, ["activity", "sksz_color_code"], "left_semi"), "activity")
             .where(color_ok()))
    return buyers.unionByName(leads, allowMissingColumns=True)
