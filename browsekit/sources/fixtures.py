"""Input tables of the browse jobs, derived from the driver's parquet tables.

The driver ships TPC-H-like tables plus an ``events`` stream; the jobs need
a product catalogue, SKUs, a click stream, an identity map, an orders fact,
inventory events and a score log.  ``FixtureTables`` derives each of them
with plain DataFrame expressions (FIXTURES.md gives the rules), so every
input grows with the driver tables and the same rows come out of the DuckDB
oracle views in ``oracle/views.py``.

``CatalogTables`` is the production twin: the same methods, backed by
catalog tables of the same schema.  Operators only ever see the interface.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..session import configure


SKUS_PER_DOCUMENT = 500     # entries of one stock document, at most
LATE_PART = 1_000_000_000   # parts from here on follow all others


def _lp(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def derive_page_views(ev: DataFrame) -> DataFrame:
    """Click-stream rows from raw ``events`` rows (batch or streaming): one
    row per event, FIXTURES.md rules; only per-row expressions, so the same
    derivation serves ``readStream``."""
    k = F.get_json_object("props", "$.k").cast("int")
    u = F.col("user_id").cast("string")
    et = F.col("event_type")
    # twenty neighbouring users share a range of a hundred product groups, so the
    # viewed part of the catalogue grows with the users
    act = F.concat(_lp(F.expr("g div 2"), 7), F.lit("_"), _lp(F.col("g") % 2 + 1, 2))
    ms_col = F.unix_millis(F.col("ts").cast("timestamp"))
    cats = F.element_at(F.array(*[F.lit(c) for c in
                                  ("moccasins", "pumps", "mens-sneakers", "boots")]),
                        F.col("k") % 4 + 1)
    return (ev.select("user_id", "event_type", ms_col.alias("timestamp"), k.alias("k"),
                      (k + 100 * F.expr("user_id div 20")).alias("g"))
            .select(
                F.concat(F.lit("u"), u).alias("user_uuid"),
                "timestamp",
                F.concat(F.lit("s"), u, F.lit("_"),
                         F.expr("timestamp div 86400000").cast("string")).alias("session_id"),
                F.when(et == "signup", "shop.example")
                 .when(et == "purchase", "other.example")
                 .otherwise("www.shop.example").alias("host"),
                F.when(et == "signup", F.concat(F.lit("cgid="), cats, F.lit("&sz=12")))
                 .when(et == "error", F.lit("src=home"))
                 .when(et == "click", F.concat(F.lit("pid="), act, F.lit("?q=1")))
                 .otherwise(F.concat(F.lit("pid="), act, F.lit("&src=mail")))
                 .alias("query_string"),
                F.concat(F.lit("https://www.shop.example/"), act, F.lit(".html"),
                         F.when(F.col("k") % 3 == 0, F.lit(""))
                          .otherwise(F.concat(F.lit("#!/color/"), _lp(F.col("k") % 2 + 1, 2),
                                              F.when(F.col("k") % 5 == 0, F.lit("x7y?z=1"))
                                               .otherwise(F.lit("/v")))))
                 .alias("url")))


class FixtureTables:
    """Derived views over ``/root/testdata/<sf>/*.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- catalogue ---------------------------------------------------------
    def variants(self) -> DataFrame:
        k = F.col("p_partkey")
        first_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
        return self.raw("part").select(
            k.alias("id"),
            _lp(F.expr("p_partkey div 4"), 7).alias("product_style_code"),
            _lp(F.expr("(p_partkey div 2) % 2 + 1"), 2).alias("group_code"),
            _lp(k % 2 + 1, 2).alias("color_code"),
            F.when(F.col("p_type").isin("STANDARD", "PROMO"), "Shoes")
             .when(F.col("p_type") == "SMALL", "Mens Shoes")
             .when(F.col("p_type") == "ECONOMY", "Womens Shoes")
             .when(F.col("p_type") == "MEDIUM", "Bags")
             .otherwise("Belts").alias("category"),
            F.when(k % 5 == 0, F.replace(F.col("p_name"), F.lit(" "), F.lit("  ")))
             .otherwise(F.col("p_name")).alias("product_name"),
            F.col("p_brand").alias("material"),
            first_word.alias("color"),
            first_word.alias("filter_color"),
            F.col("p_size").cast("string").alias("edition_code"),
            F.concat(F.lit("R"), (k % 3).cast("string")).alias("factory_region"),
            F.concat(F.lit("img/"), k.cast("string"), F.lit(".jpg")).alias("variant_primary_image"),
            F.expr("p_partkey div 2").alias("product_id"),
            F.col("p_retailprice").alias("retail_usd"),
            F.date_add(F.lit("2018-01-01").cast("date"), (k % 1500).cast("int")).alias("plan_date"),
            F.when(k % 3 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit('{"shortDescription":"'), F.col("p_name"), F.lit('"}')))
             .alias("group_creative"),
        )

    def skus(self) -> DataFrame:
        """Five sizes per variant: n = id*5 + s."""
        n = F.col("id") * 5 + F.col("s")
        return (self.raw("part")
                .select(F.col("p_partkey").alias("id"),
                        F.explode(F.sequence(F.lit(0), F.lit(4))).alias("s"))
                .select(F.col("id").alias("product_variant_id"),
                        _lp(n, 12).alias("upc"),
                        (F.col("s") + 35).cast("string").alias("identifier"),
                        F.when(n % 7 == 0, 2).otherwise(1).alias("damage_level_id")))

    def active_products(self) -> DataFrame:
        n = F.col("id") * 5 + F.col("s")
        return (self.raw("part")
                .select(F.col("p_partkey").alias("id"),
                        F.explode(F.sequence(F.lit(0), F.lit(4))).alias("s"))
                .where(n % 11 != 0)
                .select(_lp(n, 12).alias("upc"),
                        F.col("id").cast("string").alias("pvid"),
                        F.when(F.col("id") % 4 == 3, "inactive").otherwise("active")
                         .alias("active_flag")))

    def category_map(self) -> DataFrame:
        """Category landing page -> stand-in product (three fixed rows)."""
        return self.spark.createDataFrame(list(config.CATEGORY_PAGE_PRODUCTS),
                                          "category string, pid string")

    # -- people and clicks -------------------------------------------------
    def email_uuids(self) -> DataFrame:
        u = F.col("user_id")
        main = F.concat(F.lit("user"), F.when(u % 10 == 3, u - 1).otherwise(u).cast("string"),
                        F.lit("@example.com"))
        alias = F.concat(F.lit("alias"), u.cast("string"), F.lit("@example.com"))
        # one pass over the distinct users: the main row, plus an alias row
        # for every tenth user
        emails = F.when(u % 10 == 0, F.array(main, alias)).otherwise(F.array(main))
        return (self.raw("events").select("user_id").distinct()
                .select(F.concat(F.lit("u"), u.cast("string")).alias("uuid"),
                        F.explode(emails).alias("email")))

    def page_views(self, lo_ms: int | None = None, hi_ms: int | None = None,
                   strict_lo: bool = False) -> DataFrame:
        """Click stream; optional ``[lo_ms, hi_ms)`` bounds are also pushed
        to the scan on the native ``ts`` column (exact: ms = floor(us/1000))."""
        ev = self.raw("events")
        ts_ntz = F.col("ts")
        if lo_ms is not None:
            lo = F.timestamp_millis(F.lit(lo_ms + (1 if strict_lo else 0))).cast("timestamp_ntz")
            ev = ev.where(ts_ntz >= lo)
        if hi_ms is not None:
            ev = ev.where(ts_ntz < F.timestamp_millis(F.lit(hi_ms)).cast("timestamp_ntz"))
        return derive_page_views(ev)

    # -- orders ------------------------------------------------------------
    def orders_fact(self) -> DataFrame:
        """Every order line; customers divisible by 3 order as guests, under an
        address that no click identity carries."""
        o = self.raw("orders")
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
        ck = F.col("o_custkey")
        return (o.join(li, o.o_orderkey == li.l_orderkey)
                .select(F.concat(F.when(ck % 3 == 0, "guest").when(ck % 2 == 0, "User").otherwise("user"),
                                 ck.cast("string"), F.lit("@example.com")).alias("billing_email"),
                        F.col("o_orderkey").alias("order_id"),
                        F.col("o_orderdate").alias("order_date"),
                        _lp(F.col("l_partkey") * 5 + F.col("l_linenumber") % 5, 12)
                        .alias("sales_order_sku")))

    # -- inventory ---------------------------------------------------------
    def _sku_numbers(self) -> DataFrame:
        n = F.col("id") * 5 + F.col("s")
        return (self.raw("part")
                .select(F.col("p_partkey").alias("id"),
                        F.explode(F.sequence(F.lit(0), F.lit(4))).alias("s"))
                .select(n.alias("n")))

    def inventory_events(self) -> DataFrame:
        """Three publishes over all SKUs: older (id 1), newest (id 2), other type (id 3).

        A publish is many rows, each a bounded array of at most
        ``SKUS_PER_DOCUMENT`` entries; ``part`` is the row's place in it.  The
        newest has qty (n*7) % 5, then, in parts after all others, second
        entries of qty 9 for n % 50 = 0 and qty 0 for n % 50 = 1; entries with
        n % 97 = 0 carry no qty.
        """
        n = F.col("n")
        base = self._sku_numbers().select(n, _lp(n, 12).alias("sku"))
        part = F.expr(f"n div {SKUS_PER_DOCUMENT}")
        late = F.expr(f"{LATE_PART} + n div {25 * SKUS_PER_DOCUMENT}")
        none = F.lit(None).cast("bigint")

        def rows(df, id_, part_, qty):
            return df.select(F.lit(id_).cast("bigint").alias("id"), part_.cast("bigint").alias("part"),
                             "n", "sku", qty.cast("bigint").alias("qty"))

        entries = (rows(base, 2, part, F.when(n % 97 == 0, none).otherwise((n * 7) % 5))
                   .unionByName(rows(base.where((n % 50 == 0) | (n % 50 == 1)), 2, late,
                                     F.when(n % 97 == 0, none).when(n % 50 == 0, 9).otherwise(0)))
                   .unionByName(rows(base, 1, part, F.lit(1)))
                   .unionByName(rows(base, 3, part, F.lit(5))))
        entry = F.transform("e", lambda x: F.struct(x["sku"].alias("sku"), x["qty"].alias("qty")))
        return (entries.groupBy("id", "part")
                .agg(F.sort_array(F.collect_list(F.struct("n", "sku", "qty"))).alias("e"))
                .select("id", "part",
                        F.when(F.col("id") == 3, "inventory.audit")
                         .otherwise(config.INVENTORY_EVENT_TYPE).alias("type"),
                        F.to_json(entry).alias("event")))

    def inventory_reply(self) -> DataFrame:
        """Reply documents of bounded size over all SKUs: sku -> {"stock_level": (n*7) % 5}."""
        n = F.col("n")
        pair = F.struct(_lp(n, 12).alias("k"), F.struct(((n * 7) % 5).alias("stock_level")).alias("v"))
        return (self._sku_numbers()
                .groupBy(F.expr(f"n div {SKUS_PER_DOCUMENT}").alias("part"))
                .agg(F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("m"))
                .select(F.to_json("m").alias("reply")))

    # -- logs --------------------------------------------------------------
    def score_history(self) -> DataFrame:
        """Score log rows of earlier runs (from ``purchase`` events)."""
        k = F.get_json_object("props", "$.k").cast("int")
        return (self.raw("events").where(F.col("event_type") == "purchase")
                .select(F.concat(F.lit("user"), F.col("user_id").cast("string"),
                                 F.lit("@example.com")).alias("email"),
                        (F.col("value") / 500).alias("prob"),
                        F.col("ts").cast("timestamp").alias("timestamp"),
                        (k % 2 == 0).alias("send_flag")))

    def send_params(self) -> DataFrame:
        """Scaler and logistic weights of the send model (seven fixed rows)."""
        rows = [(f, m, s, w) for f, m, s, w in config.SEND_PARAMS]
        rows.append(("bias", 0.0, 1.0, config.SEND_BIAS))
        return self.spark.createDataFrame(
            rows, "feature string, mean double, scale double, weight double")


class CatalogTables(FixtureTables):
    """Production twin: the same inputs read from catalog tables."""

    def __init__(self, spark: SparkSession, names: dict[str, str]):
        self.spark = configure(spark)
        self.names = names

    def _t(self, key: str) -> DataFrame:
        return self.spark.table(self.names[key])

    def variants(self): return self._t("variants")
    def skus(self): return self._t("skus")
    def active_products(self): return self._t("active_products")
    def category_map(self): return self._t("category_map")
    def email_uuids(self): return self._t("email_uuids")
    def orders_fact(self): return self._t("orders_fact")
    def inventory_events(self): return self._t("inventory_events")
    def inventory_reply(self): return self._t("inventory_reply")
    def score_history(self): return self._t("score_log")
    def send_params(self): return self._t("send_params")

    def page_views(self, lo_ms=None, hi_ms=None, strict_lo=False):
        df = self._t("page_views")
        ts = F.col("timestamp")
        if lo_ms is not None:
            df = df.where(ts > lo_ms if strict_lo else ts >= lo_ms)
        if hi_ms is not None:
            df = df.where(ts < hi_ms)
        return df
