"""Run outputs.

The reference writes to database tables and posts one HTTP request per
user; here every output is a DataFrame written by a Spark writer, and
delivery is a separate consumer of the outbox table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import RunWindow
from ..functions import parse
from ..session import materialize
from .ranking import rank_by_range


def prediction_log(pid_preds: DataFrame, cat_preds: DataFrame, win: RunWindow,
                   pred: Column | None = None) -> DataFrame:
    """A11 + S7: one row per user: JSON lists of product and category
    predictions (``{activity, pred}``) and of known colour lists
    (``{activity, color_code}``), sorted by activity; empty lists are ``[]``.

    Real JSON via ``to_json`` (the reference swaps quotes in ``str(x)``,
    which breaks on apostrophes and NaN).
    """
    p = pred if pred is not None else F.col("pred")
    rows = (pid_preds.select("email", "activity", p.alias("pred"), "color_code",
                             F.lit("pid").alias("activity_type"))
            .unionByName(cat_preds.select("email", "activity", p.alias("pred"),
                                          F.lit(None).cast("array<string>").alias("color_code"),
                                          F.lit("cgid").alias("activity_type"))))
    is_pid = F.col("activity_type") == "pid"
    pair = F.struct("activity", "pred")

    def js(c: Column) -> Column:
        return F.to_json(F.array_sort(F.collect_list(c)))

    return (rows.groupBy("email")
            .agg(js(F.when(is_pid, pair)).alias("product_pred"),
                 js(F.when(~is_pid, pair)).alias("category_pred"),
                 js(F.when(is_pid & F.col("color_code").isNotNull(),
                           F.struct("activity", "color_code"))).alias("color_codes"))
            .withColumn("timestamp", F.lit(win.run_text).cast("timestamp")))


def run_log_row(spark, win: RunWindow, feature: str = config.FEATURE_NAME) -> DataFrame:
    """The run-state row ``(timestamp, feature)``."""
    return spark.range(1).select(F.lit(win.run_text).cast("timestamp").alias("timestamp"),
                                 F.lit(feature).alias("feature"))


def last_run(run_log: DataFrame, feature: str = config.FEATURE_NAME) -> DataFrame:
    """S8 read side: newest run time of a feature."""
    return (run_log.where(F.col("feature") == feature)
            .agg(F.max("timestamp").alias("last_run")))


def rollout_gate(df: DataFrame, bits: int = 224,
                 share: float = config.DEPLOYMENT_THRESHOLD) -> DataFrame:
    """L4: users whose ``sha(email)`` as a number is at most ``share`` of the hash space."""
    return df.where(parse.in_rollout("email", bits, share))


CAP_BUCKETS = 1 << 12   # score buckets of the histogram that finds the cut


def _send_order(df: DataFrame) -> list[Column]:
    """Best score first.  A user can have several rows of one score (variants of a colour), so the
    order goes on through activity, SKU and variant: the cut is the same on every run."""
    more = [F.asc_nulls_first(c) for c in ("activity", "upc", "product_variant_id") if c in df.columns]
    return [F.desc_nulls_last("pred"), F.asc("email"), *more]


def _score_bucket() -> Column:
    """0 for the best scores to CAP_BUCKETS for the worst and for none; never decreases along the send order."""
    share = F.least(F.greatest(F.col("pred").cast("double"), F.lit(0.0)), F.lit(1.0))
    return F.coalesce(F.lit(CAP_BUCKETS - 1) - F.floor(share * (CAP_BUCKETS - 1)), F.lit(CAP_BUCKETS)).cast("int")


def send_cap(df: DataFrame, n: int | None = None) -> DataFrame:
    """The first ``n`` rows, best score first (all rows when ``n`` is None).

    A histogram over score buckets (at most ``CAP_BUCKETS + 1`` rows) finds the bucket in which
    the cut lies; better buckets go in whole and only that one is ranked, by ranges, so no
    task holds all rows whatever ``n`` is.
    """
    if n is None:
        return df
    x = df.withColumn("_bucket", _score_bucket())
    before, cut = 0, -1
    for r in sorted(x.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()):
        cut = r["_bucket"]
        if before + r["n"] > n:
            break
        before, cut = before + r["n"], cut + 1
    whole = x.where(F.col("_bucket") < cut)
    last = rank_by_range(x.where(F.col("_bucket") == cut), _send_order(df)).where(F.col("_rank") <= int(n) - before)
    return whole.drop("_bucket").unionByName(last.drop("_bucket", "_rank"))


def send_until(df: DataFrame, n: int, deliver: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """L5 over successes: hand rows to ``deliver``, best first, until ``n`` of them have
    succeeded or none are left; a failed one is replaced by the next best.

    ``deliver`` gets the next rows (with ``_rank``) and returns ``(_rank, ok)`` for them; what it
    returns is written once, so nothing is delivered twice.  Returns every row handed over, with
    ``ok``.  Rounds go on from a cursor over the ranks, each as long as what is still missing.
    """
    ranked = materialize(rank_by_range(df, _send_order(df)))
    total, cursor, done, parts = ranked.count(), 0, 0, []
    while done < n and cursor < total:
        until = cursor + n - done
        told = materialize(deliver(ranked.where((F.col("_rank") > cursor) & (F.col("_rank") <= until))).select("_rank", "ok"))
        parts.append(told)
        done += told.where("ok").count()
        cursor = until
    if not parts:
        return ranked.limit(0).withColumn("ok", F.lit(False)).drop("_rank")
    told = reduce(DataFrame.unionByName, parts)
    return ranked.join(told, "_rank").drop("_rank")


def payload(best: DataFrame, event_name: str = config.EVENT_NAME) -> DataFrame:
    """P22 + S10: the outbox row per chosen user: product card when a
    product won, the category name when a raw category won."""
    is_pid = F.col("activity_type") == "pid"
    product = F.struct(
        F.col("activity").alias("product_group_id"),
        F.col("product_name").alias("name"),
        F.col("product_variant_id").cast("string").alias("product_variant_id"),
        F.col("sksz_color_code").alias("color_code"),
        F.col("variant_primary_image").alias("image_url"),
        F.concat(F.lit("/"), F.col("activity"), F.lit(".html#!/color/"),
                 F.col("sksz_color_code")).alias("url"),
        F.col("factory_region").alias("manufacturer_region"),
        # whole dollars, half to even as Python's format(x, '.0f')
        F.format_string("%.0f", F.bround(F.col("retail_usd"), 0)).alias("price"))
    return best.select(
        "email", F.lit(event_name).alias("event_name"),
        F.when(is_pid, F.array(product)).alias("products"),
        F.when(F.col("activity_type") == "cgid", F.col("activity")).alias("category"),
        "pred")


def delivery_rows(sent: DataFrame, win: RunWindow) -> DataFrame:
    """Delivery-log rows ``(email, timestamp)`` of a run's outbox."""
    return sent.select("email", F.lit(win.run_text).cast("timestamp").alias("timestamp")).distinct()


def sent_flags(score_log: DataFrame, delivered: DataFrame) -> DataFrame:
    """``send_flag`` derived from a delivery log ``(email, timestamp)``
    by a left join, instead of updating rows in place."""
    d = delivered.select("email", "timestamp").distinct().withColumn("_sent", F.lit(True))
    return (score_log.join(d, ["email", "timestamp"], "left")
            .withColumn("send_flag", F.coalesce("_sent", "send_flag", F.lit(False)))
            .drop("_sent"))
