"""Send-model features (A1, A2, A4, J5, P19, M2, M3 -> T1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import RunWindow
from ..functions import parse
from ..session import materialize
from .identity import attach_email, restrict_single_email


def window_filter(df: DataFrame, lo_ms: int | None, hi_ms: int | None,
                  col: str = "timestamp", strict_lo: bool = False) -> DataFrame:
    """Half-open ``[lo, hi)`` (or ``(lo, ...)``) on epoch ms."""
    c = F.col(col)
    if lo_ms is not None:
        df = df.where(c > F.lit(lo_ms) if strict_lo else c >= F.lit(lo_ms))
    if hi_ms is not None:
        df = df.where(c < F.lit(hi_ms))
    return df


def host_filter(df: DataFrame, hosts=config.HOSTS) -> DataFrame:
    """Host allow-list."""
    return df.where(F.col("host").isin(*hosts))


def browse_features(views: DataFrame, identity: DataFrame, win: RunWindow) -> DataFrame:
    """A1: per email, seconds since the last view, category and product view
    counts, distinct view timestamps; kept when the last view is recent.

    Plan: window + host filters reach the scan; clicks are joined to the
    single-email identity (J1+J2), reduced to one row per (email, ts) with
    the conditional counts (A2), then to one row per email.  Both
    aggregations combine map-side, so a hot email collapses before the
    final shuffle and the distinct count needs no per-email set.
    """
    clicks = host_filter(window_filter(views, win.send_lo, win.send_hi), win.hosts)
    clicks = clicks.select(
        "user_uuid", "timestamp",
        (parse.category_key() != "").alias("_is_cat"),
        (parse.product_key() != "").alias("_is_pdp"))
    joined = attach_email(clicks, restrict_single_email(identity))
    per_ts = (joined.groupBy("email", "timestamp")
              .agg(F.count_if(F.col("_is_cat")).alias("_cat"),
                   F.count_if(F.col("_is_pdp")).alias("_pdp")))
    per_user = (per_ts.groupBy("email")
                .agg(F.max("timestamp").alias("_last_ms"),
                     F.sum("_cat").alias("cgid_count"),
                     F.sum("_pdp").alias("pdp_count"),
                     F.count(F.lit(1)).alias("count")))
    return (per_user.where(F.col("_last_ms") >= F.lit(win.recency_lo))
            .select("email",
                    (F.lit(win.run_ms // 1000) - F.expr("_last_ms div 1000"))
                    .cast("double").alias("time_since_browse"),
                    "cgid_count", "pdp_count", "count"))


def order_history(orders: DataFrame, win: RunWindow, emails: DataFrame | None = None) -> DataFrame:
    """A4: per lower(email): distinct orders and whole days since the last.

    Distinct orders are counted in two steps ((email, order) then email) so
    a heavy buyer's rows spread over the first shuffle.  ``emails``, when
    given, keeps only those buyers before any shuffle (a semi join the
    planner can broadcast): the hourly run needs the history of the users
    it scores, not of every buyer in the fact table.
    """
    o = orders.select(F.lower("billing_email").alias("email"), "order_id",
                      F.col("order_date").cast("timestamp").alias("order_date"))
    if emails is not None:
        o = o.join(emails.select("email").distinct(), "email", "left_semi")
    per_order = o.groupBy("email", "order_id").agg(F.max("order_date").alias("_last"))
    return (per_order.groupBy("email")
            .agg(F.count("order_id").alias("lifetime_orders"),
                 F.max("_last").alias("_last"))
            .select("email", "lifetime_orders",
                    F.expr(f"timestampdiff(DAY, _last, TIMESTAMP '{win.run_text}')")
                    .alias("days_since_last_order")))


def with_order_history(features: DataFrame, history: DataFrame) -> DataFrame:
    """J5 + P19: left join on email, then the reference's null fills."""
    joined = features.join(history, "email", "left")
    return joined.select(
        *features.columns,
        F.coalesce(F.col("lifetime_orders").cast("double"),
                   F.lit(float(config.FILL_LIFETIME_ORDERS))).alias("lifetime_orders"),
        F.coalesce(F.col("days_since_last_order").cast("double"),
                   F.lit(float(config.FILL_DAYS_SINCE_LAST_ORDER))).alias("days_since_last_order"))


def _params(params: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Model parameters are a handful of rows (one per feature): read them
    once on the driver like any fitted model's coefficients."""
    rows = params.where(F.col("feature").isin("bias", *config.SEND_FEATURES)).limit(64).collect()
    return {r["feature"]: (r["mean"], r["scale"], r["weight"]) for r in rows}


def fit_scaler(features: DataFrame, names=config.SEND_FEATURES) -> DataFrame:
    """M2 fit: per feature, mean and population standard deviation (the
    scaler the reference loads is fitted this way), as ``(feature, mean,
    scale)`` rows; a zero deviation scales by 1.  One aggregation, combined
    map-side, then a tiny unpivot."""
    aggs = []
    for n in names:
        aggs += [F.avg(n).alias(f"m_{n}"), F.stddev_pop(n).alias(f"s_{n}")]
    wide = features.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("feature"), F.col(f"m_{n}").alias("mean"),
                     F.when(F.col(f"s_{n}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{n}"))
                     .alias("scale")) for n in names]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def standardize(features: DataFrame, params: DataFrame,
                names=config.SEND_FEATURES) -> DataFrame:
    """M2: ``(x - mean) / scale`` with stored mean and scale per feature."""
    p = _params(params)
    keep = [c for c in features.columns if c not in names]
    return features.select(*keep, *[((F.col(n) - F.lit(p[n][0])) / F.lit(p[n][1])).alias(n)
                                     for n in names])


def send_probability(scaled: DataFrame, params: DataFrame,
                     names=config.SEND_FEATURES) -> DataFrame:
    """M3: logistic score ``1 / (1 + exp(-(w.x + b)))`` as ``send_pred``."""
    p = _params(params)
    z: Column = F.lit(p["bias"][2])
    for n in names:
        z = z + F.col(n) * F.lit(p[n][2])
    return scaled.select("email", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("send_pred"))


def send_probability_from_model(scaled: DataFrame, model, names=config.SEND_FEATURES) -> DataFrame:
    """M3 with a fitted Spark ML ``LogisticRegressionModel`` instead of the
    parameter table: the six scaled columns are assembled into a vector and
    the model's JVM-side ``transform`` scores them; ``send_pred`` is the
    positive-class probability."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    vec = VectorAssembler(inputCols=list(names), outputCol="_features").transform(scaled)
    scored = model.copy({model.featuresCol: "_features"}).transform(vec)
    return scored.select("email", vector_to_array(model.getProbabilityCol())[1].alias("send_pred"))


def send_features(tables, win: RunWindow) -> DataFrame:
    """Scaled six-feature rows per email, ready for the send model."""
    views = tables.page_views(win.send_lo, win.send_hi)
    # one row per scored user, written once: the features feed both the join and the
    # set of buyers, and the clicks behind them are scanned a single time
    feats = materialize(browse_features(views, tables.email_uuids(), win))
    history = order_history(tables.orders_fact(), win, emails=feats.select("email"))
    full = with_order_history(feats, history)
    return standardize(full, tables.send_params())
