"""

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
derived tables.  Doubles are rounded to 6 places and arrays rendered as text
only here, at the edge, so the DuckDB twins in ``oracle/sql.py`` compare
equal; the library functions themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..config import RunWindow
from ..functions import parse
from ..operators import (affinity, catalog, continued, features, identity, inventory, outbox,
                         recipients, recommend, sequences)
from ..session import materialize
from . import jobs
from ..streaming import incremental as streaming
from ..sources.fixtures import FixtureTables

WIN = RunWindow()
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


def tables(spark: SparkSession, sf_dir: str) -> FixtureTables:
    return FixtureTables(spark, sf_dir)


def edge(df: DataFrame) -> DataFrame:
    """Round doubles, render timestamps and arrays as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- sources ---
@query("s1_scan")
def s1_scan(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t.page_views().select("user_uuid", "timestamp", "session_id", "host",
                                 "query_string", "url")


# ----------------------------------------------------- projections/filters ---
def _parsed(spark, sf_dir) -> DataFrame:
    return tables(spark, sf_dir).page_views()


@query("p1_activity")
def p1(spark, sf_dir):
    return _parsed(spark, sf_dir).select("user_uuid", "timestamp",
                                         parse.activity().alias("activity"))


@query("p2_activity_type")
def p2(spark, sf_dir):
    return _parsed(spark, sf_dir).select("user_uuid", "timestamp",
                                         parse.activity_type().alias("activity_type"))


@query("p3_color_clean")
def p3(spark, sf_dir):
    return _parsed(spark, sf_dir).select("user_uuid", "timestamp",
                                         parse.color_clean().alias("color_code"))


@query("p4_color_raw")
def p4(spark, sf_dir):
    return _parsed(spark, sf_dir).select("user_uuid", "timestamp",
                                         parse.color_raw().alias("color_code"))


@query("p5_has_activity")
def p5(spark, sf_dir):
    return (_parsed(spark, sf_dir).where(parse.has_activity())
            .select("user_uuid", "timestamp", "query_string"))


@query("p6_host_filter")
def p6(spark, sf_dir):
    return features.host_filter(_parsed(spark, sf_dir)).select("user_uuid", "timestamp", "host")


@query("p7_lagged_window")
def p7(spark, sf_dir):
    t = tables(spark, sf_dir)
    views = t.page_views(WIN.send_lo, WIN.send_hi)
    return features.window_filter(views, WIN.send_lo, WIN.send_hi).select(
        "user_uuid", "timestamp", "session_id")


@query("p8_open_lower")
def p8(spark, sf_dir):
    t = tables(spark, sf_dir)
    lo = config.ms(config.TRAIN_START_SHORT)
    views = t.page_views(lo, None, strict_lo=True)
    return features.window_filter(views, lo, None, strict_lo=True).select(
        "user_uuid", "timestamp", "session_id")


# ----------------------------------------------------------------- joins ---
@query("j1_click_identity")
def j1(spark, sf_dir):
    t = tables(spark, sf_dir)
    return identity.attach_email(t.page_views(), t.email_uuids()).select(
        "email", "timestamp", "session_id")


@query("j2_single_identity")
def j2(spark, sf_dir):
    t = tables(spark, sf_dir)
    return identity.restrict_single_email(t.email_uuids())


@query("a3_emails_per_uuid")
def a3(spark, sf_dir):
    t = tables(spark, sf_dir)
    return identity.emails_per_uuid(t.email_uuids())


@query("a1_browse_features")
def a1(spark, sf_dir):
    t = tables(spark, sf_dir)
    views = t.page_views(WIN.send_lo, WIN.send_hi)
    return edge(features.browse_features(views, t.email_uuids(), WIN))


@query("a4_order_history")
def a4(spark, sf_dir):
    t = tables(spark, sf_dir)
    return features.order_history(t.orders_fact(), WIN)


@query("j5_features_orders")
def j5(spark, sf_dir):
    t = tables(spark, sf_dir)
    views = t.page_views(WIN.send_lo, WIN.send_hi)
    feats = features.browse_features(views, t.email_uuids(), WIN)
    return edge(features.with_order_history(feats, features.order_history(t.orders_fact(), WIN)))


@query("p19_null_fill")
def p19(spark, sf_dir):
    df = j5(spark, sf_dir)
    return df.select("email", "lifetime_orders", "days_since_last_order")


@query("m2_standardize")
def m2(spark, sf_dir):
    return edge(features.send_features(tables(spark, sf_dir), WIN))


@query("t1_send_features")
def t1(spark, sf_dir):
    return edge(features.send_features(tables(spark, sf_dir), WIN))


@query("m3_send_probability")
def m3(spark, sf_dir):
    t = tables(spark, sf_dir)
    return edge(features.send_probability(features.send_features(t, WIN), t.send_params()))


# ------------------------------------------------------------- recipients ---
def _scores(t: FixtureTables) -> DataFrame:
    return jobs.send_scores(t, WIN)


def _score_log(t: FixtureTables, scores: DataFrame) -> DataFrame:
    """Score log as read back by T2: history plus this run's rows."""
    return t.score_history().unionByName(recipients.score_log_rows(scores, WIN))


@query("s6_score_log_rows")
def s6(spark, sf_dir):
    t = tables(spark, sf_dir)
    return edge(recipients.score_log_rows(_scores(t), WIN))


@query("p9_trailing_window")
def p9(spark, sf_dir):
    t = tables(spark, sf_dir)
    return edge(recipients.trailing(t.score_history(), WIN))


@query("a5_sent_in_window")
def a5(spark, sf_dir):
    t = tables(spark, sf_dir)
    return recipients.sent_in_window(_score_log(t, _scores(t)), WIN)


@query("a6_eligible")
def a6(spark, sf_dir):
    t = tables(spark, sf_dir)
    return recipients.eligible(_score_log(t, _scores(t)), WIN)


@query("p12_threshold_split")
def p12(spark, sf_dir):
    t = tables(spark, sf_dir)
    return recipients.threshold_bands(_scores(t)).select("email", "band")


@query("l3_fraction_sample")
def l3(spark, sf_dir):
    """L3 over the whole click-derived identity map: 45 % of all emails."""
    t = tables(spark, sf_dir)
    return recipients.fraction_sample(t.email_uuids().select("email").distinct(),
                                      config.FRACTION_SEND)


@query("t2_select_recipients")
def t2(spark, sf_dir):
    t = tables(spark, sf_dir)
    scores = _scores(t)
    return recipients.select_recipients(scores, _score_log(t, scores), WIN)


@query("u1_union_by_name")
def u1(spark, sf_dir):
    """Score log read back -- history and this run's rows, by name."""
    t = tables(spark, sf_dir)
    return edge(_score_log(t, _scores(t)))


# -------------------------------------------------------------- sequences ---
def _train_rows(spark, sf_dir, start=config.TRAIN_START) -> DataFrame:
    return materialize(sequences.training_views(tables(spark, sf_dir), start))


def _seq_text(df: DataFrame) -> DataFrame:
    return df.select("email", "activity_type", "chunk",
                     F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query("m1_vocabulary")
def m1(spark, sf_dir):
    return sequences.fit_vocabulary(_train_rows(spark, sf_dir))


@query("w3_sequences")
def w3(spark, sf_dir):
    rows = _train_rows(spark, sf_dir)
    vocab = sequences.fit_vocabulary(rows)
    return _seq_text(sequences.to_sequences(sequences.encode(rows, vocab)))


@query("w3_sequences_step3")
def w3_step3(spark, sf_dir):
    """W3 with overlapping windows (length 10, step 3)."""
    rows = _train_rows(spark, sf_dir)
    vocab = sequences.fit_vocabulary(rows)
    return _seq_text(sequences.to_sequences(sequences.encode(rows, vocab), step=3))


@query("w4_session_sample")
def w4(spark, sf_dir):
    return sequences.session_sample(_train_rows(spark, sf_dir))


@query("w4_session_sample_short")
def w4_short(spark, sf_dir):
    return sequences.session_sample(_train_rows(spark, sf_dir, config.TRAIN_START_SHORT))


def _split(spark, sf_dir):
    rows = _train_rows(spark, sf_dir)
    return rows, sequences.train_test_split(rows)


@query("j16_semi_join")
def j16(spark, sf_dir):
    """Training rows whose activity occurs in a sampled test session."""
    _, parts = _split(spark, sf_dir)
    return parts["train"].select("email", "session_id", "activity_type", "activity",
                                 F.unix_seconds("activity_dt").alias("sec"))


@query("j17_anti_join")
def j17(spark, sf_dir):
    """Rows outside the sampled test sessions."""
    rows = _train_rows(spark, sf_dir)
    picked = sequences.session_sample(rows, by=["activity_type"]).select("activity_type",
                                                                         "session_id")
    return (rows.join(picked, ["activity_type", "session_id"], "left_anti")
            .select("email", "session_id", "activity_type", "activity",
                    F.unix_seconds("activity_dt").alias("sec")))


@query("u2_keys_both_sides")
def u2(spark, sf_dir):
    """Test rows restricted to activities present in train."""
    _, parts = _split(spark, sf_dir)
    return parts["test"].select("email", "session_id", "activity_type", "activity",
                                F.unix_seconds("activity_dt").alias("sec"))


@query("t4_train_test_split")
def t4(spark, sf_dir):
    rows, parts = _split(spark, sf_dir)
    vocab = sequences.fit_vocabulary(rows)
    out = None
    for name in ("train", "test", "full"):
        s = _seq_text(sequences.to_sequences(sequences.encode(parts[name], vocab)))
        s = s.withColumn("split", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


def _recipients(t: FixtureTables, scores: DataFrame | None = None) -> DataFrame:
    scores = scores if scores is not None else _scores(t)
    return recipients.select_recipients(scores, _score_log(t, scores), WIN)


def _t3(spark, sf_dir):
    t = tables(spark, sf_dir)
    vocab, scores = jobs.concurrently(
        lambda: sequences.fit_vocabulary(sequences.training_views(t, config.TRAIN_START)),
        lambda: _scores(t))
    rows = sequences.scoring_views(t, WIN)
    return t, vocab, rows, sequences.activity_sequences(rows, _recipients(t, scores), vocab)


@query("p13_known_vocabulary")
def p13(spark, sf_dir):
    t = tables(spark, sf_dir)
    vocab = sequences.fit_vocabulary(sequences.training_views(t, config.TRAIN_START))
    rows = sequences.scoring_views(t, WIN)
    return sequences.known_vocabulary(rows, vocab).select(
        "email", "session_id", F.unix_seconds("activity_dt").alias("sec"), "activity",
        "activity_type", "color_code")


@query("p14_type_split")
def p14(spark, sf_dir):
    t = tables(spark, sf_dir)
    rows = sequences.scoring_views(t, WIN)
    return rows.where(F.col("activity_type") == "pid").select(
        "email", "session_id", F.unix_seconds("activity_dt").alias("sec"), "activity", "color_code")


@query("t3_activity_sequences")
def t3(spark, sf_dir):
    _, _, _, out = _t3(spark, sf_dir)
    return _seq_text(out["sequences"])


# --------------------------------------------------------------- affinity ---
def _full_model(spark, sf_dir):
    rows = _train_rows(spark, sf_dir)
    vocab = sequences.fit_vocabulary(rows)
    seqs = sequences.to_sequences(sequences.encode(rows, vocab))
    return rows, vocab, seqs, affinity.fit(seqs)


@query("m4_affinity_fit")
def m4(spark, sf_dir):
    _, _, _, model = _full_model(spark, sf_dir)
    return edge(affinity.transition_probabilities(model))


@query("m5_affinity_score")
def m5(spark, sf_dir):
    t = tables(spark, sf_dir)
    (_, vocab, _, model), scores = jobs.concurrently(lambda: _full_model(spark, sf_dir),
                                                     lambda: _scores(t))
    run = sequences.activity_sequences(sequences.scoring_views(t, WIN), _recipients(t, scores),
                                       vocab)
    cands = run["views"].select("email", "activity_type", "activity", "item").distinct()
    return edge(affinity.score(cands, run["sequences"], model))


def _evaluation(spark, sf_dir, fit_on_full: bool = False):
    rows, parts = _split(spark, sf_dir)
    vocab = sequences.fit_vocabulary(rows)
    seq = {n: sequences.to_sequences(sequences.encode(parts[n], vocab))
           for n in ("train", "test", "full")}
    fit_seq = seq["full" if fit_on_full else "train"]
    model = affinity.fit(fit_seq)
    return affinity.reciprocal_ranks(seq["test"], model, affinity.universe_of(fit_seq))


@query("m6_reciprocal_rank")
def m6(spark, sf_dir):
    return edge(_evaluation(spark, sf_dir))


@query("a13_mean_reciprocal_rank")
def a13(spark, sf_dir):
    return edge(affinity.mean_reciprocal_rank(_evaluation(spark, sf_dir)))


@query("m7_model_record")
def m7(spark, sf_dir):
    version = WIN.run_ms // 1000
    return edge(affinity.model_record(affinity.mean_reciprocal_rank(_evaluation(spark, sf_dir)),
                                      version))


# -------------------------------------------------------------- inventory ---
def _stocked(t: FixtureTables) -> DataFrame:
    return inventory.in_stock(inventory.inventory_from_events(t.inventory_events()))


@query("s3_latest_snapshot")
def s3(spark, sf_dir):
    t = tables(spark, sf_dir)
    return inventory.latest_event(t.inventory_events()).select(
        "id", "part", "type", F.length("event").alias("event_chars"))


@query("s4_inventory_events")
def s4(spark, sf_dir):
    return inventory.inventory_from_events(tables(spark, sf_dir).inventory_events())


@query("s4_inventory_upper_limit")
def s4_upper(spark, sf_dir):
    return inventory.inventory_from_events(tables(spark, sf_dir).inventory_events(), upper_limit=3)


@query("s5_inventory_reply")
def s5(spark, sf_dir):
    return inventory.inventory_from_reply(tables(spark, sf_dir).inventory_reply())


@query("p17_stock_predicate")
def p17(spark, sf_dir):
    """SKU rows of the catalogue that are in stock."""
    t = tables(spark, sf_dir)
    return (inventory.variant_skus(t.skus())
            .join(_stocked(t).select(F.col("sku").alias("upc")), "upc", "left_semi"))


@query("s12_variant_skus")
def s12(spark, sf_dir):
    return inventory.variant_skus(tables(spark, sf_dir).skus())


@query("j3_sales_star")
def j3(spark, sf_dir):
    t = tables(spark, sf_dir)
    return edge(inventory.sales_rows(t.orders_fact(), t.variants(), t.skus()))


@query("a8_latest_sizes")
def a8(spark, sf_dir):
    t = tables(spark, sf_dir)
    return inventory.latest_sizes(t.orders_fact(), t.variants(), t.skus())


@query("w1_latest_row")
def w1(spark, sf_dir):
    """W1 on lower-cased emails (the flag A4 uses)."""
    t = tables(spark, sf_dir)
    return inventory.latest_sizes(t.orders_fact(), t.variants(), t.skus(), lower_email=True)


@query("p10_category_suffix")
def p10(spark, sf_dir):
    return inventory.shoe_departments(tables(spark, sf_dir).variants())


@query("j4_sku_sizes")
def j4(spark, sf_dir):
    t = tables(spark, sf_dir)
    return inventory.sku_sizes(t.variants(), t.skus(), t.active_products())


@query("p11_condition_filter")
def p11(spark, sf_dir):
    return (tables(spark, sf_dir).skus().where(F.col("damage_level_id") == 1)
            .select("product_variant_id", "upc", "identifier"))


@query("j18_existence_flag")
def j18(spark, sf_dir):
    t = tables(spark, sf_dir)
    rows = inventory.sku_sizes(t.variants(), t.skus(), t.active_products())
    return inventory.with_stock_flag(rows, _stocked(t)).select("upc", "has_inventory")


@query("a9_color_stock_share")
def a9(spark, sf_dir):
    t = tables(spark, sf_dir)
    prods = inventory.sku_sizes(t.variants(), t.skus(), t.active_products())
    return edge(inventory.color_stock_share(prods, _stocked(t)))


# Predictions for every user over the whole training window (clean colours),
# so the stock check sees thousands of rows rather than one run's users.
def _all_predictions(spark, sf_dir):
    t = tables(spark, sf_dir)
    lo = config.ms(config.TRAIN_START)
    views = features.window_filter(t.page_views(lo, None, strict_lo=True), lo, None, strict_lo=True)
    rows = materialize(sequences.activity_views(views, t.email_uuids(), clean_color=True))
    vocab = sequences.fit_vocabulary(rows)
    enc = sequences.encode(rows, vocab)
    seqs = materialize(sequences.to_sequences(enc))
    model = affinity.fit(seqs)
    cands = enc.select("email", "activity_type", "activity", "item").distinct()
    preds = materialize(affinity.score(cands, seqs, model))
    pid_rows = rows.where(F.col("activity_type") == "pid").select("email", "activity", "color_code")
    return t, preds, pid_rows


def _t5_input(spark, sf_dir):
    t, preds, pid_rows = _all_predictions(spark, sf_dir)
    pid_preds = recommend.product_predictions(preds.where(F.col("activity_type") == "pid"), pid_rows)
    cat_preds = recommend.category_predictions(preds.where(F.col("activity_type") == "cgid"))
    mapped = recommend.category_to_product(cat_preds, t.category_map())
    return t, pid_preds, cat_preds, mapped


@query("a7_color_lists")
def a7(spark, sf_dir):
    _, _, pid_rows = _all_predictions(spark, sf_dir)
    return edge(recommend.color_lists(pid_rows))


@query("j13_color_join")
def j13(spark, sf_dir):
    _, pid_preds, _, _ = _t5_input(spark, sf_dir)
    return edge(pid_preds)


@query("p15_category_allow_list")
def p15(spark, sf_dir):
    _, _, cat_preds, _ = _t5_input(spark, sf_dir)
    return edge(cat_preds.drop("color_code"))


@query("j12_category_to_product")
def j12(spark, sf_dir):
    _, _, _, mapped = _t5_input(spark, sf_dir)
    return edge(mapped.drop("color_code"))


def _user_sizes(spark, sf_dir):
    t, pid_preds, _, mapped = _t5_input(spark, sf_dir)
    preds = pid_preds.unionByName(mapped)
    latest = inventory.latest_sizes(t.orders_fact(), t.variants(), t.skus(),
                                    emails=preds.select("email"))
    return t, preds, inventory.user_sizes(preds, t.variants(), latest)


@query("j6_category_join")
def j6(spark, sf_dir):
    t, preds, _ = _user_sizes(spark, sf_dir)
    return edge(preds.join(inventory.shoe_departments(t.variants()), "activity", "left")
                .drop("color_code"))


@query("j7_latest_size_join")
def j7(spark, sf_dir):
    _, _, sized = _user_sizes(spark, sf_dir)
    return edge(sized.drop("color_code"))


def _prods(spark, sf_dir):
    t, preds, sized = _user_sizes(spark, sf_dir)
    sizes = inventory.sku_sizes(t.variants(), t.skus(), t.active_products())
    wanted = sized.select("activity", F.col("identifier").alias("_want")).distinct()
    prods = (wanted.join(sizes, "activity")
             .where(F.col("_want").isNull() | (F.col("_want") == F.col("identifier"))))
    return t, sized, sizes, prods


@query("j8_optional_key_join")
def j8(spark, sf_dir):
    _, _, _, prods = _prods(spark, sf_dir)
    return prods.select("activity", F.col("_want").alias("wanted"), "sksz_color_code", "pvid",
                        "identifier", "upc", "active_flag")


@query("j9_buyer_sku_join")
def j9(spark, sf_dir):
    _, sized, sizes, _ = _prods(spark, sf_dir)
    return edge(sized.where(F.col("identifier").isNotNull())
                .join(sizes, ["activity", "identifier"]))


@query("j10_lead_sku_join")
def j10(spark, sf_dir):
    _, sized, sizes, _ = _prods(spark, sf_dir)
    return edge(sized.where(F.col("identifier").isNull()).drop("identifier")
                .join(sizes, "activity"))


@query("p16_color_predicate")
def p16(spark, sf_dir):
    _, sized, sizes, _ = _prods(spark, sf_dir)
    j = sized.drop("identifier").join(sizes, "activity")
    return edge(j.select("email", "activity", "upc", "color_code", "active_flag",
                         inventory.color_ok().alias("ok")))


@query("j11_lead_share_join")
def j11(spark, sf_dir):
    t, sized, sizes, prods = _prods(spark, sf_dir)
    share = inventory.color_stock_share(prods, _stocked(t)).select("activity", "sksz_color_code")
    return edge(sized.where(F.col("identifier").isNull()).drop("identifier")
                .join(sizes, "activity").where(inventory.color_ok())
                .join(share, ["activity", "sksz_color_code"]))


def _t5(spark, sf_dir):
    t, pid_preds, cat_preds, mapped = _t5_input(spark, sf_dir)
    checked = inventory.check_inventory(pid_preds.unionByName(mapped), t.variants(), t.skus(),
                                        t.active_products(), t.orders_fact(), _stocked(t))
    return t, checked, cat_preds


@query("t5_check_inventory")
def t5(spark, sf_dir):
    _, checked, _ = _t5(spark, sf_dir)
    return edge(checked)


def _t6_best(spark, sf_dir):
    t, checked, cat_preds = _t5(spark, sf_dir)
    return t, materialize(recommend.best_per_user(
        checked.unionByName(cat_preds, allowMissingColumns=True)))


@query("w2_best_per_user")
def w2(spark, sf_dir):
    _, best = _t6_best(spark, sf_dir)
    return edge(best.select("email", "activity", "activity_type", "pred", "upc",
                            "sksz_color_code"))


@query("t6_recommend")
def t6(spark, sf_dir):
    t, best = _t6_best(spark, sf_dir)
    out = recommend.with_variant_fields(best, t.variants())
    return edge(out.select("email", "activity", "activity_type", "pred", "upc", "sksz_color_code",
                           "product_variant_id", "product_name", "retail_usd", "factory_region"))


@query("j14_variant_fields")
def j14(spark, sf_dir):
    t, best = _t6_best(spark, sf_dir)
    return edge(recommend.variant_fields(t.variants(), best))


# ----------------------------------------------------------------- outbox ---
PAYLOAD_COLS = ("product_group_id", "name", "product_variant_id", "color_code", "image_url", "url",
                "manufacturer_region", "price")


def _flat_payload(df: DataFrame) -> DataFrame:
    p = F.element_at("products", 1)
    return edge(df.select("email", "event_name", "category", "pred",
                          *[p[c].alias(c) for c in PAYLOAD_COLS]))


def _json_pred(c):
    return c.cast("decimal(12,6)")


@query("a11_prediction_log")
def a11(spark, sf_dir):
    _, pid_preds, cat_preds, _ = _t5_input(spark, sf_dir)
    return edge(outbox.prediction_log(pid_preds, cat_preds, WIN, pred=_json_pred(F.col("pred"))))


@query("l4_rollout_gate")
def l4(spark, sf_dir):
    """L4 at 256 bits (DuckDB has no sha224); ``l4_rollout_gate_224`` is the reference's."""
    t = tables(spark, sf_dir)
    return outbox.rollout_gate(t.email_uuids().select("email").distinct(), bits=256)


@query("l4_rollout_gate_224")
def l4_224(spark, sf_dir):
    t = tables(spark, sf_dir)
    return outbox.rollout_gate(t.email_uuids().select("email").distinct(), bits=224)


@query("l5_send_cap")
def l5(spark, sf_dir):
    _, best = _t6_best(spark, sf_dir)
    return edge(outbox.send_cap(outbox.rollout_gate(best, bits=256), 50)
                .select("email", "activity", "pred"))


@query("s10_outbox")
def s10(spark, sf_dir):
    t, best = _t6_best(spark, sf_dir)
    full = recommend.with_variant_fields(best, t.variants())
    return _flat_payload(outbox.payload(outbox.rollout_gate(full, bits=256)))


@query("p22_payload_router")
def p22(spark, sf_dir):
    t, best = _t6_best(spark, sf_dir)
    full = recommend.with_variant_fields(best, t.variants())
    return _flat_payload(outbox.payload(full))


@query("s8_run_log")
def s8(spark, sf_dir):
    """Past runs (the hours of the score-log history) plus this run;
    the newest run per feature is what the next run passes as last_run."""
    t = tables(spark, sf_dir)
    past = t.score_history().select(F.date_trunc("hour", "timestamp").alias("timestamp"),
                                    F.lit(config.FEATURE_NAME).alias("feature"))
    log = past.unionByName(outbox.run_log_row(spark, WIN))
    return edge(outbox.last_run(log))


@query("s9_mark_sent")
def s9(spark, sf_dir):
    t, best = _t6_best(spark, sf_dir)
    log = _score_log(t, _scores(t))
    delivered = (outbox.rollout_gate(best, bits=256)
                 .select("email", F.lit(WIN.run_text).cast("timestamp").alias("timestamp")))
    return edge(outbox.sent_flags(log, delivered))


@query("t7_run_scoring")
def t7(spark, sf_dir):
    """T7 end to end (rollout gate at 256 bits so DuckDB can check it)."""
    t = tables(spark, sf_dir)
    vocab, model, scores = jobs.prepare_run(t, WIN)
    run = jobs.build_scoring(t, WIN, vocab, model, rollout_bits=256, scores=scores)
    return _flat_payload(run.outbox)


@query("t8_trained_then_scored")
def t8_chain(spark, sf_dir):
    """T8 then T7 through artefacts: train, save, load, score."""
    from ..session import scratch_path
    t = tables(spark, sf_dir)
    path = scratch_path(spark, "trained")
    jobs.run_training(t, path)
    vocab, model = jobs.load_serving(spark, path)
    return _flat_payload(jobs.build_scoring(t, WIN, vocab, model, rollout_bits=256).outbox)


@query("t7_run_scoring_224")
def t7_224(spark, sf_dir):
    t = tables(spark, sf_dir)
    vocab, model, scores = jobs.prepare_run(t, WIN)
    return _flat_payload(jobs.build_scoring(t, WIN, vocab, model, scores=scores).outbox)


@query("s7_prediction_log")
def s7(spark, sf_dir):
    """The run's prediction log rows (preds as 6-place decimals in the JSON)."""
    t = tables(spark, sf_dir)
    vocab, model, scores = jobs.prepare_run(t, WIN)
    run = jobs.build_scoring(t, WIN, vocab, model, scores=scores,
                             log_pred=_json_pred(F.col("pred")))
    return edge(run.prediction_log)


@query("t8_run_training")
def t8(spark, sf_dir):
    t = tables(spark, sf_dir)
    return edge(jobs.build_training(t, version=WIN.run_ms // 1000).record)


# the batches in which the training clicks up to the run arrive
BATCHES = (datetime(2024, 1, 11), datetime(2024, 1, 20), datetime(2024, 1, 26, 7, 30), config.RUN)


@query("t8_continued_training")
def t8_continued(spark, sf_dir):
    """T8 in four calls, each reading its own clicks: the served transitions by name."""
    from ..session import scratch_path
    t = tables(spark, sf_dir)
    path = scratch_path(spark, "continued")
    for i, until in enumerate(BATCHES):
        jobs.continue_training(t, path, until, version=i)
    vocab, model = jobs.load_serving(spark, path)
    names = vocab.select((F.col("idx") + 1).alias("item"), "activity")
    prob = affinity.transition_probabilities(model)
    src = names.select(F.col("item").alias("src"), F.col("activity").alias("src_activity"))
    dst = names.select(F.col("item").alias("dst"), F.col("activity").alias("dst_activity"))
    return edge(prob.join(src, "src").join(dst, "dst").drop("src", "dst"))


@query("w3_newest_items")
def w3_newest(spark, sf_dir):
    """W3's chunk 0 from the kept newest items, merged over the batches and the clicks after."""
    rows = _train_rows(spark, sf_dir)
    rows = materialize(sequences.encode(rows, sequences.fit_vocabulary(rows)))
    kept, ms = None, F.col("timestamp")
    bounds = [None, *map(config.ms, BATCHES), None]
    for lo, hi in zip(bounds, bounds[1:]):
        batch = rows if lo is None else rows.where(ms >= lo)
        batch = batch if hi is None else batch.where(ms < hi)
        kept = materialize(continued.merge_last_n(kept, batch, config.MAX_SEQUENCE_LENGTH))
    return _seq_text(continued.newest_sequences(kept))


@query("m6_counts_and_factors")
def m6_models(spark, sf_dir):
    """M6 and A13 of the counts and of the matrix factorisation on one test part."""
    return jobs.compare_models(tables(spark, sf_dir))


@query("s11_model_round_trip")
def s11(spark, sf_dir):
    """Write the fitted model tables and read them back."""
    from ..session import scratch_path
    t = tables(spark, sf_dir)
    _, model = jobs.serving_model(t)
    path = scratch_path(spark, "model")
    affinity.save_model(model, path)
    back = affinity.load_model(spark, path)
    return edge(affinity.transition_probabilities(back))


# ---------------------------------------------------------------- catalog ---
@query("s2_resolve_table")
def s2(spark, sf_dir):
    """The orders fact under a dated name, found by suffix."""
    t = tables(spark, sf_dir)
    facts = t.orders_fact()
    facts.createOrReplaceTempView("scratch_2023_orders_fact")
    facts.where(F.lit(False)).createOrReplaceTempView("scratch_2022_orders_fact")
    name = catalog.resolve_table(spark, "_orders_fact")
    return edge(spark.table(name))


@query("s13_active_styles")
def s13(spark, sf_dir):
    return catalog.active_styles(tables(spark, sf_dir).active_products())


@query("s14_product_catalog")
def s14(spark, sf_dir):
    return edge(catalog.product_catalog(tables(spark, sf_dir).variants()))


@query("a10_loyal_shoppers")
def a10(spark, sf_dir):
    t = tables(spark, sf_dir)
    return edge(catalog.loyal_shoppers(t.orders_fact(), t.variants(), t.skus()))


@query("j15_viewed_variants")
def j15(spark, sf_dir):
    t = tables(spark, sf_dir)
    return catalog.viewed_variants(t.page_views(), t.variants(), view_columns=("session_id", "host"),
                                   variant_columns=("category", "product_name"))


@query("p20_columns")
def p20(spark, sf_dir):
    """P20: rename, drop, constant and subset of columns."""
    t = tables(spark, sf_dir)
    return edge(t.variants().withColumnRenamed("id", "product_variant_id")
                .drop("group_creative", "plan_date").withColumn("source", F.lit("catalogue"))
                .select("product_variant_id", "product_name", "category", "source"))


@query("a12_distinct_rows")
def a12(spark, sf_dir):
    """Distinct (activity, activity type) pairs of the whole click stream."""
    t = tables(spark, sf_dir)
    return (t.page_views().where(parse.has_activity())
            .select(parse.activity().alias("activity"), parse.activity_type().alias("activity_type"))
            .distinct())


@query("l1_global_sort")
def l1(spark, sf_dir):
    """L1: ordered output at the sink (A1 by email)."""
    t = tables(spark, sf_dir)
    views = t.page_views(WIN.send_lo, WIN.send_hi)
    return edge(features.browse_features(views, t.email_uuids(), WIN).orderBy("email"))


# --------------------------------------------------------------- scalars ---
@query("f_string")
def f_string(spark, sf_dir):
    """F1-F9 on the variants and the click stream's product ids."""
    v = tables(spark, sf_dir).variants()
    return v.select(
        "id",
        parse.part("product_name", " ", 2).alias("second_word"),
        parse.first_match_drop_nondigits(F.col("product_name")).alias("first_match"),
        parse.regex_group_or_null("product_name", r"([a-z]+)$").alias("last_word"),
        F.substring("product_name", 1, 7).alias("prefix7"),
        F.lower("material").alias("material_lower"),
        F.replace(F.col("product_name"), F.lit("  "), F.lit(" ")).alias("name_clean"),
        parse.group_key().alias("group_key"),
        F.concat("product_style_code", F.lit("_"), "group_creative").alias("concat_null"),
        F.concat_ws("", "product_style_code", "group_creative").alias("concat_skip"),
        F.col("category").like("%Shoes").alias("is_shoes"))


@query("f_time")
def f_time(spark, sf_dir):
    """F10-F15 on the click stream and orders."""
    t = tables(spark, sf_dir)
    views = t.page_views()
    secs = parse.epoch_ms_to_ts()
    run = F.lit(WIN.run_text).cast("timestamp")
    return edge(views.select(
        "user_uuid", "timestamp",
        secs.alias("activity_dt"),
        F.date_trunc("day", secs).alias("day"),
        (F.unix_seconds(run) - F.unix_seconds(secs)).alias("epoch_gap"),
        F.year(secs).alias("year"),
        F.expr(f"timestampdiff(DAY, timestamp_seconds(timestamp div 1000), "
               f"TIMESTAMP '{WIN.run_text}')").alias("days"),
        (run - F.expr("INTERVAL '5 days 2 hours'")).alias("window_start")))


@query("f_json")
def f_json(spark, sf_dir):
    """JSON field, JSON list with defaults, JSON text."""
    v = tables(spark, sf_dir).variants()
    return v.select(
        "id",
        F.get_json_object("group_creative", "$.shortDescription").alias("short_desc"),
        F.to_json(F.struct(F.col("id").alias("id"),
                           F.col("color_code").alias("color_code"))).alias("as_json"))


@query("f_hash")
def f_hash(spark, sf_dir):
    """F23 (256-bit twin) and the sampling hash."""
    e = tables(spark, sf_dir).email_uuids().select("email").distinct()
    return e.select("email", F.sha2("email", 256).alias("sha256"),
                    recipients_hash(F.col("email")).alias("sample_hash"),
                    parse.in_rollout("email", 256).alias("in_rollout"))


@query("f_hash_224")
def f_hash_224(spark, sf_dir):
    e = tables(spark, sf_dir).email_uuids().select("email").distinct()
    return e.select("email", F.sha2("email", 224).alias("sha224"),
                    parse.in_rollout("email", 224).alias("in_rollout"))


def recipients_hash(c):
    from ..operators.ranking import sample_hash
    return sample_hash(config.SAMPLE_SEED, c)


# -------------------------------------------------------------- streaming ---
def _events_glob(sf_dir: str) -> str:
    """The driver ships one events file; a glob lets the file source watch
    its folder for that name (a production source is a folder of files)."""
    return f"{sf_dir.rstrip('/')}/event[s].parquet"


def _click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.derive_page_views(streaming.event_stream(spark, _events_glob(sf_dir)))


def _stream_dirs(spark, name: str) -> tuple[str, str]:
    from ..session import scratch_path
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


@query("r1_landed_page_views")
def r1(spark, sf_dir):
    """Click rows landed by an availableNow file stream, read back."""
    out, ckpt = _stream_dirs(spark, "r1")
    q = streaming.land_page_views(_click_stream(spark, sf_dir), out, ckpt)
    q.awaitTermination()
    return spark.read.parquet(out).select("user_uuid", "timestamp", "session_id", "host",
                                          "query_string", "url")


@query("r2_hourly_partials")
def r2(spark, sf_dir):
    """R2: send features from one stream of hourly partials (watermark 2 h)."""
    t = tables(spark, sf_dir)
    out, ckpt = _stream_dirs(spark, "r2")
    streaming.start_hourly_features(_click_stream(spark, sf_dir), t.email_uuids(), out, ckpt).awaitTermination()
    return edge(streaming.features_from_partials(spark.read.parquet(out), WIN))


# ------------------------------------------------------ small named rules ---
@query("p18_nonblank_filter")
def p18(spark, sf_dir):
    """Product rows whose colour is not '' (a NULL colour stays)."""
    rows = sequences.scoring_views(tables(spark, sf_dir), WIN)
    return (rows.where((F.col("activity_type") == "pid") & ~F.col("color_code").eqNullSafe(""))
            .select("email", "activity", "color_code"))


@query("p21_group_key")
def p21(spark, sf_dir):
    return tables(spark, sf_dir).variants().select("id", parse.group_key().alias("activity"))


@query("a2_conditional_count")
def a2(spark, sf_dir):
    """A2: per email, category and product views of the whole click stream."""
    t = tables(spark, sf_dir)
    clicks = identity.attach_email(t.page_views(), t.email_uuids())
    return clicks.groupBy("email").agg(
        F.count(F.when(parse.category_key() != "", F.col("timestamp"))).alias("cgid_count"),
        F.count(F.when(parse.product_key() != "", F.col("timestamp"))).alias("pdp_count"))


@query("l2_top1")
def l2(spark, sf_dir):
    """L2: the newest order line (a top-1 report)."""
    o = tables(spark, sf_dir).orders_fact()
    return edge(o.orderBy(F.desc_nulls_first("order_date"), F.desc("order_id"),
                          F.desc("sales_order_sku")).limit(1))


@query("r1_hourly_run")
def r1_run(spark, sf_dir):
    """The hourly run fed by the landed click table (same result as T7)."""
    t = tables(spark, sf_dir)
    vocab, model = jobs.serving_model(t)
    out, ckpt = _stream_dirs(spark, "r1run")
    run = streaming.hourly_run(_click_stream(spark, sf_dir), t, out, ckpt, WIN, vocab, model,
                               rollout_bits=256)
    return _flat_payload(run.outbox)


@query("m2_fit_scaler")
def m2_fit(spark, sf_dir):
    """M2 fit: mean and population deviation of the six unscaled features."""
    t = tables(spark, sf_dir)
    views = t.page_views(WIN.send_lo, WIN.send_hi)
    feats = features.with_order_history(features.browse_features(views, t.email_uuids(), WIN),
                                        features.order_history(t.orders_fact(), WIN))
    return edge(features.fit_scaler(feats))
