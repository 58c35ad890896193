"""DuckDB oracle SQL, one entry per ``browsekit.plans.queries`` key.

Written independently from the Spark code, straight from the semantics in
views of ``oracle.views``.
"""

from __future__ import annotations

from browsekit import config
from browsekit.config import RunWindow

from .views import with_views

W = RunWindow()
HOSTS = ", ".join(f"'{h}'" for h in config.HOSTS)
SQL: dict[str, str] = {}

CAT = "split_part(split_part(query_string, 'cgid=', 2), '&', 1)"
PDP = "split_part(split_part(split_part(query_string, 'pid=', 2), '&', 1), '?', 1)"
ACT = f"case when {CAT} <> '' then {CAT} else {PDP} end"
ACT_TYPE = f"case when {CAT} <> '' then 'cgid' else 'pid' end"
COLOR_RAW = ("split_part(split_part(split_part(split_part(split_part(url, '/color/', 2), "
             "'/', 1), '?', 1), '&', 1), 'http', 1)")
COLOR = f"regexp_replace({COLOR_RAW}, '[^0-9]+', '')"


def q(key: str, body: str, **ctes: str) -> None:
    SQL[key] = with_views(body, ctes)


def r6(x: str) -> str:
    return f"round({x}, 6)"


# ---------------------------------------------------------------- sources ---
q("s1_scan", "select user_uuid, timestamp, session_id, host, query_string, url "
             "from clickstream_page_views")

# ----------------------------------------------------- projections/filters ---
q("p1_activity", f"select user_uuid, timestamp, {ACT} as activity from clickstream_page_views")
q("p2_activity_type", f"select user_uuid, timestamp, {ACT_TYPE} as activity_type "
                      "from clickstream_page_views")
q("p3_color_clean", f"select user_uuid, timestamp, {COLOR} as color_code from clickstream_page_views")
q("p4_color_raw", f"select user_uuid, timestamp, {COLOR_RAW} as color_code from clickstream_page_views")
q("p5_has_activity", f"select user_uuid, timestamp, query_string from clickstream_page_views "
                     f"where {PDP} <> '' or {CAT} <> ''")
q("p6_host_filter", f"select user_uuid, timestamp, host from clickstream_page_views "
                    f"where host in ({HOSTS})")
q("p7_lagged_window", "select user_uuid, timestamp, session_id from clickstream_page_views "
                      f"where timestamp >= {W.send_lo} and timestamp < {W.send_hi}")
q("p8_open_lower", "select user_uuid, timestamp, session_id from clickstream_page_views "
                   f"where timestamp > {config.ms(config.TRAIN_START_SHORT)}")

# ----------------------------------------------------------------- joins ---
q("j1_click_identity", "select eu.email, c.timestamp, c.session_id from clickstream_page_views c "
                       "join email_uuids eu on c.user_uuid = eu.uuid")
SINGLE = "select uuid from email_uuids group by uuid having count(distinct email) = 1"
q("j2_single_identity", "select e.uuid, e.email from email_uuids e "
                        "where e.uuid in (select uuid from single_email)", single_email=SINGLE)
q("a3_emails_per_uuid", "select uuid, count(distinct email) as count_emails from email_uuids group by uuid")

BROWSE = f"""
    select eu.email,
      cast({W.run_ms} // 1000 - max(c.timestamp) // 1000 as double) as time_since_browse,
      count(case when {CAT} <> '' then c.timestamp end) as cgid_count,
      count(case when {PDP} <> '' then c.timestamp end) as pdp_count,
      count(distinct c.timestamp) as "count"
    from clickstream_page_views c
    join email_uuids eu on c.user_uuid = eu.uuid
    join single_email se on eu.uuid = se.uuid
    where c.timestamp >= {W.send_lo} and c.timestamp < {W.send_hi} and c.host in ({HOSTS})
    group by eu.email
    having max(c.timestamp) >= {W.recency_lo}"""
q("a1_browse_features", "select * from browse", browse=BROWSE, single_email=SINGLE)

ORDER_HIST = f"""
    select lower(billing_email) as email, count(distinct order_id) as lifetime_orders,
      date_sub('day', max(order_date), TIMESTAMP '{W.run_text}') as days_since_last_order
    from orders_fact group by 1"""
q("a4_order_history", "select * from order_hist", order_hist=ORDER_HIST)

FEATS = f"""
    select b.email, b.time_since_browse, b.cgid_count, b.pdp_count, b."count",
      coalesce(cast(o.lifetime_orders as double), {float(config.FILL_LIFETIME_ORDERS)}) as lifetime_orders,
      coalesce(cast(o.days_since_last_order as double), {float(config.FILL_DAYS_SINCE_LAST_ORDER)})
        as days_since_last_order
    from browse b left join order_hist o on b.email = o.email"""
FEAT_CTES = dict(browse=BROWSE, single_email=SINGLE, order_hist=ORDER_HIST, feats=FEATS)
q("j5_features_orders", f"select email, {r6('time_since_browse')} as time_since_browse, cgid_count, "
                        "pdp_count, \"count\", lifetime_orders, days_since_last_order from feats",
  **FEAT_CTES)
q("p19_null_fill", "select email, lifetime_orders, days_since_last_order from feats", **FEAT_CTES)


def _z(name: str) -> str:
    return (f"((f.{name} - (select mean from send_params where feature = '{name}')) / "
            f"(select scale from send_params where feature = '{name}'))")


SCALED = ("select f.email, " + ", ".join(f"{_z(n)} as {n}" for n in config.SEND_FEATURES)
          + " from feats f")
SCALED = SCALED.replace(" as count", ' as "count"').replace("f.count", 'f."count"')
FEAT_CTES2 = dict(FEAT_CTES, scaled=SCALED)
_cols = ", ".join(f"round(s.{n}, 6) as {n}".replace("s.count", 's."count"').replace(
    "as count", 'as "count"') for n in config.SEND_FEATURES)
q("m2_standardize", f"select s.email, {_cols} from scaled s", **FEAT_CTES2)
q("t1_send_features", f"select s.email, {_cols} from scaled s", **FEAT_CTES2)

_w = " + ".join(f"s.{n} * (select weight from send_params where feature = '{n}')"
                .replace("s.count", 's."count"') for n in config.SEND_FEATURES)
PROB = (f"select s.email, 1.0 / (1.0 + exp(-((select weight from send_params where feature = 'bias')"
        f" + {_w}))) as send_pred from scaled s")
FEAT_CTES3 = dict(FEAT_CTES2, probs=PROB)
q("m3_send_probability", "select email, round(send_pred, 6) as send_pred from probs", **FEAT_CTES3)

# ------------------------------------------------------------- recipients ---
RUN_TS = f"TIMESTAMP '{W.run_text}'"
RUN_ROWS = f"select email, send_pred as prob, {RUN_TS} as timestamp, false as send_flag from probs"
SCORE_LOG = f"select email, prob, timestamp, send_flag from send_model_output union all {RUN_ROWS}"
SENT = (f"select email, case when bool_or(send_flag) then 1 else 0 end as sent from score_log "
        f"where timestamp >= {RUN_TS} - interval {config.RESEND_BLOCK_HOURS} hours group by 1")
ELIGIBLE = "select email from sent where sent = 0"
BANDED = (f"select email, send_pred, case when send_pred >= {config.SEND_THRESHOLD} then 'over' "
          f"when send_pred < {config.SEND_THRESHOLD} then 'under' end as band from probs "
          "where email in (select email from eligible)")


def hash_take(src: str, key: str, frac: float, seed: str = config.SAMPLE_SEED) -> str:
    """First round_half_even(frac * n) rows of ``src`` in md5(seed || key) order."""
    return (f"select * exclude (_rn, _n) from (select *, row_number() over "
            f"(order by md5('{seed}' || {key}), {key}) as _rn, count(*) over () as _n "
            f"from ({src}) s) r where _rn <= round_even({frac} * _n, 0)")


REC_CTES = dict(FEAT_CTES3, score_log=SCORE_LOG, sent=SENT, eligible=ELIGIBLE, banded=BANDED)
q("s6_score_log_rows", f"select email, round(prob, 6) as prob, strftime(timestamp, '%Y-%m-%d %H:%M:%S') "
  "as timestamp, send_flag from run_rows", run_rows=RUN_ROWS, **FEAT_CTES3)
q("p9_trailing_window", "select email, round(prob, 6) as prob, strftime(timestamp, '%Y-%m-%d %H:%M:%S') "
  f"as timestamp, send_flag from send_model_output where timestamp >= {RUN_TS} - interval "
  f"{config.RESEND_BLOCK_HOURS} hours")
q("a5_sent_in_window", "select email, sent from sent", **REC_CTES)
q("a6_eligible", "select email from eligible", **REC_CTES)
q("p12_threshold_split", f"select email, case when send_pred >= {config.SEND_THRESHOLD} then 'over' "
  f"when send_pred < {config.SEND_THRESHOLD} then 'under' end as band from probs "
  "where send_pred is not null", **FEAT_CTES3)
q("l3_fraction_sample", hash_take("select distinct email from email_uuids", "email",
                                  config.FRACTION_SEND))
q("t2_select_recipients", "select email from banded where band = 'over' union all "
  + hash_take("select email from banded where band = 'under'", "email", config.FRACTION_SEND),
  **REC_CTES)
q("u1_union_by_name", "select email, round(prob, 6) as prob, strftime(timestamp, '%Y-%m-%d %H:%M:%S') "
  "as timestamp, send_flag from score_log", **REC_CTES)

# -------------------------------------------------------------- sequences ---


def act_views(lo_cond: str, color: str) -> str:
    return (f"select eu.email, c.session_id, c.timestamp // 1000 as sec, {ACT} as activity, "
            f"{ACT_TYPE} as activity_type, {color} as color_code "
            "from clickstream_page_views c join email_uuids eu on c.user_uuid = eu.uuid "
            f"where ({PDP} <> '' or {CAT} <> '') and {lo_cond} and c.host in ({HOSTS})")


TRAIN_VIEWS = act_views(f"c.timestamp > {config.ms(config.TRAIN_START)}", COLOR_RAW)
TRAIN_VIEWS_SHORT = act_views(f"c.timestamp > {config.ms(config.TRAIN_START_SHORT)}", COLOR_RAW)
SCORE_VIEWS = act_views(f"c.timestamp >= {W.seq_lo} and c.timestamp < {W.seq_hi}", COLOR)
VOCAB = ("select activity, cast(row_number() over (order by activity) - 1 as integer) as idx "
         "from (select distinct activity from train_views) d")


def seqs(src: str, step: int = config.SEQUENCE_STEP, length: int = config.MAX_SEQUENCE_LENGTH,
         extra: str = "") -> str:
    """Windows of ``length`` items ending at the newest, stepping back by ``step``."""
    ranked = (f"select r.*, v.idx + 1 as item, row_number() over (partition by {extra} email, "
              "activity_type order by sec desc, session_id desc, r.activity desc) - 1 as q "
              f"from ({src}) r join vocab v on r.activity = v.activity")
    windows = (f"select x.*, unnest(range((greatest(x.q - {length - 1}, 0) + {step - 1}) // {step}, "
               f"x.q // {step} + 1)) as chunk from ({ranked}) x")
    return (f"select {extra} email, activity_type, cast(chunk as integer) as chunk, "
            f"repeat('0,', {length} - count(*)) || string_agg(cast(item as varchar), ',' "
            f"order by q desc) as items from ({windows}) w group by all")


SEQ_CTES = dict(train_views=TRAIN_VIEWS, vocab=VOCAB)
q("m1_vocabulary", "select activity, idx from vocab", **SEQ_CTES)
q("w3_sequences", seqs("select * from train_views"), **SEQ_CTES)
q("w3_newest_items", f"select * from ({seqs('select * from train_views')}) s where chunk = 0", **SEQ_CTES)
q("w3_sequences_step3", seqs("select * from train_views", step=3), **SEQ_CTES)


def sample_sessions(src: str) -> str:
    return ("select activity_type, email, session_id from (select *, row_number() over "
            f"(partition by activity_type, email order by md5('{config.SAMPLE_SEED}' || session_id), "
            "session_id) as rn, count(*) over (partition by activity_type, email) as n from "
            f"(select distinct activity_type, email, session_id from ({src}) s) d) r "
            f"where rn <= case when n >= {config.SESSION_SAMPLE_MIN} then "
            f"round_even({config.SESSION_SAMPLE_FRACTION} * n, 0) else 1 end")


def sample_sessions_by_email(src: str) -> str:
    return ("select email, session_id from (select *, row_number() over "
            f"(partition by email order by md5('{config.SAMPLE_SEED}' || session_id), session_id) "
            "as rn, count(*) over (partition by email) as n from "
            f"(select distinct email, session_id from ({src}) s) d) r "
            f"where rn <= case when n >= {config.SESSION_SAMPLE_MIN} then "
            f"round_even({config.SESSION_SAMPLE_FRACTION} * n, 0) else 1 end")


q("w4_session_sample", sample_sessions_by_email("select * from train_views"), **SEQ_CTES)
q("w4_session_sample_short", sample_sessions_by_email("select * from train_views_short"),
  train_views_short=TRAIN_VIEWS_SHORT)

SPLIT_CTES = dict(
    SEQ_CTES,
    picked=sample_sessions("select * from train_views"),
    test0="select * from train_views t where (activity_type, session_id) in "
          "(select (activity_type, session_id) from picked)",
    rest="select * from train_views t where (activity_type, session_id) not in "
         "(select (activity_type, session_id) from picked)",
    train="select * from rest where (activity_type, activity) in "
          "(select (activity_type, activity) from test0)",
    test="select * from test0 where (activity_type, activity) in "
         "(select (activity_type, activity) from train)",
)
ROWS5 = "email, session_id, activity_type, activity, sec"
q("j16_semi_join", f"select {ROWS5} from train", **SPLIT_CTES)
q("j17_anti_join", f"select {ROWS5} from rest", **SPLIT_CTES)
q("u2_keys_both_sides", f"select {ROWS5} from test", **SPLIT_CTES)
q("t4_train_test_split", " union all ".join(
    f"select *, '{n}' as split from ({seqs(f'select * from {src}')}) s{n}"
    for n, src in (("train", "train"), ("test", "test"), ("full", "train_views"))), **SPLIT_CTES)

RECIP = ("select email from banded where band = 'over' union all "
         + hash_take("select email from banded where band = 'under'", "email", config.FRACTION_SEND))
T3_CTES = dict(REC_CTES, **SEQ_CTES, recip=RECIP, score_views=SCORE_VIEWS,
               chosen="select * from score_views where email in (select email from recip) "
                      "and activity in (select activity from vocab)")
q("p13_known_vocabulary", "select email, session_id, sec, activity, activity_type, color_code "
  "from score_views where activity in (select activity from vocab)",
  score_views=SCORE_VIEWS, **SEQ_CTES)
q("p14_type_split", "select email, session_id, sec, activity, color_code from score_views "
  "where activity_type = 'pid'", score_views=SCORE_VIEWS)
q("t3_activity_sequences", seqs("select * from chosen"), **T3_CTES)

# --------------------------------------------------------------- affinity ---


def ranked(src: str) -> str:
    return (f"select r.*, v.idx + 1 as item, row_number() over (partition by email, activity_type "
            "order by sec desc, session_id desc, r.activity desc) - 1 as q "
            f"from ({src}) r join vocab v on r.activity = v.activity")


def model_ctes(prefix: str, ranked_name: str) -> dict[str, str]:
    """Count tables of the affinity model fitted on the ranked rows."""
    L = config.MAX_SEQUENCE_LENGTH
    return {
        f"{prefix}icnt": f"select activity_type, item, count(*) as item_count from {ranked_name} "
                         "group by all",
        f"{prefix}tot": f"select activity_type, cast(sum(item_count) as bigint) as total "
                        f"from {prefix}icnt group by all",
        f"{prefix}pairs": f"select a.activity_type, a.item as src, b.item as dst, count(*) as pair_count "
                          f"from {ranked_name} a join {ranked_name} b on a.email = b.email and "
                          "a.activity_type = b.activity_type and b.q = a.q - 1 and "
                          f"a.q // {L} = b.q // {L} group by all",
        f"{prefix}srcc": f"select activity_type, src, cast(sum(pair_count) as bigint) as src_count "
                         f"from {prefix}pairs group by all",
    }


M4_CTES = dict(SEQ_CTES, fr=ranked("select * from train_views"), **model_ctes("f_", "fr"))
q("m4_affinity_fit",
  "select p.activity_type, p.src, p.dst, p.pair_count, s.src_count, "
  "round((p.pair_count + 1.0 * i.item_count / t.total) / (s.src_count + 1.0), 6) as prob "
  "from f_pairs p join f_srcc s on p.activity_type = s.activity_type and p.src = s.src "
  "join f_icnt i on i.activity_type = p.activity_type and i.item = p.dst "
  "join f_tot t on t.activity_type = p.activity_type", **M4_CTES)

M5_CTES = dict(T3_CTES, **M4_CTES, cr=ranked("select * from chosen"))
q("m5_affinity_score",
  "select c.email, c.activity, c.activity_type, round((coalesce(p.pair_count, 0) + "
  "coalesce(1.0 * i.item_count / t.total, 0.0)) / (coalesce(s.src_count, 0) + 1.0), 6) as pred "
  "from (select distinct email, activity_type, activity, item from cr) c "
  "join (select email, activity_type, item as src from cr where q = 0) l "
  "  on c.email = l.email and c.activity_type = l.activity_type "
  "left join f_icnt i on i.activity_type = c.activity_type and i.item = c.item "
  "left join f_tot t on t.activity_type = c.activity_type "
  "left join f_pairs p on p.activity_type = c.activity_type and p.src = l.src and p.dst = c.item "
  "left join f_srcc s on s.activity_type = c.activity_type and s.src = l.src", **M5_CTES)

L_ = config.MAX_SEQUENCE_LENGTH
EVAL = f"""
    select e.activity_type, e.email, e.chunk, e.src, e.item,
      1.0 / (1 + count(*) filter (where u.cji > e.cjt or (u.cji = e.cjt and u.ci > e.ct))
             + (count(*) filter (where u.cji = e.cjt and u.ci = e.ct) - 1) / 2.0) as rr
    from (select s.*, coalesce(p.pair_count, 0) as cjt, coalesce(i.item_count, 0) as ct
          from (select t.activity_type, t.email, t.q // {L_} as chunk, t.item,
                  coalesce(p.item, 0) as src
                from ter t left join ter p on p.email = t.email and
                  p.activity_type = t.activity_type and p.q = t.q + 1 and p.q // {L_} = t.q // {L_}
                where t.q % {L_} = 0) s
          left join t_pairs p on p.activity_type = s.activity_type and p.src = s.src and p.dst = s.item
          left join t_icnt i on i.activity_type = s.activity_type and i.item = s.item) e
    join (select x.activity_type, x.item, x.src, coalesce(p.pair_count, 0) as cji,
            coalesce(i.item_count, 0) as ci
          from (select m.activity_type, r.item, s.src
                from (select activity_type, max(item) as mx from trr group by all) m,
                     unnest(range(0, m.mx + 1)) r(item),
                     (select distinct activity_type, src from (select t.activity_type,
                        coalesce(p.item, 0) as src from ter t left join ter p on p.email = t.email
                        and p.activity_type = t.activity_type and p.q = t.q + 1
                        and p.q // {L_} = t.q // {L_} where t.q % {L_} = 0) z) s
                where r.item <= m.mx and s.activity_type = m.activity_type) x
          left join t_pairs p on p.activity_type = x.activity_type and p.src = x.src and p.dst = x.item
          left join t_icnt i on i.activity_type = x.activity_type and i.item = x.item) u
      on u.activity_type = e.activity_type and u.src = e.src
    group by all"""
EVAL_CTES = dict(SPLIT_CTES, trr=ranked("select * from train"), ter=ranked("select * from test"),
                 **model_ctes("t_", "trr"), eval=EVAL)
q("m6_reciprocal_rank", "select activity_type, email, cast(chunk as integer) as chunk, src, item, "
  "round(rr, 6) as rr from eval", **EVAL_CTES)
q("a13_mean_reciprocal_rank", "select activity_type, round(avg(rr), 6) as mrr, count(*) as sequences "
  "from eval group by all", **EVAL_CTES)

# -------------------------------------------------------------- inventory ---
PUBLISH = f"'{config.INVENTORY_EVENT_TYPE}'"
INV_CTES = dict(
    inv_doc=f"select * from inventory_events where type = {PUBLISH} and id is not distinct from "
            f"(select id from inventory_events where type = {PUBLISH} order by id desc nulls first limit 1)",
    inv_ent="select e.sku as sku, coalesce(e.qty, 0) as qty, part * 1000 + pos as pos from "
            "(select part, unnest(from_json(event, "
            "'[{\"sku\":\"VARCHAR\",\"qty\":\"BIGINT\"}]')) as e, "
            "unnest(range(1, cast(json_array_length(event) as bigint) + 1)) as pos from inv_doc) x",
    inv="select sku, arg_max(qty, pos) as qty from inv_ent where qty > 0 group by sku",
    stocked=f"select distinct sku from inv where qty >= {config.INVENTORY_MIN}",
)
q("s3_latest_snapshot", "select id, part, type, cast(length(event) as integer) as event_chars from inv_doc",
  **INV_CTES)
q("s4_inventory_events", "select sku, qty from inv", **INV_CTES)
q("s4_inventory_upper_limit", "select sku, arg_max(qty, pos) as qty from inv_ent "
  "where qty > 0 and qty <= 3 group by sku", **INV_CTES)
q("s5_inventory_reply", "select sku, qty from (select sku, cast(json_extract(reply, '$.\"' || sku || "
  "'\".stock_level') as bigint) as qty from (select reply, unnest(json_keys(reply)) as sku "
  f"from inventory_reply) r) x where qty >= {config.INVENTORY_MIN}")
q("s12_variant_skus", "select identifier, product_variant_id, upc from dim_product_skus")
q("p17_stock_predicate", "select identifier, product_variant_id, upc from dim_product_skus "
  "where upc in (select sku from stocked)", **INV_CTES)

SALES = ("select {email} as email, sk.identifier, sk.product_variant_id, pv.category, "
         "f.order_date, sk.upc as sku from orders_fact f "
         "join dim_product_skus sk on f.sales_order_sku = sk.upc "
         "join dim_product_variants pv on sk.product_variant_id = pv.id")
q("j3_sales_star", "select email, identifier, product_variant_id, category, "
  "strftime(order_date, '%Y-%m-%d %H:%M:%S') as order_date, sku from sales",
  sales=SALES.format(email="f.billing_email"))


def latest(src: str) -> str:
    return ("select email, category as dept, identifier from (select *, row_number() over "
            "(partition by email, category order by order_date desc nulls first, sku desc) as rn "
            f"from ({src}) s) r where rn = 1")


q("a8_latest_sizes", latest("select * from sales"), sales=SALES.format(email="f.billing_email"))
q("w1_latest_row", latest("select * from sales"), sales=SALES.format(email="lower(f.billing_email)"))
DEPTS = ("select distinct product_style_code || '_' || group_code as activity, category as dept "
         "from dim_product_variants where category like '%Shoes'")
q("p10_category_suffix", "select activity, dept from depts", depts=DEPTS)
SIZES = ("select pv.product_style_code || '_' || pv.group_code as activity, "
         "pv.color_code as sksz_color_code, pv.id as pvid, sk.identifier, sk.upc, ap.active_flag "
         "from dim_product_variants pv join dim_product_skus sk on pv.id = sk.product_variant_id "
         "join active_products ap on sk.upc = ap.upc where sk.damage_level_id = 1")
q("j4_sku_sizes", "select * from sizes_all", sizes_all=SIZES)
q("p11_condition_filter", "select product_variant_id, upc, identifier from dim_product_skus "
  "where damage_level_id = 1")
FLAG = "cast(upc in (select sku from stocked) as integer)"
q("j18_existence_flag", f"select upc, {FLAG} as has_inventory from sizes_all",
  sizes_all=SIZES, **INV_CTES)


def share(src: str) -> str:
    return (f"select activity, sksz_color_code, sku, has_inventory, frac_of_color from ("
            "select activity, sksz_color_code, count(upc) as sku, "
            f"cast(sum({FLAG}) as bigint) as has_inventory, "
            f"cast(sum({FLAG}) as double) / count(upc) as frac_of_color "
            f"from ({src}) p group by all) g where frac_of_color >= {config.SIZE_THRESHOLD}")


q("a9_color_stock_share", "select activity, sksz_color_code, sku, has_inventory, "
  "round(frac_of_color, 6) as frac_of_color from (" + share("select * from sizes_all") + ") s",
  sizes_all=SIZES, **INV_CTES)

# Every user's predictions over the whole training window (clean colours).
ALLV = act_views(f"c.timestamp > {config.ms(config.TRAIN_START)}", COLOR)
PRED = ("(coalesce(p.pair_count, 0)::double + coalesce(i.item_count::double / t.total::double, 0.0)) "
        "/ (coalesce(s.src_count, 0)::double + 1.0::double)")
ALL_CTES = dict(
    train_views=ALLV, vocab=VOCAB, ar=ranked("select * from train_views"), **model_ctes("a_", "ar"),
    all_preds="select c.email, c.activity, c.activity_type, " + PRED + " as pred "
              "from (select distinct email, activity_type, activity, item from ar) c "
              "join (select email, activity_type, item as src from ar where q = 0) l "
              "  on c.email = l.email and c.activity_type = l.activity_type "
              "left join a_icnt i on i.activity_type = c.activity_type and i.item = c.item "
              "left join a_tot t on t.activity_type = c.activity_type "
              "left join a_pairs p on p.activity_type = c.activity_type and p.src = l.src "
              "  and p.dst = c.item "
              "left join a_srcc s on s.activity_type = c.activity_type and s.src = l.src",
    colors="select email, activity, list_sort(list(distinct color_code)) as color_code "
           "from train_views where activity_type = 'pid' and color_code is distinct from '' "
           "group by all",
    pid_preds="select p.email, p.activity, p.pred, c.color_code, 'pid' as activity_type "
              "from all_preds p left join colors c on p.email = c.email and p.activity = c.activity "
              "where p.activity_type = 'pid'",
    cat_preds="select email, activity, pred, cast(null as varchar[]) as color_code, "
              "'cgid' as activity_type from all_preds where activity_type = 'cgid' and activity in ("
              + ", ".join(f"'{c}'" for c in config.CATEGORIES_TO_SEND) + ")",
    mapped="select c.email, m.pid as activity, c.pred, cast(null as varchar[]) as color_code, "
           "'pid' as activity_type from cat_preds c join category_page_product_map m "
           "on c.activity = m.category",
    preds_in="select * from pid_preds union all select * from mapped",
    depts=DEPTS,
    sales=SALES.format(email="f.billing_email"),
    latest=latest("select * from sales where email in (select email from preds_in)"),
    sized="select p.*, d.dept, l.identifier from preds_in p left join depts d on p.activity = d.activity "
          "left join latest l on l.email = p.email and l.dept = d.dept",
    sizes_all=SIZES,
    sizes="select * from sizes_all where activity in (select activity from sized)",
    wanted="select distinct activity, identifier as want from sized",
    prods="select w.activity, w.want, s.sksz_color_code, s.pvid, s.identifier, s.upc, s.active_flag "
          "from wanted w join sizes s on w.activity = s.activity "
          "where w.want is null or w.want = s.identifier",
    share=share("select * from prods"),
    buyers="select b.*, s.sksz_color_code, s.pvid, s.upc, s.active_flag from sized b join sizes s "
           "on b.activity = s.activity and b.identifier = s.identifier "
           "where coalesce((b.color_code is null and s.active_flag = 'active') or "
           "list_contains(b.color_code, s.sksz_color_code), false) "
           "and s.upc in (select sku from stocked)",
    leads_all="select l.* exclude (identifier), s.sksz_color_code, s.pvid, s.identifier, s.upc, "
              "s.active_flag from sized l join sizes s on l.activity = s.activity "
              "where l.identifier is null",
    leads="select l.* from leads_all l join share h on l.activity = h.activity "
          "and l.sksz_color_code = h.sksz_color_code where coalesce((l.color_code is null and "
          "l.active_flag = 'active') or list_contains(l.color_code, l.sksz_color_code), false)",
    checked="select * from buyers union all by name select * from leads",
    best="select * exclude (rn) from (select *, row_number() over (partition by email order by "
         "pred desc nulls last, activity asc, upc asc nulls first, dept asc nulls first, "
         "identifier asc nulls first) as rn from "
         "(select * from checked union all by name select * from cat_preds) u) r where rn = 1",
    vfields="select variant_primary_image, product_id, product_name, color, material, "
            "color_code as pv_color_code, group_code, product_style_code, id as product_variant_id, "
            "retail_usd, factory_region, product_style_code || '_' || group_code as activity "
            "from dim_product_variants where product_style_code || '_' || group_code in "
            "(select activity from best where activity_type = 'pid')",
    **INV_CTES,
)


def txt(col: str) -> str:
    return f"array_to_string({col}, ',')"


q("a7_color_lists", f"select email, activity, {txt('color_code')} as color_code from colors",
  **ALL_CTES)
q("j13_color_join", f"select email, activity, round(pred, 6) as pred, {txt('color_code')} as color_code, "
  "activity_type from pid_preds", **ALL_CTES)
q("p15_category_allow_list", "select email, activity, round(pred, 6) as pred, activity_type "
  "from cat_preds", **ALL_CTES)
q("j12_category_to_product", "select email, activity, round(pred, 6) as pred, activity_type "
  "from mapped", **ALL_CTES)
q("j6_category_join", "select p.activity, p.email, round(p.pred, 6) as pred, p.activity_type, d.dept "
  "from preds_in p left join depts d on p.activity = d.activity", **ALL_CTES)
q("j7_latest_size_join", "select email, dept, activity, round(pred, 6) as pred, activity_type, "
  "identifier from sized", **ALL_CTES)
q("j8_optional_key_join", "select activity, want as wanted, sksz_color_code, pvid, identifier, upc, "
  "active_flag from prods", **ALL_CTES)
q("j9_buyer_sku_join", "select b.activity, b.identifier, b.email, b.dept, round(b.pred, 6) as pred, "
  f"{txt('b.color_code')} as color_code, b.activity_type, s.sksz_color_code, s.pvid, s.upc, "
  "s.active_flag from sized b join sizes s on b.activity = s.activity and b.identifier = s.identifier",
  **ALL_CTES)
q("j10_lead_sku_join", "select email, dept, activity, round(pred, 6) as pred, "
  f"{txt('color_code')} as color_code, activity_type, sksz_color_code, pvid, identifier, upc, "
  "active_flag from leads_all", **ALL_CTES)
q("p16_color_predicate", f"select l.email, l.activity, s.upc, {txt('l.color_code')} as color_code, "
  "s.active_flag, coalesce((l.color_code is null and s.active_flag = 'active') or "
  "list_contains(l.color_code, s.sksz_color_code), false) as ok "
  "from sized l join sizes s on l.activity = s.activity", **ALL_CTES)
q("j11_lead_share_join", "select email, dept, activity, round(pred, 6) as pred, "
  f"{txt('color_code')} as color_code, activity_type, sksz_color_code, pvid, identifier, upc, "
  "active_flag from leads", **ALL_CTES)
q("t5_check_inventory", "select email, activity, round(pred, 6) as pred, "
  f"{txt('color_code')} as color_code, activity_type, dept, identifier, sksz_color_code, pvid, "
  "upc, active_flag from checked", **ALL_CTES)
q("w2_best_per_user", "select email, activity, activity_type, round(pred, 6) as pred, upc, "
  "sksz_color_code from best", **ALL_CTES)
q("t6_recommend", "select b.email, b.activity, b.activity_type, round(b.pred, 6) as pred, b.upc, "
  "b.sksz_color_code, v.product_variant_id, v.product_name, round(v.retail_usd, 6) as retail_usd, "
  "v.factory_region from best b left join vfields v on b.activity = v.activity "
  "and b.sksz_color_code = v.pv_color_code", **ALL_CTES)
q("j14_variant_fields", "select variant_primary_image, product_id, product_name, color, material, "
  "pv_color_code, group_code, product_style_code, product_variant_id, round(retail_usd, 6) as "
  "retail_usd, factory_region, activity from vfields", **ALL_CTES)

# ----------------------------------------------------------------- outbox ---
ROLL256 = format(int((2 ** 256) * config.DEPLOYMENT_THRESHOLD), "064x")


def jlist(cond: str, item: str, order: str) -> str:
    return f"'[' || coalesce(string_agg({item}, ',' order by {order}) filter (where {cond}), '') || ']'"


PRED_ITEM = "'{\"activity\":\"' || activity || '\",\"pred\":' || printf('%.6f', pred) || '}'"
COLOR_ITEM = ("'{\"activity\":\"' || activity || '\",\"color_code\":' || case when len(color_code) = 0 "
              "then '[]' else '[\"' || array_to_string(color_code, '\",\"') || '\"]' end || '}'")
PLOG = ("select email, " + jlist("activity_type = 'pid'", PRED_ITEM, "activity, pred") + " as product_pred, "
        + jlist("activity_type = 'cgid'", PRED_ITEM, "activity, pred") + " as category_pred, "
        + jlist("activity_type = 'pid' and color_code is not null", COLOR_ITEM, "activity")
        + f" as color_codes, '{W.run_text}' as timestamp from "
        "(select * from pid_preds union all select * from cat_preds) u group by email")
q("a11_prediction_log", PLOG, **ALL_CTES)
q("l4_rollout_gate", f"select distinct email from email_uuids where sha256(email) <= '{ROLL256}'")

FULL = ("select b.*, v.product_variant_id, v.product_name, v.retail_usd, v.factory_region, "
        "v.variant_primary_image from best b left join vfields v on b.activity = v.activity "
        "and b.sksz_color_code = v.pv_color_code")
PAYLOAD = (f"select email, '{config.EVENT_NAME}' as event_name, case when activity_type = 'cgid' then activity "
           "end as category, round(pred, 6) as pred, "
           "case when activity_type = 'pid' then activity end as product_group_id, "
           "case when activity_type = 'pid' then product_name end as name, "
           "case when activity_type = 'pid' then cast(product_variant_id as varchar) end "
           "as product_variant_id, "
           "case when activity_type = 'pid' then sksz_color_code end as color_code, "
           "case when activity_type = 'pid' then variant_primary_image end as image_url, "
           "case when activity_type = 'pid' then '/' || activity || '.html#!/color/' || sksz_color_code "
           "end as url, case when activity_type = 'pid' then factory_region end as manufacturer_region, "
           "case when activity_type = 'pid' then printf('%.0f', round_even(retail_usd, 0)) end as price "
           "from full_rec")
q("l5_send_cap", "select email, activity, round(pred, 6) as pred from best "
  f"where sha256(email) <= '{ROLL256}' order by pred desc nulls last, email limit 50", **ALL_CTES)
q("s10_outbox", PAYLOAD + f" where sha256(email) <= '{ROLL256}'", full_rec=FULL, **ALL_CTES)
q("p22_payload_router", PAYLOAD, full_rec=FULL, **ALL_CTES)
q("s8_run_log", f"select strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') as last_run from ("
  f"select date_trunc('hour', timestamp) as timestamp from send_model_output "
  f"union all select {RUN_TS}) r")
q("s9_mark_sent", "select l.email, round(l.prob, 6) as prob, strftime(l.timestamp, '%Y-%m-%d %H:%M:%S') "
  "as timestamp, coalesce(d.sent, l.send_flag, false) as send_flag from score_log l left join "
  f"(select distinct email, {RUN_TS} as timestamp, true as sent from best "
  f"where sha256(email) <= '{ROLL256}') d on l.email = d.email and l.timestamp = d.timestamp",
  **dict(ALL_CTES, **REC_CTES))

# The run's own predictions (M5 over the chosen users) through T6.
T7_CTES = dict(ALL_CTES, **M5_CTES)
T7_CTES.update(
    all_preds="select c.email, c.activity, c.activity_type, " + PRED.replace("a_", "f_") + " as pred "
              "from (select distinct email, activity_type, activity, item from cr) c "
              "join (select email, activity_type, item as src from cr where q = 0) l "
              "  on c.email = l.email and c.activity_type = l.activity_type "
              "left join f_icnt i on i.activity_type = c.activity_type and i.item = c.item "
              "left join f_tot t on t.activity_type = c.activity_type "
              "left join f_pairs p on p.activity_type = c.activity_type and p.src = l.src "
              "  and p.dst = c.item "
              "left join f_srcc s on s.activity_type = c.activity_type and s.src = l.src",
    colors="select email, activity, list_sort(list(distinct color_code)) as color_code "
           "from chosen where activity_type = 'pid' and color_code is distinct from '' group by all",
    full_rec=FULL,
)
q("t7_run_scoring", PAYLOAD + f" where sha256(email) <= '{ROLL256}'", **T7_CTES)
q("t8_run_training", f"select 'seq_' || activity_type || '_model{W.run_ms // 1000}' as name, "
  "activity_type, round(avg(rr), 6) as mrr, count(*) as sequences from eval group by all",
  **EVAL_CTES)
SQL["s11_model_round_trip"] = SQL["m4_affinity_fit"]

# unbroken next-item counts of the clicks before the run
q("t8_continued_training",
  "select p.activity_type, p.src as src_activity, p.dst as dst_activity, p.pair_count, s.src_count, "
  "round((p.pair_count + 1.0 * i.item_count / t.total) / (s.src_count + 1.0), 6) as prob "
  "from u_pairs p join u_srcc s on p.activity_type = s.activity_type and p.src = s.src "
  "join u_icnt i on i.activity_type = p.activity_type and i.activity = p.dst "
  "join u_tot t on t.activity_type = p.activity_type",
  u_views=act_views(f"c.timestamp > {config.ms(config.TRAIN_START)} and c.timestamp < {W.run_ms}", COLOR_RAW),
  u_icnt="select activity_type, activity, count(*) as item_count from u_views group by all",
  u_tot="select activity_type, cast(sum(item_count) as bigint) as total from u_icnt group by all",
  u_pairs="select activity_type, src, dst, count(*) as pair_count from (select activity_type, activity as dst, "
          "lag(activity) over (partition by email, activity_type order by sec, session_id, activity) as src "
          "from u_views) l where src is not null group by all",
  u_srcc="select activity_type, src, cast(sum(pair_count) as bigint) as src_count from u_pairs group by all")

# ---------------------------------------------------------------- catalog ---
q("s2_resolve_table", "select billing_email, order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') "
  "as order_date, sales_order_sku from orders_fact")
q("s13_active_styles", "select distinct cast(pvid as integer) as pvid from active_products "
  "where active_flag = 'active'")
q("s14_product_catalog", "select id, replace(product_name, '  ', ' ') as product_name, material, color, "
  "product_style_code || '_' || group_code as product_group_code, color_code, edition_code, "
  "product_style_code, round(retail_usd, 6) as retail_usd, factory_region, filter_color, "
  "variant_primary_image, group_code, coalesce(json_extract_string(group_creative, '$.shortDescription'), "
  "'') as short_desc, cast(year(plan_date) as integer) as launch_year, id as pvid "
  "from dim_product_variants where category = 'Shoes'")
SHOES = ("select lower(f.billing_email) as email, sk.identifier, sk.product_variant_id, pv.category, "
         "f.order_date from orders_fact f join dim_product_skus sk on sk.upc = f.sales_order_sku "
         "join dim_product_variants pv on pv.id = sk.product_variant_id where pv.category = 'Shoes'")
q("a10_loyal_shoppers", "select email, identifier, product_variant_id, category, "
  "strftime(order_date, '%Y-%m-%d %H:%M:%S') as order_date from shoes where email in "
  f"(select email from shoes where email is not null group by email "
  f"having count(product_variant_id) > {config.MIN_SHOE_UNITS})", shoes=SHOES)
TOKEN = "nullif(regexp_extract(c.query_string, 'pid=([0-9_]+).*', 1), '')"
COLOR_RE = "nullif(regexp_extract(c.url, 'color/([0-9]+)', 1), '')"
q("j15_viewed_variants", f"select pv.id as product_variant_id, substring({TOKEN}, 1, 7) as "
  f"product_style_code, nullif(regexp_extract(c.query_string, 'pid=([0-9]+).*', 1), '') as pv2, "
  f"substring({TOKEN}, 9, 10) as group_code, {COLOR_RE} as color_code, c.query_string, c.user_uuid, "
  "c.timestamp, c.session_id, c.host, pv.category, pv.product_name "
  "from clickstream_page_views c join dim_product_variants pv on "
  f"substring({TOKEN}, 1, 7) = pv.product_style_code and substring({TOKEN}, 9, 10) = pv.group_code "
  f"and {COLOR_RE} = pv.color_code")
q("p20_columns", "select id as product_variant_id, product_name, category, 'catalogue' as source "
  "from dim_product_variants")
q("a12_distinct_rows", f"select distinct {ACT} as activity, {ACT_TYPE} as activity_type "
  f"from clickstream_page_views where {PDP} <> '' or {CAT} <> ''")
q("l1_global_sort", "select * from browse order by email", browse=BROWSE, single_email=SINGLE)

# ---------------------------------------------------------------- scalars ---
q("f_string", "select id, split_part(product_name, ' ', 2) as second_word, "
  "regexp_replace(product_name, '[^0-9]+', '') as first_match, "
  "nullif(regexp_extract(product_name, '([a-z]+)$', 1), '') as last_word, "
  "substring(product_name, 1, 7) as prefix7, lower(material) as material_lower, "
  "replace(product_name, '  ', ' ') as name_clean, product_style_code || '_' || group_code as group_key, "
  "product_style_code || '_' || group_creative as concat_null, "
  "concat(product_style_code, group_creative) as concat_skip, category like '%Shoes' as is_shoes "
  "from dim_product_variants")
q("f_time", "select user_uuid, timestamp, strftime(to_timestamp(timestamp // 1000)::timestamp, "
  "'%Y-%m-%d %H:%M:%S') as activity_dt, strftime(date_trunc('day', to_timestamp(timestamp // 1000)"
  "::timestamp), '%Y-%m-%d %H:%M:%S') as day, "
  f"epoch({RUN_TS})::bigint - timestamp // 1000 as epoch_gap, "
  "cast(year(to_timestamp(timestamp // 1000)::timestamp) as integer) as year, "
  f"date_sub('day', to_timestamp(timestamp // 1000)::timestamp, {RUN_TS}) as days, "
  f"strftime({RUN_TS} - interval '5 days 2 hours', '%Y-%m-%d %H:%M:%S') as window_start "
  "from clickstream_page_views")
q("f_json", "select id, json_extract_string(group_creative, '$.shortDescription') as short_desc, "
  "'{\"id\":' || cast(id as varchar) || ',\"color_code\":\"' || color_code || '\"}' as as_json "
  "from dim_product_variants")
q("f_hash", f"select distinct email, sha256(email) as sha256, md5('{config.SAMPLE_SEED}' || email) "
  f"as sample_hash, sha256(email) <= '{ROLL256}' as in_rollout from email_uuids")

# -------------------------------------------------------------- streaming ---
SQL["r1_landed_page_views"] = SQL["s1_scan"]
q("r2_hourly_partials", 'select email, time_since_browse, cgid_count, pdp_count, "count" from browse',
  browse=BROWSE, single_email=SINGLE)
SQL["m7_model_record"] = SQL["t8_run_training"]

# ------------------------------------------------------ small named rules ---
q("p18_nonblank_filter", "select email, activity, color_code from score_views "
  "where activity_type = 'pid' and color_code is distinct from ''", score_views=SCORE_VIEWS)
q("p21_group_key", "select id, product_style_code || '_' || group_code as activity "
  "from dim_product_variants")
q("a2_conditional_count", f"select eu.email, count(case when {CAT} <> '' then c.timestamp end) as "
  f"cgid_count, count(case when {PDP} <> '' then c.timestamp end) as pdp_count "
  "from clickstream_page_views c join email_uuids eu on c.user_uuid = eu.uuid group by eu.email")
q("l2_top1", "select billing_email, order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') as order_date, "
  "sales_order_sku from orders_fact order by order_date desc nulls first, order_id desc, "
  "sales_order_sku desc limit 1")
SQL["r1_hourly_run"] = SQL["t8_trained_then_scored"] = SQL["t7_run_scoring"]
q("m2_fit_scaler", " union all ".join(
    f"select '{n}' as feature, round(avg(\"{n}\"), 6) as mean, "
    f"round(case when stddev_pop(\"{n}\") = 0 then 1.0 else stddev_pop(\"{n}\") end, 6) as scale "
    "from feats" for n in config.SEND_FEATURES), **FEAT_CTES)
q("s7_prediction_log", PLOG, **T7_CTES)
