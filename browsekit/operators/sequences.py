"""Item sequences per user (P1-P5, P13, P14, M1, W3, W4, J16, J17, U2 -> T3, T4).

Page views become ``(email, session_id, activity_dt, activity,
activity_type, color_code)`` rows; activities are numbered with a sorted
vocabulary (0..n-1, item id = index + 1 so 0 can pad); each user's items,
in time order, are cut into windows of ``length`` items ending at the newest
view and stepping back by ``step``, left-padded with 0.

Nothing here ranks a whole user inside one task: positions come from
``rank_in_group`` over minute buckets, and each output window collects at
most ``length`` items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import RunWindow
from ..functions import parse
from .features import host_filter, window_filter
from .identity import attach_email
from ..session import materialize
from .ranking import dense_index, hash_sample, rank_in_group

ORDER = ("activity_dt", "session_id", "activity")
TYPES = ("pid", "cgid")


def activity_views(views: DataFrame, identity: DataFrame, hosts=config.HOSTS,
                   clean_color: bool = True) -> DataFrame:
    """P1-P6 + J1: parsed activity rows with the viewer's email.

    ``clean_color`` applies the scoring job's first-match digit cleanup (P3);
    training keeps the raw colour text (P4).
    """
    v = host_filter(views, hosts).where(parse.has_activity())
    color = parse.color_clean() if clean_color else parse.color_raw()
    v = v.select("user_uuid", "session_id", "timestamp",
                 parse.epoch_ms_to_ts().alias("activity_dt"),
                 F.date_trunc("day", parse.epoch_ms_to_ts()).alias("day"),
                 parse.activity().alias("activity"),
                 parse.activity_type().alias("activity_type"),
                 color.alias("color_code"))
    return attach_email(v, identity).drop("user_uuid")


def training_views(tables, start, hosts=config.HOSTS, until=None) -> DataFrame:
    """Training rows: every view strictly after ``start`` (P8) and before ``until``, if given; raw colour."""
    lo, hi = config.ms(start), config.ms(until) if until is not None else None
    views = window_filter(tables.page_views(lo, hi, strict_lo=True), lo, hi, strict_lo=True)
    return activity_views(views, tables.email_uuids(), hosts, clean_color=False)


def scoring_views(tables, win: RunWindow) -> DataFrame:
    """Sequence-window rows of one run: ``[last_run - 9 h, run - 2 h)``."""
    views = window_filter(tables.page_views(win.seq_lo, win.seq_hi), win.seq_lo, win.seq_hi)
    return activity_views(views, tables.email_uuids(), win.hosts, clean_color=True)


# -- M1: vocabulary ------------------------------------------------------------
def fit_vocabulary(df: DataFrame, col: str = "activity") -> DataFrame:
    """M1 fit: ``(activity, idx)``, idx = position in sorted distinct order."""
    return dense_index(df, col, "idx")


def encode(df: DataFrame, vocab: DataFrame, col: str = "activity",
           item_col: str = "item") -> DataFrame:
    """M1 transform: item id = vocabulary index + 1 (0 is padding).

    An inner join: rows with an activity outside the vocabulary go, which
    is what the callers ensure beforehand (P13) since the reference's
    encoder raises on unseen labels.
    """
    v = vocab.select(F.col(col).alias("_act"), (F.col("idx") + 1).alias(item_col))
    return df.join(v, df[col] == v["_act"]).drop("_act")


def transform(df: DataFrame, vocab: DataFrame, col: str = "activity",
              item_col: str = "item") -> DataFrame:
    """M1 transform as the reference's encoder does it: an activity outside the vocabulary
    (or none) fails the query and is named in the error, instead of losing its rows."""
    v = vocab.select(F.col(col).alias("_act"), (F.col("idx") + 1).alias("_item"))
    unseen = F.concat(F.lit("label outside the vocabulary: "), F.coalesce(F.col(col), F.lit("null")))
    item = F.when(F.col("_item").isNotNull(), F.col("_item")).otherwise(F.raise_error(unseen).cast("int"))
    return df.join(v, df[col] == v["_act"], "left").withColumn(item_col, item).drop("_act", "_item")


def grow_vocabulary(vocab: DataFrame, df: DataFrame, col: str = "activity") -> DataFrame:
    """M1 fit on top of an earlier fit: old activities keep their index, new ones follow in sorted
    order, so models and sequences of the earlier vocabulary stay valid."""
    old = materialize(vocab.select(col, "idx"))
    top = old.agg(F.max("idx")).first()[0]
    new = df.select(col).join(old.select(col), col, "left_anti")
    first = 0 if top is None else top + 1
    return old.unionByName(dense_index(new, col, "_new").select(col, (F.col("_new") + first).cast("int").alias("idx")))


def known_vocabulary(df: DataFrame, vocab: DataFrame, col: str = "activity") -> DataFrame:
    """Keep rows whose activity the vocabulary knows (semi join)."""
    return df.join(vocab.select(F.col(col).alias("_act")), df[col] == F.col("_act"),
                   "left_semi")


# -- W3: sequences -------------------------------------------------------------
def minute(c: Column) -> Column:
    """Epoch minute of a time: the bucket that ranks and neighbours are found in."""
    return F.floor(F.unix_seconds(c) / 60)


def to_sequences(df: DataFrame, group_cols: Sequence[str] = ("email", "activity_type"),
                 item_col: str = "item", order: Sequence[str] = ORDER,
                 length: int = config.MAX_SEQUENCE_LENGTH,
                 step: int = config.SEQUENCE_STEP) -> DataFrame:
    """``(group..., chunk, items)``; chunk 0 ends at the newest item.

    A row ``q`` places from the newest end (0-based) lies in every window
    ``k`` with ``k*step <= q < k*step + length``: at most
    ``ceil(length/step)`` windows, so rows are replicated a bounded number
    of times and each window is one small ``collect_list``.
    """
    g = list(group_cols)
    ranked = rank_in_group(df.select(*g, item_col, *order), g, minute(F.col(order[0])),
                           [F.col(c) for c in order])
    q = F.col("_total") - F.col("_rank")
    k_hi = F.floor(q / step)
    k_lo = F.greatest(F.lit(0), F.ceil((q - length + 1) / step))
    # step > length leaves gaps: a row between windows belongs to none
    windows = F.when(k_lo <= k_hi, F.sequence(k_lo.cast("int"), k_hi.cast("int")))
    per_window = ranked.select(*g, item_col, q.alias("_q"), F.explode(windows).alias("chunk"))
    items = F.transform(F.array_sort(F.collect_list(F.struct(
        (-F.col("_q")).alias("o"), F.col(item_col).alias("v")))), lambda s: s["v"])
    seqs = per_window.groupBy(*g, "chunk").agg(items.alias("_items"))
    pad = F.array_repeat(F.lit(0), F.lit(length) - F.size("_items"))
    return seqs.select(*g, "chunk", F.concat(pad, F.col("_items")).alias("items"))


# -- W4 / T4: sampled test sessions ---------------------------------------------
def session_sample(df: DataFrame, fraction: float = config.SESSION_SAMPLE_FRACTION,
                   min_sessions: int = config.SESSION_SAMPLE_MIN,
                   seed: str = config.SAMPLE_SEED, by: Sequence[str] = ()) -> DataFrame:
    """Per email (and ``by``), ``round_half_even(fraction*n)`` of its n
    sessions when ``n >= min_sessions``, else one; first in
    ``md5(seed || session_id)`` order."""
    g = [*by, "email"]
    sessions = df.select(*g, "session_id").distinct()

    def take(n: Column) -> Column:
        return F.when(n >= min_sessions, F.bround(F.lit(float(fraction)) * n)).otherwise(F.lit(1))

    return hash_sample(sessions, "session_id", seed, take, group_cols=g)


def train_test_split(df: DataFrame, seed: str = config.SAMPLE_SEED,
                     by: Sequence[str] = ("activity_type",)) -> dict[str, DataFrame]:
    """T4: test = rows of sampled sessions; train = the other rows whose
    activity occurs in test (J16/J17); test then keeps activities seen in
    train (U2).  Also returns ``full``, every row.

    The reference splits one activity type at a time; ``by`` does every
    type in one pass: one left join marks the sampled rows, written once.
    """
    b = list(by)
    picked = session_sample(df, seed=seed, by=b).select(*b, "session_id").distinct()
    marked = materialize(df.join(picked.withColumn("_test", F.lit(True)), [*b, "session_id"], "left")
                         .withColumn("_test", F.coalesce("_test", F.lit(False))))
    # per activity (catalogue-sized): does it occur in test, does it occur in train?  Train
    # rows must have an activity that test has, so an activity stays in test exactly if it
    # occurs on both sides.
    sides = (marked.groupBy(*b, "activity")
             .agg(F.bool_or("_test").alias("_in_test"), F.bool_or(~F.col("_test")).alias("_in_train"))
             .where("_in_test and _in_train").select(*b, "activity"))
    both = marked.join(sides, [*b, "activity"], "left_semi")
    return {"train": both.where(~F.col("_test")).drop("_test"),
            "test": both.where("_test").drop("_test"), "full": df}


# -- T3 ------------------------------------------------------------------------
def activity_sequences(rows: DataFrame, users: DataFrame, vocab: DataFrame) -> dict[str, DataFrame]:
    """Sequences of the chosen users, per activity type.

    ``rows`` are the run's scoring views, ``users`` a one-column ``email``
    frame (T2's output), ``vocab`` the trained vocabulary.  Returns the
    encoded rows (``views``), the padded ``sequences`` with an
    ``activity_type`` column (P14 keeps both types in one frame), and the
    ``(email, activity, color_code)`` rows per type used downstream.
    """
    chosen = rows.join(users.select("email").distinct(), "email", "left_semi")
    # encoding is an inner join with the vocabulary, so it also drops unknown activities
    encoded = materialize(encode(chosen, vocab))
    seqs = materialize(to_sequences(encoded))
    return {
        "views": encoded,
        "sequences": seqs,
        "pid_rows": encoded.where(F.col("activity_type") == "pid")
                           .select("email", "activity", "color_code"),
        "cgid_rows": encoded.where(F.col("activity_type") == "cgid")
                            .select("email", "activity", "color_code"),
    }
