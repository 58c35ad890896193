"""Who gets a reminder (S6, P9, A5, A6, P12, L3 -> T2)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import RunWindow
from .ranking import hash_sample, sample_hash


def score_log_rows(scores: DataFrame, win: RunWindow) -> DataFrame:
    """This run's rows for the score log: ``(email, prob, timestamp, send_flag)``."""
    return scores.select("email", F.col("send_pred").alias("prob"),
                         F.lit(win.run_text).cast("timestamp").alias("timestamp"),
                         F.lit(False).alias("send_flag"))


def trailing(log: DataFrame, win: RunWindow, hours: int = config.RESEND_BLOCK_HOURS) -> DataFrame:
    """``timestamp >= run - hours`` with no upper bound."""
    lo = win.run - timedelta(hours=hours)
    if "run_date" in log.columns:   # a log partitioned by day: older days are never opened
        log = log.where(F.col("run_date") >= F.lit(lo.strftime("%Y-%m-%d")).cast("date"))
    return log.where(F.col("timestamp") >= F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))


def sent_in_window(log: DataFrame, win: RunWindow,
                   hours: int = config.RESEND_BLOCK_HOURS) -> DataFrame:
    """A5: ``sent`` = 1 when any log row in the window has ``send_flag``.

    ``bool_or`` combines map-side, so a user with many log rows costs one
    partial row per task.  All-NULL flags give 0, as in the reference.
    """
    return (trailing(log, win, hours).groupBy("email")
            .agg(F.when(F.bool_or("send_flag"), 1).otherwise(0).alias("sent")))


def eligible(log: DataFrame, win: RunWindow,
             hours: int = config.RESEND_BLOCK_HOURS) -> DataFrame:
    """Emails with a log row in the window and ``sent`` = 0."""
    return sent_in_window(log, win, hours).where(F.col("sent") == 0).select("email")


def threshold_bands(scores: DataFrame, threshold: float = config.SEND_THRESHOLD) -> DataFrame:
    """``over`` / ``under`` the threshold; a NULL score is in neither."""
    p = F.col("send_pred")
    return (scores.withColumn("band", F.when(p >= threshold, "over")
                              .when(p < threshold, "under"))
            .where(F.col("band").isNotNull()))


def fraction_sample(df: DataFrame, fraction: float, key: str = "email",
                    seed: str = config.SAMPLE_SEED, exact: bool = True) -> DataFrame:
    """L3: exactly ``round_half_even(fraction * n)`` rows, first in hash order.

    No global sort: rows are ranked through 65,536 hash-prefix buckets
    (see ``ranking``), so the only single-task step is a running sum over
    at most 65,536 bucket counts.  ``exact=False`` keeps each row whose
    hash falls in the first ``fraction`` of the hash space: no ranking and
    no count, about ``fraction * n`` rows, the same rows on every run.
    """
    if not exact:
        h = F.conv(F.substring(sample_hash(seed, F.col(key)), 1, 8), 16, 10).cast("long")
        return df.where(h < F.lit(int(fraction * 16 ** 8)))
    return hash_sample(df, key, seed, lambda n: F.bround(F.lit(float(fraction)) * n))


def select_recipients(scores: DataFrame, log: DataFrame, win: RunWindow,
                      threshold: float = config.SEND_THRESHOLD,
                      fraction: float = config.FRACTION_SEND,
                      hours: int = config.RESEND_BLOCK_HOURS) -> DataFrame:
    """Everyone at or over the threshold plus a sample of those under it,
    all restricted to users not mailed in the resend window.

    ``log`` must already hold this run's rows (S6), as the reference writes
    them before reading the log back.
    """
    ok = scores.join(eligible(log, win, hours), "email", "left_semi")
    banded = threshold_bands(ok, threshold)
    over = banded.where(F.col("band") == "over").select("email")
    under = fraction_sample(banded.where(F.col("band") == "under"), fraction).select("email")
    return over.unionByName(under)
