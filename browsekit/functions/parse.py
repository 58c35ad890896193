"""

All of these return Columns built from Spark built-ins, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def part(c, delim: str, n: int) -> Column:
    """PostgreSQL ``split_part`` (literal delimiter, '' past the end)."""
    return F.split_part(_c(c), F.lit(delim), F.lit(n))


# -- P1/P2: activity and its type --------------------------------------------
def category_key(qs="query_string") -> Column:
    """Category id: text after ``cgid=`` up to ``&``."""
    return part(part(qs, "cgid=", 2), "&", 1)


def product_key(qs="query_string") -> Column:
    """Product id: text after ``pid=`` up to ``&``, then up to ``?``."""
    return part(part(part(qs, "pid=", 2), "&", 1), "?", 1)


def activity(qs="query_string") -> Column:
    """Category wins when both keys are present."""
    return F.when(category_key(qs) != "", category_key(qs)).otherwise(product_key(qs))


def activity_type(qs="query_string") -> Column:
    return F.when(category_key(qs) != "", F.lit("cgid")).otherwise(F.lit("pid"))


def has_activity(qs="query_string") -> Column:
    """P5: a product or a category key is present (NULL input -> NULL, dropped)."""
    return (product_key(qs) != "") | (category_key(qs) != "")


# -- P3/P4: colour code from the URL ------------------------------------------
def color_raw(url="url") -> Column:
    """Text after ``/color/`` cut at ``/ ? &`` and at ``http``."""
    return part(part(part(part(part(url, "/color/", 2), "/", 1), "?", 1), "&", 1), "http", 1)


def first_match_drop_nondigits(c) -> Column:
    """PostgreSQL ``regexp_replace(x, '[^0-9]+', '')`` without the ``g`` flag:
    only the first non-digit run goes (Spark replaces every match)."""
    return F.regexp_replace(_c(c), r"^([0-9]*)[^0-9]+", "$1")


def color_clean(url="url") -> Column:
    return first_match_drop_nondigits(color_raw(url))


# -- F3: substring(x from re) -------------------------------------------------
def regex_group_or_null(c, pattern: str, group: int = 1) -> Column:
    """``substring(x from re)``: NULL when nothing matches (Spark gives '')."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


# -- P21/F7: product-group key --------------------------------------------------
def group_key(style="product_style_code", group="group_code") -> Column:
    """``style || '_' || group`` -- NULL in, NULL out (not ``concat_ws``)."""
    return F.concat(_c(style), F.lit("_"), _c(group))


# -- F10-F15: time ------------------------------------------------------------
def epoch_ms_to_ts(c="timestamp") -> Column:
    """``to_timestamp(ms / 1000)`` with integer division: whole seconds."""
    return F.timestamp_seconds(F.floor(_c(c) / 1000))


def ms_of(ts) -> Column:
    """Epoch milliseconds of a timestamp column (session zone UTC)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


# -- F23 / L4: rollout hash; equal-length hex text orders like the number -----------
def rollout_limit(bits: int = 224, share: float = 0.9) -> str:
    """``2**bits * share`` (computed in floating point, as the gate's
    definition does) as ``bits/4`` lower-case hex digits."""
    top = 2 ** bits - 1   # a share of 1 or more admits every hash
    return format(min(int((2 ** bits) * share), top), f"0{bits // 4}x")


def in_rollout(email="email", bits: int = 224, share: float = 0.9) -> Column:
    """sha-``bits`` of the email, as an integer, at most 2**bits * share."""
    limit = rollout_limit(bits, share)
    return F.sha2(_c(email), bits) <= F.lit(limit)
