"""Click <-> identity joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def emails_per_uuid(identity: DataFrame) -> DataFrame:
    """A3: distinct emails per uuid.

    Two-level count (distinct pairs first, then rows per uuid) so a uuid with
    a huge number of rows is spread over the first shuffle and collapses to
    one partial row per task before the second.
    """
    return (identity.select("uuid", "email").where(F.col("email").isNotNull()).distinct()
            .groupBy("uuid").agg(F.count(F.lit(1)).alias("count_emails")))


def single_email_uuids(identity: DataFrame) -> DataFrame:
    """J2 key set: uuids with exactly one distinct email (HAVING = 1)."""
    return emails_per_uuid(identity).where(F.col("count_emails") == 1).select("uuid")


def restrict_single_email(identity: DataFrame) -> DataFrame:
    """Identity rows whose uuid maps to exactly one email (semi join)."""
    return identity.join(single_email_uuids(identity), "uuid", "left_semi")


def attach_email(clicks: DataFrame, identity: DataFrame,
                 uuid_col: str = "user_uuid") -> DataFrame:
    """Inner equi join click -> email on uuid.

    Duplicate identity rows multiply clicks, as in the reference.  The join
    strategy is left to AQE: the identity side is broadcast at run time when
    its measured size is under the threshold, otherwise sort-merge with the
    skew-join split for a hot uuid.
    """
    ids = identity.select(F.col("uuid").alias("_uuid"), "email")
    return clicks.join(ids, clicks[uuid_col] == ids["_uuid"], "inner").drop("_uuid")
