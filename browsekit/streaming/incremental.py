"""Incremental forms of the hourly run.

R1 lands new page views with a file-source stream (``availableNow`` each
hour, exactly-once file sink, checkpointed progress), so the hourly batch
reads only a partitioned table instead of rescanning raw events.  ``hourly_unit`` joins landing
and scoring in one ``foreachBatch`` that a restart finishes or repeats as a whole.

R2 keeps the send features' mergeable parts -- last view, category and
product view counts -- as hourly partials per email under a 2-hour
watermark (the reference ends every window 2 h before the run for late
rows).  A run then sums the 122 hourly partials of its window instead of
rescanning 5 days of clicks.  Each row lands in exactly one hour, so no
row is replicated across overlapping windows.  One stream does it
(``hourly_features``): its state is first one row per (email, timestamp), then one per
(email, hour), so the distinct-timestamp count is the number of first-level rows; since a
timestamp lies in one hour, the hourly distinct counts add up exactly.  Its two parts
are also there as streams of their own (``hourly_partials``, ``hourly_distinct_views``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..config import RunWindow
from ..functions import parse
from ..operators.features import host_filter
from ..session import materialize, path_exists, read_file, replace_file
from ..operators.identity import attach_email, restrict_single_email
from ..sources.fixtures import derive_page_views

HOUR_MS = 3_600_000
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw events as a stream over the parquet files under ``path``."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def land_page_views(clicks: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a click stream to a parquet table partitioned by view date
    (file sink: exactly once).  ``clicks`` is any stream of page views; for the fixtures,
    ``derive_page_views(event_stream(...))``."""
    clicks = clicks.withColumn("view_date", F.to_date(F.timestamp_millis("timestamp")))
    return (clicks.writeStream.format("parquet").outputMode("append")
            .option("path", out_path).option("checkpointLocation", checkpoint)
            .partitionBy("view_date").trigger(availableNow=True).start())


def hourly_partials(clicks: DataFrame, identity: DataFrame, hosts=config.HOSTS,
                    lateness: str = "2 hours") -> DataFrame:
    """R2: per (email, hour): last view (ms), category views, product views.

    ``clicks`` may be a stream; ``identity`` is static (stream-static join
    to the single-email uuids, J1 + J2)."""
    c = host_filter(clicks, hosts).select(
        "user_uuid", "timestamp",
        F.timestamp_millis("timestamp").alias("event_time"),
        (parse.category_key() != "").alias("_is_cat"),
        (parse.product_key() != "").alias("_is_pdp"))
    joined = attach_email(c, restrict_single_email(identity))
    return (joined.withWatermark("event_time", lateness)
            .groupBy("email", F.window("event_time", "1 hour").alias("w"))
            .agg(F.max("timestamp").alias("last_ms"),
                 F.count_if(F.col("_is_cat")).alias("cgid_count"),
                 F.count_if(F.col("_is_pdp")).alias("pdp_count"),
                 F.count(F.lit(1)).alias("views"))
            .select("email", F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"),
                    "last_ms", "cgid_count", "pdp_count", "views"))


def hourly_distinct_views(clicks: DataFrame, identity: DataFrame, hosts=config.HOSTS,
                          lateness: str = "2 hours") -> DataFrame:
    """R2, distinct part: per (email, hour) the number of distinct view
    timestamps.  Rows are deduplicated on (email, timestamp) under the
    watermark, then counted per hour; a timestamp lies in exactly one hour,
    so summing hours gives the exact distinct count of any hour-aligned
    window."""
    c = host_filter(clicks, hosts).select(
        "user_uuid", "timestamp", F.timestamp_millis("timestamp").alias("event_time"))
    joined = attach_email(c, restrict_single_email(identity))
    return (joined.withWatermark("event_time", lateness)
            .dropDuplicates(["email", "timestamp", "event_time"])
            .groupBy("email", F.window("event_time", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("distinct_views"))
            .select("email", F.col("w.start").alias("hour_start"),
                    F.col("w.end").alias("hour_end"), "distinct_views"))


def hourly_features(clicks: DataFrame, identity: DataFrame, hosts=config.HOSTS,
                    lateness: str = "2 hours", salts: int = 8) -> DataFrame:
    """R2 in one pass over the clicks: per (email, hour) the last view (ms), category views, product
    views, views and distinct view timestamps.

    Two chained aggregations under one watermark.  The first keeps one row per (email,
    timestamp), so a hot email is spread over its timestamps; the second receives what the watermark
    has closed.  Both drop a row from their state once its hour is ``lateness`` old.

    A stateful query runs without adaptive skew splitting, so the join to the identity map is
    salted: a uuid's clicks go to ``salts`` tasks by a hash of the click, and each of
    its (few) identity rows to all of them.
    """
    return _hourly_features(clicks, restrict_single_email(identity), hosts, lateness, salts)


def _hourly_features(clicks: DataFrame, single: DataFrame, hosts=config.HOSTS,
                     lateness: str = "2 hours", salts: int = 8) -> DataFrame:
    """``hourly_features`` on identity rows that are restricted to single-email uuids already."""
    c = host_filter(clicks, hosts).select(
        "user_uuid", "timestamp",
        F.timestamp_millis("timestamp").alias("event_time"),
        (parse.category_key() != "").alias("_is_cat"),
        (parse.product_key() != "").alias("_is_pdp"),
        F.pmod(F.xxhash64("timestamp", "query_string"), F.lit(salts)).cast("int").alias("_salt"))
    ids = single.select(
        F.col("uuid").alias("user_uuid"), "email",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    per_time = (c.join(ids, ["user_uuid", "_salt"]).withWatermark("event_time", lateness)
                .groupBy("email", "timestamp", F.window("event_time", "1 hour").alias("_w"))
                .agg(F.count_if("_is_cat").alias("_cat"), F.count_if("_is_pdp").alias("_pdp"),
                     F.count(F.lit(1)).alias("_views")))
    return (per_time.groupBy("email", F.window(F.window_time("_w"), "1 hour").alias("w"))
            .agg(F.max("timestamp").alias("last_ms"), F.sum("_cat").alias("cgid_count"),
                 F.sum("_pdp").alias("pdp_count"), F.sum("_views").alias("views"),
                 F.count(F.lit(1)).alias("distinct_views"))
            .select("email", F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"),
                    "last_ms", "cgid_count", "pdp_count", "views", "distinct_views"))


def _start(df: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    return (df.writeStream.format("parquet").outputMode("append")
            .option("path", out_path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def start_hourly_features(clicks: DataFrame, identity: DataFrame,
                          out_path: str, checkpoint: str) -> StreamingQuery:
    """Run R2 once over the available part of a click stream (``availableNow``), appending closed
    hours to one parquet table that serves as partials and as distinct counts.

    The static side of a stream is computed anew in every micro-batch, also in the last one,
    which has no clicks and only closes hours.  So the single-email identity is written once,
    as it is when the run starts, and the batches read that table."""
    return _start(_hourly_features(clicks, materialize(restrict_single_email(identity))), out_path, checkpoint)


def start_hourly_partials(clicks: DataFrame, identity: DataFrame,
                          out_path: str, checkpoint: str) -> StreamingQuery:
    """Run R2 once over the available part of a click stream (``availableNow``), appending
    finalized hours to a parquet table."""
    return _start(hourly_partials(clicks, identity), out_path, checkpoint)


def start_hourly_distinct(clicks: DataFrame, identity: DataFrame,
                          out_path: str, checkpoint: str) -> StreamingQuery:
    """The distinct-timestamp partials as their own availableNow stream."""
    return _start(hourly_distinct_views(clicks, identity), out_path, checkpoint)


def features_from_partials(partials: DataFrame, win: RunWindow,
                           distinct: DataFrame | None = None) -> DataFrame:
    """Sum the hourly partials inside ``[send_lo, send_hi)`` and apply the
    recency gate: the A1 columns, with ``count`` (distinct view timestamps)
    when the distinct partials are given or ``partials`` come from ``hourly_features``.  Partials are whole hours, so a window
    whose bounds are not raises; ``edges_from_views`` gives the partials of its
    broken first and last hour."""
    if win.send_lo % HOUR_MS or win.send_hi % HOUR_MS:
        raise ValueError("hourly partials need a run on the full hour; see features_at")
    if distinct is None and "distinct_views" in partials.columns:
        distinct = partials
    return _summed(partials, win, distinct)


def features_at(partials: DataFrame, distinct: DataFrame, views: DataFrame, identity: DataFrame,
                win: RunWindow) -> DataFrame:
    """``features_from_partials`` for a run at any time: whole hours from the partials, the
    broken first and last hour from the raw ``views`` (at most two hours of clicks).  The table
    of ``hourly_features`` is both ``partials`` and ``distinct``."""
    first = -(-win.send_lo // HOUR_MS) * HOUR_MS
    last = win.send_hi // HOUR_MS * HOUR_MS
    ms = F.col("timestamp")
    edge = views.where(((ms >= win.send_lo) & (ms < min(first, win.send_hi)))
                       | ((ms >= max(last, win.send_lo)) & (ms < win.send_hi)))
    c = host_filter(edge, win.hosts).select(
        "user_uuid", "timestamp", (parse.category_key() != "").alias("_is_cat"),
        (parse.product_key() != "").alias("_is_pdp"))
    lo, hi = F.timestamp_millis(F.lit(win.send_lo)), F.timestamp_millis(F.lit(win.send_hi))
    joined = attach_email(c, restrict_single_email(identity))
    sums = joined.groupBy("email").agg(
        F.max("timestamp").alias("last_ms"), F.count_if("_is_cat").alias("cgid_count"),
        F.count_if("_is_pdp").alias("pdp_count"), F.count(F.lit(1)).alias("views"))
    times = (joined.select("email", "timestamp").distinct().groupBy("email")
             .agg(F.count(F.lit(1)).alias("distinct_views")))
    inside = (F.col("hour_start") >= lo) & (F.col("hour_end") <= hi)
    whole = partials.where(inside).select(*sums.columns, "hour_start", "hour_end")
    counted = distinct.where(inside).select("email", "distinct_views", "hour_start", "hour_end")
    bounds = [lo.alias("hour_start"), hi.alias("hour_end")]
    return _summed(whole.unionByName(sums.select("*", *bounds)), win,
                   counted.unionByName(times.select("*", *bounds)))


def _summed(partials: DataFrame, win: RunWindow, distinct: DataFrame | None) -> DataFrame:
    lo = F.timestamp_millis(F.lit(win.send_lo))
    hi = F.timestamp_millis(F.lit(win.send_hi))

    def in_window(df: DataFrame) -> DataFrame:
        return df.where((F.col("hour_start") >= lo) & (F.col("hour_end") <= hi))

    agg = in_window(partials).groupBy("email").agg(F.max("last_ms").alias("_last_ms"),
                                                   F.sum("cgid_count").alias("cgid_count"),
                                                   F.sum("pdp_count").alias("pdp_count"))
    cols = ["cgid_count", "pdp_count"]
    if distinct is not None:
        d = in_window(distinct).groupBy("email").agg(F.sum("distinct_views").alias("count"))
        agg = agg.join(d, "email", "left")
        cols.append("count")
    return (agg.where(F.col("_last_ms") >= F.lit(win.recency_lo))
            .select("email",
                    (F.lit(win.run_ms // 1000) - F.expr("_last_ms div 1000"))
                    .cast("double").alias("time_since_browse"), *cols))


class LandedTables:
    """The job inputs with page views read from the R1 landed table.

    Every other input comes from ``base``; ``page_views`` prunes the landed
    table's ``view_date`` partitions to the requested window before the
    millisecond bounds, so an hourly run reads a few days of partitions.
    """

    def __init__(self, base, landed_path: str):
        self._base = base
        self._path = landed_path

    def __getattr__(self, name):
        return getattr(self._base, name)

    def page_views(self, lo_ms: int | None = None, hi_ms: int | None = None,
                   strict_lo: bool = False) -> DataFrame:
        if not path_exists(self._base.spark, self._path):    # nothing has landed yet
            return self._base.page_views(lo_ms, hi_ms, strict_lo).limit(0)
        df = self._base.spark.read.parquet(self._path)
        ts = F.col("timestamp")
        if lo_ms is not None:
            df = df.where(F.col("view_date") >= F.to_date(F.timestamp_millis(F.lit(lo_ms))))
            df = df.where(ts > lo_ms if strict_lo else ts >= lo_ms)
        if hi_ms is not None:
            df = df.where(F.col("view_date") <= F.to_date(F.timestamp_millis(F.lit(hi_ms))))
            df = df.where(ts < hi_ms)
        return df.drop("view_date", "batch")


def hourly_run(clicks: DataFrame, tables, landed_path: str, checkpoint: str, win: RunWindow,
               vocab: DataFrame, model, rollout_bits: int = 224, out_dir: str | None = None):
    """Land the new page views (availableNow), then score the run from the landed table
    (T7).  With ``out_dir`` all the run's outputs and its state are written there
    (``jobs.run_scoring``).  Returns the run's ``Scoring`` frames."""
    from ..plans import jobs

    land_page_views(clicks, landed_path, checkpoint).awaitTermination()
    landed = LandedTables(tables, landed_path)
    if out_dir:
        return jobs.run_scoring(landed, win, vocab, model, out_dir, rollout_bits=rollout_bits)
    return jobs.build_scoring(landed, win, vocab, model, rollout_bits=rollout_bits)


def hourly_unit(clicks: DataFrame, tables, landed_path: str, checkpoint: str, run: datetime,
                vocab: DataFrame, model, out_dir: str, n: int | None = None, rollout_bits: int = 224) -> None:
    """R1 as one restartable unit: landing the new page views and the hourly run (T7) are one
    ``foreachBatch``, committed together by the stream's checkpoint.

    The batch id is the run key.  A batch lands in a partition of its id and the run writes the
    partitions of its time, both replaced when the batch is repeated, and the time belongs
    to the batch: it is noted before anything else, so a batch that was interrupted is finished
    under the time of its first attempt, and the requested run then follows.  An hour without new
    clicks is run as well.  Outputs are complete when the run is in the run log.
    """
    from ..plans import jobs

    spark = tables.spark
    landed = LandedTables(tables, f"{landed_path.rstrip('/')}/clicks")

    def score(when: datetime) -> None:
        jobs.run_scoring(landed, when, vocab, model, out_dir, n=n, rollout_bits=rollout_bits, expire=True)

    def unit(batch: DataFrame, batch_id: int) -> None:
        note = f"{landed_path.rstrip('/')}/runs/{batch_id}"
        when = read_file(spark, note)
        if when is None:
            when = run.isoformat()
            replace_file(spark, note, when)
        day = F.to_date(F.timestamp_millis("timestamp"))
        (batch.withColumn("view_date", day).write.mode("overwrite").partitionBy("view_date")
         .parquet(f"{landed_path.rstrip('/')}/clicks/batch={batch_id}"))
        score(datetime.fromisoformat(when))

    def pass_over() -> None:
        (clicks.writeStream.foreachBatch(unit).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    pass_over()
    log = f"{out_dir.rstrip('/')}/run_log"
    if not path_exists(spark, jobs.run_folder(log, RunWindow(run)) + "/_SUCCESS"):
        # the batch finished an earlier attempt, or there were no clicks
        pass_over()
        if not path_exists(spark, jobs.run_folder(log, RunWindow(run)) + "/_SUCCESS"):
            score(run)
