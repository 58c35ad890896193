"""Stream test: R2 through availableNow equals the batch send features."""

import tempfile
from datetime import datetime

import pytest
from conftest import SF_SMALL

from browsekit.config import RunWindow
from browsekit.operators import features
from browsekit.sources.fixtures import FixtureTables
from browsekit.streaming import incremental


def clicks(spark):
    return incremental.derive_page_views(incremental.event_stream(spark, f"{SF_SMALL}/event[s].parquet"))


def test_hourly_partials_equal_batch(spark):
    win = RunWindow()
    t = FixtureTables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="browsekit-stream-")
    for q in (incremental.start_hourly_partials(clicks(spark), t.email_uuids(), f"{base}/out",
                                                f"{base}/ckpt"),
              incremental.start_hourly_distinct(clicks(spark), t.email_uuids(), f"{base}/dist",
                                                f"{base}/dckpt")):
        q.awaitTermination()
    streamed = incremental.features_from_partials(spark.read.parquet(f"{base}/out"), win,
                                                  distinct=spark.read.parquet(f"{base}/dist"))
    batch = features.browse_features(t.page_views(win.send_lo, win.send_hi), t.email_uuids(), win)
    cols = ["email", "time_since_browse", "cgid_count", "pdp_count", "count"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b and len(a) > 0

    # a run at half past: whole hours from the partials, the two broken ones from the clicks
    half = RunWindow(datetime(2024, 1, 30, 12, 30), datetime(2024, 1, 30, 11, 30))
    partials, distinct = spark.read.parquet(f"{base}/out"), spark.read.parquet(f"{base}/dist")
    with pytest.raises(ValueError):
        incremental.features_from_partials(partials, half, distinct)
    streamed = incremental.features_at(partials, distinct, t.page_views(half.send_lo, half.send_hi),
                                       t.email_uuids(), half)
    batch = features.browse_features(t.page_views(half.send_lo, half.send_hi), t.email_uuids(), half)
    assert sorted(map(tuple, streamed.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_landed_page_views_equal_batch(spark):
    t = FixtureTables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="browsekit-land-")
    q = incremental.land_page_views(clicks(spark), f"{base}/out",
                                    f"{base}/ckpt")
    q.awaitTermination()
    cols = ["user_uuid", "timestamp", "session_id", "host", "query_string", "url"]
    landed = spark.read.parquet(f"{base}/out").select(*cols)
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, t.page_views().select(*cols).collect()))


def test_landed_read_prunes_date_partitions(spark):
    t = FixtureTables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="browsekit-prune-")
    incremental.land_page_views(clicks(spark), f"{base}/out",
                                f"{base}/ckpt").awaitTermination()
    win = RunWindow()
    landed = incremental.LandedTables(t, f"{base}/out")
    df = landed.page_views(win.send_lo, win.send_hi)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(view_date" in plan and "view_date#" in plan
    want = sorted(map(tuple, t.page_views(win.send_lo, win.send_hi).collect()))
    assert sorted(map(tuple, df.collect())) == want


def test_hourly_partials_over_many_batches(spark):
    """The events table landed as one file per day and streamed one file per
    micro-batch: state and watermark carry across batches, same answer."""
    from pyspark.sql import functions as F
    win = RunWindow()
    t = FixtureTables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="browsekit-multi-")
    ev = t.raw("events").withColumn("d", F.to_date("ts"))
    days = sorted(r.d for r in ev.select("d").distinct().collect())
    for i, day in enumerate(days):       # one file per day, written in time order
        (ev.where(F.col("d") == F.lit(day)).drop("d").coalesce(1)
         .write.parquet(f"{base}/events/day={i:03d}"))
    src = f"{base}/events/*/*.parquet"
    qs = []
    for name, start in (("out", incremental.start_hourly_partials),
                        ("dist", incremental.start_hourly_distinct)):
        clicks = incremental.derive_page_views(
            incremental.event_stream(spark, src, max_files_per_trigger=1))
        part = (incremental.hourly_partials(clicks, t.email_uuids()) if name == "out"
                else incremental.hourly_distinct_views(clicks, t.email_uuids()))
        qs.append(incremental._start(part, f"{base}/{name}", f"{base}/{name}_ckpt"))
    for q in qs:
        q.awaitTermination()
    assert qs[0].lastProgress is not None
    streamed = incremental.features_from_partials(spark.read.parquet(f"{base}/out"), win,
                                                  distinct=spark.read.parquet(f"{base}/dist"))
    batch = features.browse_features(t.page_views(win.send_lo, win.send_hi), t.email_uuids(), win)
    cols = ["email", "time_since_browse", "cgid_count", "pdp_count", "count"]
    assert sorted(map(tuple, streamed.select(*cols).collect())) == \
        sorted(map(tuple, batch.select(*cols).collect()))


def test_an_interrupted_hour_is_finished_and_none_is_lost_or_doubled(spark, monkeypatch):
    """Killed between landing and writing, then restarted with the next hour's run: both runs are
    there once, equal to the batch job's."""
    from browsekit.plans import jobs

    t = FixtureTables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="browsekit-unit-")
    vocab, model = jobs.serving_model(t)
    win = RunWindow()
    later = datetime(2024, 1, 30, 13, 0)
    plain = jobs.run_scoring
    calls = []

    def killed(tables, when, *a, **k):
        calls.append(when)
        if len(calls) == 1:
            raise RuntimeError("killed")
        return plain(tables, when, *a, **k)

    monkeypatch.setattr(jobs, "run_scoring", killed)

    def unit(run):
        incremental.hourly_unit(clicks(spark), t, f"{base}/landed", f"{base}/ckpt", run, vocab, model, f"{base}/out")

    with pytest.raises(Exception, match="killed"):
        unit(win.run)
    unit(later)
    assert calls == [win.run, win.run, later]
    unit(later)
    assert len(calls) == 3, "a complete run is not repeated"
    for when in (win.run, later):
        plain(t, when, vocab, model, f"{base}/batch")
    for table in ("outbox", "delivery_log", "run_log", "score_log", "prediction_log"):
        read = spark.read.json if table == "outbox" else spark.read.parquet
        a, b = (sorted(map(str, read(f"{base}/{x}/{table}").collect())) for x in ("out", "batch"))
        assert a == b and a
    cols = ["user_uuid", "timestamp", "session_id", "host", "query_string", "url"]
    landed = spark.read.parquet(f"{base}/landed/clicks").select(*cols)
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, t.page_views().select(*cols).collect()))


def test_nothing_has_landed_yet(spark, tmp_path):
    t = FixtureTables(spark, SF_SMALL)
    views = incremental.LandedTables(t, str(tmp_path / "none")).page_views(0, 1)
    assert views.count() == 0 and views.columns == t.page_views().columns


def test_one_stream_gives_all_send_features(spark):
    """One scan of the clicks, a file a batch; equal to A1 on the hour and at any minute."""
    from pyspark.sql import functions as F
    t = FixtureTables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="browsekit-one-")
    ev = t.raw("events").withColumn("d", F.floor(F.dayofmonth("ts") / 4))
    for (d,) in sorted(ev.select("d").distinct().collect()):
        ev.where(F.col("d") == d).drop("d").coalesce(1).write.parquet(f"{base}/events/part={d:03d}")
    stream = incremental.event_stream(spark, f"{base}/events/*/*.parquet", max_files_per_trigger=1)
    q = incremental.start_hourly_features(incremental.derive_page_views(stream), t.email_uuids(),
                                          f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    assert len(q.lastProgress["sources"]) == 1 and len(q.lastProgress["stateOperators"]) == 2
    table = spark.read.parquet(f"{base}/out")
    cols = ["email", "time_since_browse", "cgid_count", "pdp_count", "count"]
    for minute in (0, 17, 30):
        win = RunWindow(datetime(2024, 1, 30, 12, minute), datetime(2024, 1, 30, 11, minute))
        views = t.page_views(win.send_lo, win.send_hi)
        want = sorted(map(tuple, features.browse_features(views, t.email_uuids(), win).select(*cols).collect()))
        got = (incremental.features_at(table, table, views, t.email_uuids(), win) if minute
               else incremental.features_from_partials(table, win))
        assert sorted(map(tuple, got.select(*cols).collect())) == want and want


def test_a_hot_uuid_is_split_by_the_salted_join(spark):
    """A uuid with most clicks meets its identity row in several tasks, with the same result as unsalted."""
    from pyspark.sql import functions as F
    rows = [("hot" if i % 3 else f"u{i % 7}", i % 900 * 1000, "s", "shop.example", f"pid=p{i % 50}&x=1", "")
            for i in range(3000)]
    views = spark.createDataFrame(rows, "user_uuid string, timestamp bigint, session_id string, host string, "
                                        "query_string string, url string")
    ids = spark.createDataFrame([("hot", "h@x")] + [(f"u{i}", "h@x" if i == 1 else f"{i}@x") for i in range(7)],
                                "uuid string, email string")
    out = [sorted(map(tuple, incremental.hourly_features(views, ids, salts=s).collect())) for s in (1, 8)]
    assert out[0] == out[1] and len(out[0]) == 7
    salt = F.pmod(F.xxhash64("timestamp", "query_string"), F.lit(8))
    shares = [r["count"] for r in views.where("user_uuid = 'hot'").groupBy(salt).count().collect()]
    assert len(shares) == 8 and max(shares) < 2 * sum(shares) / 8


def test_the_identity_is_computed_once_and_not_in_every_batch(spark, tmp_path):
    """Micro-batches read a written identity; a uuid of two emails stays out, a repeated row counts twice."""
    views = [("u1", 1704067200000 + 60_000 * n, "s", "shop.example", "pid=1_01", "") for n in (0, 1, 2, 360)]
    views += [("u2", 1704067200000, "s", "shop.example", "cgid=pumps", "")]      # minute 360 closes the first hour
    columns = "user_uuid string, timestamp bigint, session_id string, host string, query_string string, url string"
    spark.createDataFrame(views, columns).write.parquet(f"{tmp_path}/in")
    ids = spark.createDataFrame([("u1", "a@x"), ("u1", "a@x"), ("u2", "b@x"), ("u2", "c@x"), (None, "d@x")],
                                "uuid string, email string")
    q = incremental.start_hourly_features(spark.readStream.schema(columns).parquet(f"{tmp_path}/in"), ids,
                                          f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    q.awaitTermination()
    assert "count_emails" not in q._jsq.explainInternal(True)
    out = spark.read.parquet(f"{tmp_path}/out").select("email", "cgid_count", "pdp_count", "views", "distinct_views")
    assert [tuple(r) for r in out.collect()] == [("a@x", 0, 6, 6, 3)]
