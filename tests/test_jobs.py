"""The jobs with their writes: training artefacts, then hourly runs that write the
score log, read it back, and write the prediction log, the outbox, the delivery log
and the run log."""

import os
import subprocess
import sys
import tempfile
from datetime import timedelta

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from browsekit import session
from browsekit.config import RunWindow
from browsekit.operators import affinity, outbox, recipients
from browsekit.plans import jobs
from browsekit.sources.fixtures import FixtureTables

TABLES = ("score_log", "prediction_log", "delivery_log", "run_log")


@pytest.fixture(scope="module")
def served(spark):
    t = FixtureTables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="browsekit-jobs-")
    trained = jobs.run_training(t, f"{base}/model")
    return t, base, trained, *jobs.load_serving(spark, f"{base}/model")


def test_training_writes_the_served_and_the_evaluated_model(spark, served):
    t, base, trained, vocab, model = served
    home = jobs.model_path(spark, f"{base}/model")
    assert {r.activity_type for r in spark.read.parquet(f"{home}/record").collect()} == {"pid", "cgid"}
    assert vocab.count() == trained.vocabulary.count()
    _, full = jobs.serving_model(t)

    def counts(m):
        return sorted(map(tuple, m["transitions"].select("activity_type", "src", "dst", "pair_count").collect()))

    assert counts(model) == counts(full)
    assert counts(affinity.load_model(spark, f"{home}/evaluated")) == counts(trained.model) != counts(full)


def test_two_hours_and_a_repeated_run(spark, served):
    t, base, _, vocab, model = served
    out = f"{base}/run"
    win = RunWindow()
    s = jobs.run_scoring(t, win, vocab, model, out)
    first = {r.email for r in s.outbox.collect()}
    rows = {n: spark.read.parquet(f"{out}/{n}").count() for n in TABLES}
    assert rows["score_log"] == s.score_rows.count() > 0 and rows["run_log"] == 1
    assert spark.read.json(f"{out}/outbox").count() == s.outbox.count() > 0
    assert {r.email for r in spark.read.parquet(f"{out}/delivery_log").collect()} == first
    assert outbox.last_run(spark.read.parquet(f"{out}/run_log")).first().last_run == win.run

    again = jobs.run_scoring(t, win, vocab, model, out)
    assert {r.email for r in again.outbox.collect()} == first
    assert {n: spark.read.parquet(f"{out}/{n}").count() for n in TABLES} == rows

    # an hour later: the window follows the run log, and whom hour 1 mailed is left alone
    later = win.run + timedelta(hours=1)
    assert jobs.window_of(spark, out, later) == RunWindow(later, win.run)
    second = jobs.run_scoring(t, later, vocab, model, out)
    mailed = {r.email for r in second.outbox.collect()}
    assert first and not mailed & first
    free = jobs.run_scoring(t, RunWindow(later, win.run), vocab, model, f"{base}/other")
    assert mailed == {r.email for r in free.outbox.collect()} - first
    # the mailer's own log decides where it is given: nothing delivered, nobody blocked
    nobody = spark.createDataFrame([], "email string, timestamp timestamp")
    own = jobs.run_scoring(t, RunWindow(later, win.run), vocab, model, out, delivered=nobody)
    assert {r.email for r in own.outbox.collect()} == {r.email for r in free.outbox.collect()}


def test_score_log_read_is_pruned(spark, served):
    t, base, _, vocab, model = served
    win = RunWindow()
    jobs.run_scoring(t, win, vocab, model, f"{base}/pruned")
    log = recipients.trailing(spark.read.parquet(f"{base}/pruned/score_log"), win)
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_run_log_row_does_not_depend_on_the_drivers_zone():
    code = ("from pyspark.sql import SparkSession\nfrom browsekit.session import build_session\n"
            "from browsekit.config import RunWindow\nfrom browsekit.operators import outbox\n"
            "s = build_session('local[1]')\n"
            "print('GOT', outbox.run_log_row(s, RunWindow()).selectExpr('cast(timestamp as string) t').first()['t'])")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "America/New_York", "PYTHONPATH": root},
                         capture_output=True, text=True, timeout=180)
    assert "GOT 2024-01-30 12:00:00" in got.stdout


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_stage_scope_removes_what_was_written_in_it(spark):
    before = session.materialize(spark.range(3))
    with pytest.raises(KeyError):
        with session.stage_scope(spark) as here:
            inside = session.materialize_many(spark.range(4), spark.range(5))
            with session.stage_scope(spark) as inner:
                session.materialize(spark.range(6))
                assert session.path_exists(spark, inner)
            assert not session.path_exists(spark, inner) and [x.count() for x in inside] == [4, 5]
            raise KeyError("a failing job")
    assert not session.path_exists(spark, here) and before.count() == 3
    assert session.materialize(spark.range(7)).count() == 7


def test_expire_removes_the_applications_tables():
    code = ("from browsekit import session\n"
            "s = session.build_session('local[1]')\n"
            "session.materialize(s.range(3))\nroot = session.stage_root(s)\n"
            "print('GOT', session.path_exists(s, root), session.expire_stage_tables(s), session.path_exists(s, root))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=180)
    assert "GOT True True False" in got.stdout


class Thinned:
    """Tables with some of their inputs replaced."""

    def __init__(self, base, **inputs):
        self._base, self._inputs = base, inputs

    def __getattr__(self, name):
        return self._inputs.get(name) or getattr(self._base, name)


def test_a_repeated_run_without_rows_leaves_none(spark, served):
    t, base, _, vocab, model = served
    out, win = f"{base}/emptied", RunWindow()
    jobs.run_scoring(t, win, vocab, model, out)
    assert spark.read.json(f"{out}/outbox").count() > 0
    nothing = Thinned(t, page_views=lambda lo=None, hi=None, strict_lo=False: t.page_views(lo, hi, strict_lo).limit(0))
    again = jobs.run_scoring(nothing, win, vocab, model, out, expire=True)
    assert again.outbox.count() == 0 and again.recipients is None
    assert [spark.read.parquet(f"{out}/{x}").count() for x in TABLES] == [0, 0, 0, 1]
    assert sum(f.endswith(".json") and os.path.getsize(os.path.join(d, f)) > 0
               for d, _, files in os.walk(f"{out}/outbox") for f in files) == 0


def test_an_expiring_run_gives_the_same_outputs(spark, served):
    t, base, _, vocab, model = served
    win, root = RunWindow(), session.stage_root(spark)
    a = jobs.run_scoring(t, win, vocab, model, f"{base}/kept")
    before = sorted(os.listdir(root))
    b = jobs.run_scoring(t, win, vocab, model, f"{base}/expired", expire=True)
    assert sorted(os.listdir(root)) == before
    for x, y in ((a.outbox, b.outbox), (a.prediction_log, b.prediction_log), (a.score_rows, b.score_rows)):
        assert sorted(map(str, x.collect())) == sorted(map(str, y.select(*x.columns).collect()))


def test_clicks_that_land_during_training_change_nothing(spark, served):
    """Vocabulary, evaluated and served model come from one scan of the clicks."""
    t, base, *_ = served
    from browsekit.config import TRAIN_START_SHORT

    calls = []

    def growing(lo=None, hi=None, strict_lo=False):
        calls.append(1)
        views = t.page_views(lo, hi, strict_lo)
        new = views.limit(40).withColumn("url", F.lit("https://shop.example/0000000_00.html"))
        return views if len(calls) == 1 else views.unionByName(new)

    path = f"{base}/growing"
    trained = jobs.run_training(Thinned(t, page_views=growing), path, TRAIN_START_SHORT)
    assert len(calls) == 1
    vocab, model = jobs.load_serving(spark, path)
    assert sorted(vocab.collect()) == sorted(trained.vocabulary.collect())
    known = {r.idx + 1 for r in vocab.collect()}
    assert {r.item for r in model["items"].collect()} <= known


def test_versions_are_published_by_a_pointer(spark, served):
    t, base, *_ = served
    from browsekit.config import TRAIN_START_SHORT

    path = f"{base}/versions-test"
    with pytest.raises(FileNotFoundError):
        jobs.load_serving(spark, path)
    jobs.run_training(t, path, TRAIN_START_SHORT)
    vocab, model = jobs.load_serving(spark, path)
    first, rows = jobs.model_path(spark, path), sorted(model["items"].collect())
    names = {r.name for r in spark.read.parquet(f"{first}/record").collect()}
    jobs.run_training(t, path)
    # a reader of the first version is not disturbed; new readers get the second
    assert sorted(model["items"].collect()) == rows and jobs.model_path(spark, path) != first
    assert sorted(jobs.load_serving(spark, path)[1]["items"].collect()) != rows
    assert sorted(jobs.load_serving(spark, path, int(first.split("/")[-1]))[1]["items"].collect()) == rows
    assert not names & {r.name for r in spark.read.parquet(f"{jobs.model_path(spark, path)}/record").collect()}
    with pytest.raises(ValueError):
        jobs.run_training(t, path, TRAIN_START_SHORT, version=int(first.split("/")[-1]))


def test_ranks_reject_an_alpha_they_cannot_order():
    with pytest.raises(ValueError):
        affinity.reciprocal_ranks(None, {}, None, alpha=2.0)


def test_rollout_gate_takes_a_share(spark):
    emails = spark.range(400).select(F.concat(F.lit("u"), "id").alias("email"))
    kept = [outbox.rollout_gate(emails, 224, s).count() for s in (0.0, 0.3, 0.9, 1.0)]
    assert kept[0] == 0 and kept[3] == 400 and 80 < kept[1] < 160 and 330 < kept[2] < 390


def candidates(spark, n=500):
    return spark.range(n).select(F.concat(F.lit("u"), F.col("id") % 211).alias("email"), ((F.col("id") * 37 % 23) / 22).alias("pred"),
                                 F.concat(F.lit("a"), "id").alias("activity")).unionByName(
        spark.range(9).select(F.concat(F.lit("n"), "id").alias("email"), F.lit(None).cast("double").alias("pred"), F.lit("z").alias("activity")))


def in_order(df):
    return sorted(map(tuple, df.select("email", "pred", "activity").collect()), key=lambda r: (r[1] is None, -(r[1] or 0), r[0], r[2]))


@pytest.mark.parametrize("n", [0, 1, 22, 23, 250, 499, 500, 505, 509, 10_000])
def test_send_cap_is_the_first_rows(spark, n):
    df = candidates(spark)
    got = outbox.send_cap(df, n)
    assert in_order(got) == in_order(df)[:n] and got.columns == df.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan and "CollectLimit" not in plan


def test_failed_sends_are_replaced_by_the_next_best(spark):
    df, rounds = candidates(spark), []

    def deliver(rows):
        rounds.append(rows.count())
        return rows.select("_rank", (F.xxhash64("activity") % 3 != 0).alias("ok"))

    got = outbox.send_until(df, 100, deliver).collect()
    handed = in_order(df)[: len(got)]
    assert sorted((r["email"], r["activity"]) for r in got) == sorted((r[0], r[2]) for r in handed)
    assert sum(r["ok"] for r in got) == 100 and len(rounds) > 1 and sum(rounds) == len(got)
    assert outbox.send_until(df, 0, deliver).count() == 0
    none = outbox.send_until(df, 5, lambda rows: rows.select("_rank", F.lit(False).alias("ok")))
    assert none.count() == df.count() and none.where("ok").count() == 0
