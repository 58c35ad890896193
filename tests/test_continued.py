"""Counts and newest items carried from batch to batch equal a fit on everything."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from browsekit import config, session
from browsekit.operators import affinity, continued, sequences
from browsekit.plans import jobs
from browsekit.sources.fixtures import FixtureTables

SCHEMA = "email string, activity_type string, item int, activity_dt timestamp, session_id string, activity string"
START = datetime(2024, 1, 2)


def clicks(seed, users=6, per_user=60, hot=300):
    """Views with ties, several in a minute, one user with most rows and one with a single one."""
    r = random.Random(seed)
    out = []
    for u in range(users):
        n = hot if u == 0 else 1 if u == 1 else per_user
        for _ in range(n):
            item = r.randint(1, 9)
            at = START + timedelta(seconds=r.randint(0, 30 * 3600) // 7 * 7)
            out.append((f"u{u}", r.choice(["pid", "cgid"]), item, at, f"s{r.randint(0, 2)}", f"a{item}"))
    return out


def plain_pairs(rows):
    counts, groups = {}, {}
    for e, t, item, at, s, a in rows:
        groups.setdefault((e, t), []).append((at, s, a, item))
    for (_, t), g in groups.items():
        g.sort()
        for x, y in zip(g, g[1:]):
            counts[t, x[3], y[3]] = counts.get((t, x[3], y[3]), 0) + 1
    return counts


def as_dict(df, n):
    return {tuple(r)[:n]: tuple(r)[n] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_gives_the_full_fit(spark, seed):
    rows = clicks(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    hours = sorted(random.Random(seed).sample(range(1, 30), 4))
    bounds = [START, *[START + timedelta(hours=h, seconds=31) for h in hours], START + timedelta(days=9)]
    state = None
    for lo, hi in zip(bounds, bounds[1:]):
        batch = df.where((F.col("activity_dt") >= F.lit(lo)) & (F.col("activity_dt") < F.lit(hi)))
        state = continued.carry(state, batch)
    assert as_dict(state["pairs"], 3) == plain_pairs(rows)
    full = affinity.fit(sequences.to_sequences(df, length=2000, step=2000))
    got = continued.model(state)
    for name in ("items", "transitions"):
        cols = sorted(full[name].columns)
        assert sorted(map(tuple, got[name].select(cols).collect())) == sorted(map(tuple, full[name].select(cols).collect()))
    newest = sequences.to_sequences(df).where("chunk = 0")
    kept = continued.newest_sequences(state["recent"])
    assert [f.dataType for f in kept.schema] == [f.dataType for f in newest.schema]
    assert sorted(map(str, kept.collect())) == sorted(map(str, newest.select(kept.columns).collect()))


def test_newest_items_merge_in_any_order(spark):
    """Late batches included: thirty batches of random rows, in no order of time."""
    rows = clicks(3, users=4, per_user=40, hot=90)
    random.Random(3).shuffle(rows)
    kept = None
    for i in range(0, len(rows), -(-len(rows) // 30)):
        batch = spark.createDataFrame(rows[i:i + -(-len(rows) // 30)], SCHEMA)
        kept = continued.merge_last_n(kept, batch, 10)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
    want = sequences.to_sequences(spark.createDataFrame(rows, SCHEMA)).where("chunk = 0")
    got = continued.newest_sequences(kept)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    assert kept.groupBy("email", "activity_type").count().agg(F.max("count")).first()[0] <= 10


def test_an_empty_batch_changes_nothing(spark):
    df = spark.createDataFrame(clicks(4), SCHEMA)
    state = continued.carry(None, df)
    after = continued.carry(state, df.limit(0))
    for name in state:
        assert sorted(map(str, after[name].select(state[name].columns).collect())) == \
            sorted(map(str, state[name].collect()))
    nothing = continued.carry(None, df.limit(0))
    assert all(t.count() == 0 for t in nothing.values())


def test_newest_items_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame(clicks(5), SCHEMA)
    plan = continued.last_n(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_training_continues_and_survives_a_failed_call(spark, tmp_path, monkeypatch):
    t = FixtureTables(spark, SF_SMALL)
    path = str(tmp_path / "model")
    first = jobs.continue_training(t, path, datetime(2024, 1, 12), version=1)
    old, _ = jobs.load_serving(spark, path)
    old = {tuple(r) for r in old.collect()}

    def broken(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(jobs.affinity, "save_model", broken)
        with pytest.raises(RuntimeError, match="killed"):
            jobs.continue_training(t, path, datetime(2024, 1, 20), version=2)
    assert jobs.model_path(spark, path) == first

    scans = []
    monkeypatch.setattr(session, "stage_observers", [scans.append])
    jobs.continue_training(t, path, datetime(2024, 1, 20), version=2)
    text = scans[0]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-12T00:00), LessThan(ts,2024-01-20T00:00)" in text, "pruned at the scan"
    monkeypatch.undo()
    jobs.continue_training(t, path, config.RUN, version=3)
    with pytest.raises(ValueError, match="counted already"):
        jobs.continue_training(t, path, config.RUN, version=4)

    vocab, model = jobs.load_serving(spark, path)
    assert old <= {tuple(r) for r in vocab.collect()}, "ids of old products stay"
    rows = sequences.training_views(t, config.TRAIN_START, until=config.RUN)
    full = affinity.fit(sequences.to_sequences(sequences.encode(rows, vocab), length=100_000, step=100_000))
    for name in ("items", "transitions"):
        cols = sorted(full[name].columns)
        assert sorted(map(tuple, model[name].select(cols).collect())) == \
            sorted(map(tuple, full[name].select(cols).collect()))
