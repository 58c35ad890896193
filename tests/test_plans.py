"""Plan tests: no Cartesian products or Python UDFs in the composite jobs,
filters reach the scan, top-1 per key plans a WindowGroupLimit."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from browsekit import session
from browsekit.config import RunWindow
from browsekit.operators import sequences
from browsekit.sources.fixtures import FixtureTables

COMPOSITES = ("t1_send_features", "t2_select_recipients", "t3_activity_sequences",
              "t5_check_inventory", "t6_recommend", "t7_run_scoring", "t8_run_training",
              "m6_reciprocal_rank", "j15_viewed_variants", "a10_loyal_shoppers")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stages(monkeypatch):
    """Optimized and executed plans of every stage table written during a test."""
    seen = []

    def see(df):
        q = df._jdf.queryExecution()
        seen.append((q.optimizedPlan().toString(), q.executedPlan().toString()))

    monkeypatch.setattr(session, "stage_observers", [see])
    return seen


@pytest.mark.parametrize("key", COMPOSITES)
def test_no_cartesian_or_python(spark, stages, key):
    df = entry.queries()[key](spark, SF_SMALL)
    q = df._jdf.queryExecution()
    for optimized, executed in [*stages, (q.optimizedPlan().toString(), q.executedPlan().toString())]:
        assert "Join Cross" not in optimized
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in executed


def click_scans(text: str) -> int:
    """Scans that read the query strings of clicks (the fixture derives them from ``props``)."""
    return sum("FileScan" in line and "props" in line for line in text.split("\n"))


def test_send_features_scan_the_clicks_once(spark, stages):
    df = entry.queries()["t1_send_features"](spark, SF_SMALL)
    assert sum(click_scans(executed) for _, executed in stages) + click_scans(plan_of(df)) == 1


def test_run_rows_are_not_recomputed(spark):
    t = FixtureTables(spark, SF_SMALL)
    win = RunWindow()
    vocab = sequences.fit_vocabulary(sequences.scoring_views(t, win))
    users = t.email_uuids().select("email")
    run = sequences.activity_sequences(sequences.scoring_views(t, win), users, vocab)
    for name in ("pid_rows", "cgid_rows", "views"):
        assert "events.parquet" not in plan_of(run[name]) and click_scans(plan_of(run[name])) == 0


def test_time_filter_pushed_to_scan(spark):
    df = entry.queries()["p7_lagged_window"](spark, SF_SMALL)
    text = plan_of(df)
    assert "PushedFilters" in text and "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_column_pruning_on_scan(spark):
    df = entry.queries()["a4_order_history"](spark, SF_SMALL)
    text = plan_of(df)
    assert "o_totalprice" not in text and "l_extendedprice" not in text


def test_latest_row_uses_window_group_limit(spark):
    df = entry.queries()["a8_latest_sizes"](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    assert "WindowGroupLimit" in plan_of(df)


def test_browse_features_two_level_aggregate(spark):
    """A hot email is spread over (email, timestamp) before the per-email step."""
    df = entry.queries()["a1_browse_features"](spark, SF_SMALL)
    text = plan_of(df)
    assert "hashpartitioning(email" in text
    assert any("keys=[email" in line and "timestamp" in line for line in text.split("\n")
               if "HashAggregate" in line)


def test_sequence_ranks_are_bucketed(spark):
    """W3 ranks inside (user, type, minute bucket), never a whole user in one sort."""
    df = entry.queries()["w3_sequences"](spark, SF_SMALL)
    text = plan_of(df)
    assert "row_number()" in text and "_bucket" in text
