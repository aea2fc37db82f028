"""Every registered query against its SQL, with whole keys and with keys cut into segments."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SMALL
from tidewatch.plans import QUERIES, SQL
from tidewatch.session import HOT_ROWS_CONF

# the other registered queries are tested beside their operators
assert set(entry.queries()) >= set(QUERIES)
assert entry.oracle_sql().items() >= SQL.items()

# queries with an ordered per-key computation, run again with every key over 25 rows split
ORDERED = [
    "running_count", "running_total", "running_avg", "deferred_emit_single", "occupancy", "occupancy_floor", "occupancy_alerts",
    "dynamic_capacity", "littles_law", "metrics_counts", "silence_resume", "sustained_breach", "sustained_rule_breach", "news2_score",
    "news2_unavailable", "rule_audit", "page_batches", "paged_alerts", "suppress_repeats", "suppress_repeats_dense", "three_sigma", "ttl_running_sum",
    "ttl_running_avg", "rolling_sum_alert", "moving_avg", "sessions", "late_split", "early_fire", "sliding_cross_alert",
    "spread_partition", "duration_stats", "login_attempts", "word_count_running",
]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) <= set(QUERIES)
    assert not set(QUERIES) - set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    _, difference = compare(QUERIES[name](spark, SMALL), con, SQL[name])
    assert difference is None


@pytest.mark.parametrize("name", ORDERED)
def test_matches_sql_with_split_keys(spark, con, name):
    spark.conf.set(HOT_ROWS_CONF, "25" if name != "word_count_running" else "2000")
    try:
        _, difference = compare(QUERIES[name](spark, SMALL), con, SQL[name])
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert difference is None


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert set(frame.columns) == {"hospital", "event_id", "ts", "delta", "occupied", "underflow"}
    assert frame.count() > 0
