"""Plan shape: the properties that matter at scale, checked on the physical plans."""

import re

import pytest

from roadwatch.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name,keys", [
    ("clone_plates", r"_part#\d+"),
    ("pair_actions", r"_part#\d+"),
    ("pair_actions_replay", r"_part#\d+"),
    ("area_distinct_running", r"_part#\d+"),
    ("dangerous_driving", r"car#\d+, _hb#\d+L"),
])
def test_sequences_shuffle_on_key_and_time_bucket(spark, name, keys):
    """A key's rows are spread over its buckets (``_part`` is key and bucket), never
    gathered by key alone."""
    p = plan(spark, name)
    assert re.search(rf"Exchange hashpartitioning\({keys}, \d+\)", p), p
    # Exchanges on the key alone only carry one-row-per-bucket summaries (aggregates).
    for m in re.finditer(r"Exchange hashpartitioning\((car|area_id)#\d+(, start_time#\d+L)?, \d+\)", p):
        below = p[m.end():m.end() + 600]
        assert re.search(r"Aggregate|Window|Join", below), below


@pytest.mark.parametrize("name,scans", [("clone_plates", 1), ("pair_actions", 2), ("area_distinct_running", 1), ("tracks", 2)])
def test_sequences_read_their_input_once(spark, name, scans):
    df = QUERIES[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == scans, final


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "interval_join")
    assert "EqualTo(event_type,error)" in p and "EqualTo(event_type,click)" in p
    p = plan(spark, "overspeed")
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    events_scan = [s for s in scans if "props" in s][0]
    assert "event_type" not in events_scan          # unused columns are pruned


def test_dimension_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "overspeed")
