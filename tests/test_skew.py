"""A third of all rows on one car: the scans split it, results stay exact."""

import pytest
from pyspark.sql import functions as F

from roadwatch.operators import clone_plates
from roadwatch.plans.scan import with_rank_bucket, with_time_bucket
from roadwatch.sources.derived import Tables
from test_patterns import clone_fold

SF = "/root/testdata/sf0.01"


def hot_passages(spark):
    p = Tables(spark, SF).passages()
    return p.withColumn("car", F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("car")))


def test_time_buckets_split_a_hot_car(spark):
    p = hot_passages(spark)
    total = p.count()
    assert p.where("car = 'HOT'").count() >= total // 3
    largest = with_time_bucket(p, "action_time", 3_600_000).groupBy("car", "_tb").count() \
        .agg(F.max("count")).first()[0]
    assert largest < 0.01 * total          # the hot car spreads over its hourly buckets


def test_rank_buckets_split_a_burst(spark):
    p = hot_passages(spark).withColumn(
        "action_time", F.when(F.col("car") == "HOT", F.lit(0)).otherwise(F.col("action_time")))
    total = p.count()
    sizes = [r["count"] for r in with_rank_bucket(p, ["car"], ["action_time", "event_id"], 16)
             .groupBy("car", "_tb").count().collect()]
    assert max(sizes) < 3 * total / 16     # one timestamp, still spread over range buckets


def test_clone_plates_exact_with_hot_car(spark):
    p = hot_passages(spark)
    rows = [(r.action_time, r.monitor_id, r.car, r.event_id)
            for r in p.select("action_time", "monitor_id", "car", "event_id").collect()]
    got = sorted((r.car, r.first_monitor, r.second_monitor, r.action_time)
                 for r in clone_plates(p, 3600).collect())
    assert got == clone_fold(rows, 3600)


@pytest.mark.parametrize("bucketing", ["time", "rank"])
def test_running_distinct_with_a_hot_and_a_missing_car(spark, bucketing):
    """A third of the rows on one car in one window, another third without a car."""
    from roadwatch.operators import area_distinct_running
    rows = [(i, 1000 + i, "1", "HOT" if i % 3 == 0 else None if i % 3 == 1 else f"c{i % 50}") for i in range(900)]
    df = spark.createDataFrame(rows, "event_id long, action_time long, area_id string, car string")
    got = {r.event_id: r.distinct_cars for r in area_distinct_running(df, "1 hour", bucket_ms=100, bucketing=bucketing).collect()}
    seen, want = set(), {}
    for i, _, _, car in rows:
        seen |= {car} - {None}
        want[i] = len(seen)
    assert got == want


def test_outer_interval_join_with_missing_keys_and_a_hot_bucket(spark):
    """NULL keys and times lie in many partitions; salted parts give the same pairs."""
    from roadwatch.operators import interval_join
    left = spark.createDataFrame([(i, None if i % 3 == 0 else "HOT", None if i % 10 == 0 else 1000 + i % 7) for i in range(300)] + [(0, None, None)],
                                 "v long, car string, create_time long")
    right = spark.createDataFrame([(i, None if i % 4 == 0 else "HOT" if i % 4 == 1 else f"c{i}", None if i % 9 == 0 else 1003 + i) for i in range(40)],
                                  "a long, car string, action_time long")
    lo, hi = -5, 5
    ls, rs = left.collect(), right.collect()
    pairs = [(x, y) for x in ls for y in rs if x.car is not None and x.car == y.car and x.create_time is not None
             and y.action_time is not None and x.create_time + lo <= y.action_time <= x.create_time + hi]
    want = [(x.car, x.v, x.create_time, y.a, y.action_time) for x, y in pairs]
    want += [(x.car, x.v, x.create_time, None, None) for x in ls if not any(x.v == p.v for p, _ in pairs)]
    want += [(y.car, None, None, y.a, y.action_time) for y in rs if not any(y.a == q.a for _, q in pairs)]
    for salts in (1, 4):
        got = interval_join(left, right, lower=lo, upper=hi, how="full_outer", salts=salts)
        assert sorted(map(str, map(tuple, got.select("car", "v", "create_time", "a", "action_time").collect()))) == sorted(map(str, want))
