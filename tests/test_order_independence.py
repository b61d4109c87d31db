"""
the same rows, shuffled into a different partitioning, give the same output."""

from pyspark.sql import functions as F

from roadwatch.operators import (
    area_distinct_running, avg_speed, clone_plates, count_batches, dangerous_driving, interval_join,
    pair_actions, top_n_monitors,
)
from roadwatch.sources.derived import Tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def shuffled(df, seed):
    return df.withColumn("_r", F.rand(seed)).repartition(5, "_r").sortWithinPartitions("_r").drop("_r")


def test_shuffled_input_same_output(spark):
    t = Tables(spark, SF)
    p, m = t.passages(), t.monitors()
    v, a = t.violations(), t.police_actions()
    ps, vs, as_ = shuffled(p, 1), shuffled(v, 2), shuffled(a, 3)
    checks = [
        (clone_plates(p, 3600), clone_plates(ps, 3600)),
        (dangerous_driving(p, m, within="24 hours"), dangerous_driving(ps, m, within="24 hours")),
        (area_distinct_running(p, "1 day"), area_distinct_running(ps, "1 day")),
        (pair_actions(v, a, "12 hours"), pair_actions(vs, as_, "12 hours")),
        (pair_actions(v, a, "12 hours", mode="replay"), pair_actions(vs, as_, "12 hours", mode="replay")),
        (top_n_monitors(avg_speed(p, "1 day", "6 hours")), top_n_monitors(avg_speed(ps, "1 day", "6 hours"))),
        (count_batches(p, 7), count_batches(ps, 7)),
    ]
    vi = v.withColumnRenamed("event_id", "violation_id")
    ai = a.withColumnRenamed("event_id", "action_id")
    checks.append((interval_join(vi, ai, lower="-2 hours", upper="2 hours", how="full_outer"),
                   interval_join(shuffled(vi, 4), shuffled(ai, 5), lower="-2 hours", upper="2 hours",
                                 how="full_outer")))
    for base, other in checks:
        assert rows(base) == rows(other)
