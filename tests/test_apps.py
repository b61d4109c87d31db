"""The runnable programs, end to end on text landing folders."""

import tempfile
import time

from pyspark.sql import functions as F

from roadwatch import apps
from roadwatch.operators import clone_plates, overspeed_passages, track_rows, listed_cars_only
from roadwatch.sources.derived import Tables
from roadwatch.sources.lines import to_lines

SF = "/root/testdata/sf0.001"
SENTINEL = "7000000000000,0000,00000,SENTINEL,1.0,0,0"


def finish(q):
    try:
        for _ in range(6):
            q.processAllAvailable()
            time.sleep(0.5)
    finally:
        q.stop()


def test_apps_end_to_end(spark):
    t = Tables(spark, SF)
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    to_lines(t.passages()).coalesce(1).write.text(f"{root}/landing/a")
    time.sleep(1.1)
    spark.createDataFrame([(SENTINEL,)], "value string").coalesce(1).write.text(f"{root}/landing/b")
    t.monitors().write.parquet(f"{root}/stations")
    lines = f"{root}/landing/*"

    finish(apps.overspeed(spark, lines=lines, stations=f"{root}/stations", out=f"{root}/speeding"))
    got = spark.read.parquet(f"{root}/speeding").drop("epoch", "run")
    want = overspeed_passages(t.passages(), t.monitors()).drop("event_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    finish(apps.clone_plates(spark, lines=lines, out=f"{root}/violation_list", within_s=3600))
    stored = spark.read.parquet(f"{root}/violation_list")
    warn = clone_plates(t.passages(), within_s=3600)
    firsts = warn.groupBy("car", F.expr("action_time - action_time % 86400000")).count()
    assert stored.count() == firsts.count() > 0

    apps.vehicle_tracks(spark, log=f"{root}/landing/a", violation_list=f"{root}/violation_list",
                        out=f"{root}/tracks")
    listed = stored.select("car").distinct()
    assert spark.read.parquet(f"{root}/tracks").count() == \
        track_rows(listed_cars_only(t.passages(), listed)).count()

    finish(apps.area_distribution_bloom(spark, lines=lines, out=f"{root}/counts", size="1 day",
                                        bits=1 << 20, delay="1 hour"))
    counts = spark.read.parquet(f"{root}/counts").groupBy("count_key").agg(F.max("distinct_cars"))
    assert counts.count() > 0


def test_more_apps_end_to_end(spark):
    from roadwatch.operators import avg_speed, dangerous_driving, interval_join, pair_actions
    from roadwatch.sources.lines import POLICE_FIELDS, VIOLATION_FIELDS
    t = Tables(spark, SF)
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    to_lines(t.passages()).coalesce(1).write.text(f"{root}/p/a")
    to_lines(t.violations(), VIOLATION_FIELDS).coalesce(1).write.text(f"{root}/v/a")
    to_lines(t.police_actions(), POLICE_FIELDS).coalesce(1).write.text(f"{root}/a/a")
    time.sleep(1.1)
    spark.createDataFrame([(SENTINEL,)], "value string").coalesce(1).write.text(f"{root}/p/b")
    spark.createDataFrame([("SENTINEL,error,7000000000000",)], "value string").coalesce(1).write.text(f"{root}/v/b")
    spark.createDataFrame([("0,SENTINEL,done,7000000000000",)], "value string").coalesce(1).write.text(f"{root}/a/b")
    t.monitors().write.parquet(f"{root}/stations")
    p, v, a = f"{root}/p/*", f"{root}/v/*", f"{root}/a/*"

    finish(apps.average_speed(spark, lines=p, out=f"{root}/avg", size="1 day", slide="6 hours", delay="1 hour"))
    assert spark.read.parquet(f"{root}/avg").count() == avg_speed(t.passages(), "1 day", "6 hours").count()

    finish(apps.dangerous_driving(spark, lines=p, stations=f"{root}/stations", within="24 hours",
                                  delay="1 hour", sink="memory"))
    want = dangerous_driving(t.passages(), t.monitors(), within="24 hours").count()
    got = spark.table("dangerous_driving")
    assert got.count() == want and got.where(F.col("message").startswith("该车辆涉嫌危险驾驶")).count() == want

    finish(apps.police_join(spark, violations=v, actions=a, lower="-2 hours", upper="2 hours",
                            delay="1 hour", sink="memory"))
    vv = t.violations().withColumnRenamed("event_id", "violation_id")
    aa = t.police_actions().withColumnRenamed("event_id", "action_id")
    assert spark.table("police_join").where("car != 'SENTINEL'").count() == \
        interval_join(vv, aa, lower="-2 hours", upper="2 hours").count()

    outs = {k: f"{root}/{k}" for k in ["matched", "no_police", "no_violation"]}
    finish(apps.police_pairing(spark, violations=v, actions=a, outcomes=outs, timeout="12 hours",
                               delay="1 hour"))
    batch = pair_actions(t.violations(), t.police_actions(), "12 hours").groupBy("outcome").count().collect()
    for r in batch:
        assert spark.read.parquet(outs[r.outcome]).where("car != 'SENTINEL'").count() == r["count"]

    finish(apps.area_distribution(spark, lines=p, size="1 day", delay="1 hour", sink="memory"))
    assert spark.table("area_distribution").count() > 0


def test_cli_runs_a_batch_program(spark):
    t = Tables(spark, SF)
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    to_lines(t.passages()).coalesce(1).write.text(f"{root}/log")
    t.violations().select("car", "msg", "create_time").write.parquet(f"{root}/list")
    apps.main(["vehicle_tracks", "--opt", f"log={root}/log", "--opt", f"violation_list={root}/list",
               "--opt", f"out={root}/tracks"])
    listed = t.violations().select("car")
    assert spark.read.parquet(f"{root}/tracks").count() == \
        track_rows(listed_cars_only(t.passages(), listed)).count()
