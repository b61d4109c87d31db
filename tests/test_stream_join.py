"""The stream interval join with a third of all rows on one car, and rows without a car or time."""

import pytest
from test_bounded_streams import finished, landed, same

from roadwatch.operators import interval_join
from roadwatch.streaming import jobs

COLS = ["car", "create_time", "violation_id", "action_time", "action_id"]


def busy(spark):
    def car(i):
        return "hot" if i % 3 == 0 else None if i % 7 == 0 else f"c{i % 20}"
    v = spark.createDataFrame([(car(i), "m", None if i % 31 == 0 else 100_000 + i * 900, i) for i in range(300)],
                              "car string, msg string, create_time long, violation_id long")
    a = spark.createDataFrame([(f"p{i}", car(i), "s", None if i % 29 == 0 else 100_000 + i * 900 + (i % 5 - 2) * 2_500, i) for i in range(300)],
                              "police_id string, car string, action_status string, action_time long, action_id long")
    return v, a


def test_hot_car_is_spread_over_time_buckets(spark, tmp_path):
    v, a = busy(spark)
    fv, fa = f"{tmp_path}/v", f"{tmp_path}/a"
    out = jobs.stream_interval_join(landed(spark, v, fv, "create_time"), landed(spark, a, fa, "action_time"), delay="1 hour")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert any("Join Inner" in line and "_jb" in line and "car" in line for line in plan.splitlines())
    same(finished(spark, out, "join", tmp_path, fv, fa), interval_join(v, a, "create_time", "action_time"), COLS)


def test_outer_form_reports_each_row_once(spark, tmp_path):
    v, a = busy(spark)
    a = a.unionByName(a.where("action_id < 9"))  # repeated rows are rows
    fv, fa = f"{tmp_path}/v", f"{tmp_path}/a"
    out = jobs.stream_interval_join(landed(spark, v, fv, "create_time"), landed(spark, a, fa, "action_time"), delay="1 hour", how="full_outer")
    plan = out._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 2 and all("LeftOuter" in line and "_jb" in line for line in joins)
    got, want = finished(spark, out, "outer", tmp_path, fv, fa), interval_join(v, a, "create_time", "action_time", how="full_outer")
    same(got, want, [*COLS, "msg", "police_id", "action_status"])
    for alone in ("violation_id IS NULL", "action_id IS NULL", "car IS NULL", "car = 'hot' AND action_id IS NULL"):
        assert got.where(alone).count() > 0


def test_outer_form_lets_go_of_rows_as_the_watermark_passes(spark, tmp_path):
    """With a short delay, rows without a partner come out before the input ends."""
    v = spark.createDataFrame([("a", "m", 1_000_000 * i, i) for i in range(1, 7)], "car string, msg string, create_time long, violation_id long")
    a = spark.createDataFrame([("p", "a" if i % 2 else "b", "s", 1_000_000 * i + 10_000, i) for i in range(1, 7)],
                              "police_id string, car string, action_status string, action_time long, action_id long")
    fv, fa = f"{tmp_path}/v", f"{tmp_path}/a"
    for i in range(1, 7):  # one file after the other, so that they are read in this order
        v.where(f"violation_id = {i}").coalesce(1).write.mode("append").parquet(fv)
        a.where(f"action_id = {i}").coalesce(1).write.mode("append").parquet(fa)
    streams = [spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f) for df, f in ((v, fv), (a, fa))]
    out = jobs.stream_interval_join(*streams, "0 seconds", "10 seconds", "1 second", "full_outer")
    q = jobs.start(out, f"outer-early-{tmp_path.name}", sink="parquet", path=f"{tmp_path}/early", trigger={"availableNow": True})
    q.awaitTermination()
    early = spark.read.parquet(f"{tmp_path}/early")
    assert early.where("violation_id IS NULL").count() > 0 and early.where("action_id IS NULL").count() > 0
    want = {(r.violation_id, r.action_id) for r in interval_join(v, a, lower="0 seconds", upper="10 seconds", how="full_outer").collect()}
    rows = [(r.violation_id, r.action_id) for r in early.collect()]
    assert len(rows) == len(set(rows)) and set(rows) <= want


@pytest.mark.parametrize("ids", [{"violation_id": "event_id", "action_id": "event_id"}, {}])
def test_outer_form_with_other_id_names_or_none(spark, tmp_path, ids):
    v = spark.createDataFrame([("a", "m", 100_000, 2 ** 60 + 1), ("b", "m", None, 2)], "car string, msg string, create_time long, event_id long")
    a = spark.createDataFrame([("p", "a", "s", 101_000, 2 ** 60 + 3), ("p", "c", "s", 50_000, 4)],
                              "police_id string, car string, action_status string, action_time long, event_id long")
    fv, fa = f"{tmp_path}/v", f"{tmp_path}/a"
    out = jobs.stream_interval_join(landed(spark, v, fv, "create_time"), landed(spark, a, fa, "action_time"), delay="1 hour", how="full_outer", **ids)
    got = {(r.car, r.create_time, r.action_time) for r in finished(spark, out, "ids", tmp_path, fv, fa).collect()}
    assert got == {("a", 100_000, 101_000), ("b", None, None), ("c", None, 50_000)}
    if ids:
        assert {(r.violation_id, r.action_id) for r in spark.read.parquet(f"{tmp_path}/out-ids").collect()} == \
            {(2 ** 60 + 1, 2 ** 60 + 3), (2, None), (None, 4)}
    else:
        assert out.columns == ["car", "msg", "create_time", "police_id", "action_status", "action_time"]
