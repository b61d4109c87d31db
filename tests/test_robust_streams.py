"""Disorder across micro-batches, restarts with a new checkpoint, whole alert output, NULL keys."""

import tempfile
import time

import pytest
from pyspark.sql import functions as F

from roadwatch import apps
from roadwatch.functions.messages import area_message
from roadwatch.operators import area_distinct, area_distinct_running, clone_plates, count_batches, duration_ms, pair_actions
from roadwatch.sources.lines import parse_passages, read_lines_stream
from roadwatch.streaming import jobs
from roadwatch.streaming.sinks import epoch_writer, table_writer, track_writer, violation_writer

from conftest import passages_df

SCHEMA = "action_time bigint, monitor_id string, camera_id string, car string, speed double, road_id string, area_id string, event_id bigint"
FAR = 7_000_000_000_000


def passage(t, car, monitor="m", event_id=0, area="1"):
    return (t, monitor, "0", car, 1.0, "1", area, event_id or t)


def feed(spark, batches):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/{i:03d}")
        time.sleep(1.05)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(root + "/*")


def drain(df, name):
    q = jobs.start(df, name)
    try:
        for _ in range(4):
            q.processAllAvailable()
            time.sleep(0.5)
        return df.sparkSession.table(name).collect()
    finally:
        q.stop()


def test_late_passages_still_make_a_clone_hit(spark):
    batches = [[passage(200_000, "Y")], [passage(100_000, "X", "a"), passage(101_000, "X", "b")], [passage(FAR, "end")]]
    got = drain(jobs.stream_clone_plates(feed(spark, batches), delay="0 seconds"), "late_clones")
    want = clone_plates(spark.createDataFrame(sum(batches, []), SCHEMA)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) == 1


def test_late_passages_of_a_window_are_counted_or_reported(spark):
    batches = [[passage(100_000, "a")], [passage(500_000, "b")], [passage(200_000, "c")], [passage(1_000_000, "z")],
               [passage(300_000, "d")], [passage(FAR, "end")]]
    rows = drain(jobs.stream_area_distinct_running(feed(spark, batches), "10 minutes", "exact", delay="0 seconds"), "late_counts")
    got = {r.car: r.distinct_cars for r in rows}
    assert set(got) == {"a", "b", "c", "z", "d"} | ({"end"} & set(got))
    assert (got["a"], got["b"], got["c"], got["z"], got["d"]) == (1, 2, 3, 1, None)


def test_processing_time_running_count(spark):
    batches = [[passage(5, "a"), passage(900_000, "b", event_id=7)], [passage(1, "a", event_id=9)], [passage(FAR, "end")]]
    df = jobs.stream_area_distinct_running(feed(spark, batches), "1 day", "exact", time="processing")
    rows = drain(df, "arrival_counts")
    assert [r.distinct_cars for r in sorted(rows, key=lambda r: (r.action_time, r.event_id)) if r.car in "ab"][:3] in ([1, 2, 2], [1, 2])


def violations(spark, rows):
    return spark.createDataFrame([(c, "m", t, t) for c, t in rows], "car string, msg string, create_time long, event_id long")


def test_a_new_checkpoint_adds_rows(spark, tmp_path):
    target = str(tmp_path / "v")
    violation_writer(target)(violations(spark, [("X", 10)]), 0)
    violation_writer(target)(violations(spark, [("Y", 20), ("X", 30)]), 0)
    assert sorted(r.car for r in spark.read.parquet(target).collect()) == ["X", "Y"]
    again = violation_writer(target, run_id="same")
    for _ in range(2):
        again(violations(spark, [("Z", 40)]), 0)
    assert sorted(r.car for r in spark.read.parquet(target).collect()) == ["X", "Y", "Z"]
    tracks = str(tmp_path / "t")
    for monitor in ("A", "B"):
        track_writer(tracks)(passages_df(spark, [(1_000, monitor, "c1", 1.0, 1)]), 0)
    assert spark.read.parquet(tracks).count() == 2


def test_runs_follow_the_stream_checkpoint(spark, tmp_path):
    source = feed(spark, [[passage(1, "a")], [passage(2, "b")]])
    target = str(tmp_path / "e")
    for name in ("first", "first", "second"):
        q = source.writeStream.option("checkpointLocation", str(tmp_path / f"ckpt-{name}")).foreachBatch(epoch_writer(target)).start()
        q.processAllAvailable()
        q.stop()
    runs = spark.read.parquet(target).groupBy("run").count().collect()
    assert len(runs) == 2 and {r["count"] for r in runs} == {2}


def test_unreadable_table_fails_the_batch(spark, tmp_path):
    bad = tmp_path / "v" / "day=0" / "run=x" / "epoch=0"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        violation_writer(str(tmp_path / "v"))(violations(spark, [("X", 10)]), 0)


def test_every_alert_reaches_the_table_and_the_console(spark, tmp_path, capfd):
    lines = [f"{1000 + i},{i % 7:04d},0,C{i},200.0,1,{i}" for i in range(60)] + [f"{FAR},0,0,end,1.0,0,0"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    passages = parse_passages(read_lines_stream(spark, "text", str(tmp_path / "in")))
    q = apps._alerts(area_message(jobs.stream_area_distinct(passages)), "all_alerts", str(tmp_path / "out"), "console")
    for _ in range(4):
        q.processAllAvailable()
        time.sleep(0.5)
    q.stop()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.where("start_time = 0").count() == 60 and got.where("length(message) > 20").count() >= 60
    from roadwatch.sinks import write_console
    write_console(spark.range(45).withColumn("t", F.repeat(F.lit("y"), 50)))
    out = capfd.readouterr().out
    assert out.count("y" * 50) == 45


def test_null_keys_and_times_keep_their_rows(spark):
    rows = [passage(t, c, event_id=i + 1, area=a) for i, (t, c, a) in enumerate(
        [(1, "x", "1"), (2, "x", None), (3, "y", None), (4, None, None), (5, "z", "1")])]
    df = spark.createDataFrame(rows, SCHEMA)
    for method in ("exact", "bloom"):
        got = {r.event_id: r.distinct_cars for r in area_distinct_running(df, method=method).collect()}
        assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 2}
    assert {r.area_id: r.car_count for r in area_distinct(df).collect()} == {"1": 2, None: 2}
    timed = spark.createDataFrame([passage(i if i else None, "c", event_id=i + 1) for i in range(10)], SCHEMA)
    assert count_batches(timed, 5).count() == 10
    same = spark.createDataFrame([passage(1, None, "a", 1), passage(2, None, "b", 2)], SCHEMA)
    assert clone_plates(same).count() == 1
    v = spark.createDataFrame([(None, "m", 1, 1)], "car string, msg string, create_time long, event_id long")
    a = spark.createDataFrame([("p", None, "done", 2, 1), ("p", "z", "done", 2, 2)],
                              "police_id string, car string, action_status string, action_time long, event_id long")
    assert sorted(r.outcome for r in pair_actions(v, a).collect()) == ["matched", "no_violation"]


def test_durations():
    assert [duration_ms(x) for x in ("5 ms", "2 s", "3 seconds", "1 day", "4 mins", 7)] == [5, 2000, 3000, 86_400_000, 240_000, 7]


def test_table_writer_outside_a_stream(spark, tmp_path):
    df = violations(spark, [("X", 1)])
    for _ in range(2):
        table_writer("violation_list", str(tmp_path / "t"))(df, 0)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


@pytest.mark.parametrize("mode", ["paired", "replay"])
def test_pairing_waits_for_the_input_that_lags_and_keeps_late_records(spark, tmp_path, mode):
    v_schema = "car string, create_time long, msg string, event_id long"
    p_schema = "car string, action_time long, police_id string, action_status string, event_id long"
    for d in "vp":
        (tmp_path / d).mkdir()

    def put(d, n, rows):
        spark.createDataFrame(rows, v_schema if d == "v" else p_schema).coalesce(1).write.parquet(f"{tmp_path}/{d}/{n}")

    put("v", 0, [("A", 100_000, "m", 1), ("B", 200_000, "m", 2)])
    put("p", 0, [("C", 50_000, "p", "s", 10)])
    v = spark.readStream.schema(v_schema).parquet(f"{tmp_path}/v/*")
    p = spark.readStream.schema(p_schema).parquet(f"{tmp_path}/p/*")
    q = jobs.start(jobs.stream_pair_actions(v, p, mode=mode), f"lag_{mode}")
    try:
        for n, (d, rows) in enumerate([("p", [("A", 101_000, "p", "s", 11)]), ("p", [("Z", 900_000, "p", "s", 12)]),
                                       ("v", [("Z", 900_000, "m", 3)]), ("v", [("L", 300_000, "m", 4)]),
                                       ("v", [("Y", FAR, "m", 5)]), ("p", [("Y", FAR, "p", "s", 13)])], 1):
            q.processAllAvailable()
            put(d, n, rows)
        q.processAllAvailable()
        got = {(r.car, r.outcome, r.violation_id, r.action_id) for r in spark.table(f"lag_{mode}").collect()}
    finally:
        q.stop()
    assert {("A", "matched", 1, 11), ("B", "no_police", 2, None), ("C", "no_violation", None, 10),
            ("Z", "matched", 3, 12), ("L", "no_police", 4, None)} <= got
    assert not any(car == "A" and outcome != "matched" for car, outcome, _, _ in got)
