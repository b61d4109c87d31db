"""Stream forms equal their batch forms (file streams + a far-future sentinel row,
because an exhausted file source never advances the watermark on its own)."""

import tempfile
import time

import pytest
from pyspark.sql import functions as F

from roadwatch.operators import (
    area_distinct, area_distinct_running, avg_speed, clone_plates, dangerous_driving, interval_join,
    pair_actions,
)
from roadwatch.sinks import violations_to_insert
from roadwatch.sources.derived import Tables
from roadwatch.sources.lines import parse_passages, to_lines
from roadwatch.streaming import jobs

SF = "/root/testdata/sf0.001"
SENTINEL_MS = 7_000_000_000_000   # year 2191: past every window, inside pandas' range
SENT = "SENTINEL"


@pytest.fixture(scope="module")
def data(spark):
    t = Tables(spark, SF)
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    out = {"t": t, "root": root}
    p = t.passages()
    sentinel_p = spark.createDataFrame(
        [(SENTINEL_MS, "9999", "00000", SENT, 1.0, "0", "0", 10**12)], p.schema)
    v, a = t.violations(), t.police_actions()
    out["p_dir"], out["v_dir"], out["a_dir"] = f"{root}/passages", f"{root}/violations", f"{root}/actions"
    # One data file, then (written later, read in a later micro-batch) the sentinel.
    for d, df in [(out["p_dir"], p), (out["v_dir"], v), (out["a_dir"], a)]:
        df.coalesce(1).write.parquet(d + "/0")
    time.sleep(1.1)
    sentinel_p.coalesce(1).write.parquet(out["p_dir"] + "/1")
    spark.createDataFrame([(SENT, "error", SENTINEL_MS, 10**12)], v.schema) \
        .coalesce(1).write.parquet(out["v_dir"] + "/1")
    spark.createDataFrame([("0", SENT, "done", SENTINEL_MS, 10**12 + 1)], a.schema) \
        .coalesce(1).write.parquet(out["a_dir"] + "/1")
    out["p_schema"], out["v_schema"], out["a_schema"] = p.schema, v.schema, a.schema
    return out


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path + "/*")


def drain(df, name, output_mode="append"):
    q = jobs.start(df, name, output_mode=output_mode)
    try:
        q.processAllAvailable()
        deadline = time.time() + 60
        while time.time() < deadline:   # let the watermark-only (no-data) batches run
            time.sleep(0.5)
            q.processAllAvailable()
            prog = q.lastProgress
            if prog and prog.get("numInputRows", 1) == 0 and not q.status["isDataAvailable"]:
                break
        q.processAllAvailable()
        return [tuple(r) for r in df.sparkSession.table(name).collect()]
    finally:
        q.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_text_stream_clone_plates(spark, data):
    root = data["root"]
    to_lines(data["t"].passages()).coalesce(1).write.text(f"{root}/lines/a")
    spark.createDataFrame([(f"{SENTINEL_MS},0000,00000,{SENT},1.0,0,0",)], "value string") \
        .coalesce(1).write.text(f"{root}/lines/b")
    ps = parse_passages(spark.readStream.format("text").load(f"{root}/lines/*"))
    got = drain(jobs.stream_clone_plates(ps, within_s=3600, id_col="none"), "s_clone_text")
    want = rows(clone_plates(data["t"].passages(), within_s=3600))
    assert sorted(got) == sorted(want) and len(want) > 0


def test_stream_dangerous_driving(spark, data):
    ps = stream_of(spark, data["p_dir"], data["p_schema"])
    s = jobs.stream_dangerous_driving(ps, data["t"].monitors(), within="24 hours", delay="1 hour")
    got = sorted((c, st, en, n, ",".join(m)) for c, st, en, n, m, _ in drain(s, "s_danger") if c != SENT)
    b = dangerous_driving(data["t"].passages(), data["t"].monitors(), within="24 hours")
    want = sorted((r.car, r.start_time, r.end_time, r.n_events, ",".join(r.monitor_ids)) for r in b.collect())
    assert got == want and len(want) > 0


def test_stream_pair_replay(spark, data):
    vs = stream_of(spark, data["v_dir"], data["v_schema"])
    acts = stream_of(spark, data["a_dir"], data["a_schema"])
    s = jobs.stream_pair_actions_replay(vs, acts, timeout="12 hours", delay="1 hour")
    got = sorted((r[0], r[1], r[2], r[5]) for r in drain(s, "s_pairs") if r[0] != SENT)
    t = data["t"]
    b = pair_actions(t.violations(), t.police_actions(), "12 hours", mode="replay")
    want = sorted((r.car, r.outcome, r.violation_id, r.action_id) for r in b.collect())
    assert got == want and len(want) > 0


def test_stream_bloom_running_distinct(spark, data):
    ps = stream_of(spark, data["p_dir"], data["p_schema"])
    s = jobs.stream_area_distinct_bloom(ps, size="1 day", bits=1 << 20, delay="1 hour")
    got = {r[5]: r[6] for r in drain(s, "s_bloom") if r[3] != SENT}
    exact = {r.event_id: r.distinct_cars for r in
             area_distinct_running(data["t"].passages(), "1 day").collect()}
    assert set(got) == set(exact)
    assert all(got[k] <= exact[k] for k in exact)                 # a Bloom filter only undercounts
    assert sum(got[k] == exact[k] for k in exact) >= 0.99 * len(exact)


def test_stream_windows_equal_batch(spark, data):
    ps = stream_of(spark, data["p_dir"], data["p_schema"])
    got = drain(jobs.stream_avg_speed(ps, "1 day", "6 hours", delay="1 hour"), "s_avg")
    want = rows(avg_speed(data["t"].passages(), "1 day", "6 hours"))
    assert sorted(got) == sorted(want)
    ps2 = stream_of(spark, data["p_dir"], data["p_schema"])
    got2 = drain(jobs.stream_area_distinct(ps2, "1 day", delay="1 hour"), "s_area")
    want2 = rows(area_distinct(data["t"].passages(), "1 day").select("start_time", "end_time", "area_id", "car_count"))
    assert sorted(got2) == sorted(want2)
    ps3 = stream_of(spark, data["p_dir"], data["p_schema"])
    got3 = drain(jobs.stream_area_distinct_approx(ps3, "1 day", delay="1 hour"), "s_area_hll")
    assert len(got3) == len(want2)


def test_stream_interval_joins(spark, data):
    t = data["t"]
    v = t.violations().withColumnRenamed("event_id", "violation_id")
    a = t.police_actions().withColumnRenamed("event_id", "action_id")
    cols = ["car", "msg", "create_time", "violation_id", "police_id", "action_status", "action_time", "action_id"]
    for how in ["inner", "full_outer"]:
        vs = stream_of(spark, data["v_dir"], data["v_schema"]).withColumnRenamed("event_id", "violation_id")
        acts = stream_of(spark, data["a_dir"], data["a_schema"]).withColumnRenamed("event_id", "action_id")
        s = jobs.stream_interval_join(vs, acts, "-2 hours", "2 hours", delay="1 hour", how=how)
        got = sorted((r for r in drain(s, f"s_join_{how}") if r[0] != SENT), key=str)
        b = interval_join(v, a, "create_time", "action_time", "-2 hours", "2 hours", how=how,
                          left_id="violation_id", right_id="action_id").select(*cols)
        assert got == sorted(rows(b), key=str)


def test_foreach_batch_sinks_with_refreshed_dimension(spark, data):
    """A8 + B1/B3 through foreachBatch: the station table is reloaded per micro-batch,
    violations are appended at most once per car and day across batches."""
    root = data["root"]
    out_speed, out_viol = f"{root}/speeding", f"{root}/violation_list"
    from roadwatch.operators import overspeed_passages
    from roadwatch.sinks import write_table

    def each(batch, dim, epoch):
        batch.persist()
        write_table(overspeed_passages(batch, dim), "speeding", out_speed)
        viol = batch.select("car", F.lit("overspeed").alias("msg"),
                            F.col("action_time").alias("create_time"), "event_id")
        try:
            stored = spark.read.parquet(out_viol)
        except Exception:
            stored = None
        write_table(violations_to_insert(viol, stored), "violation_list", out_viol)
        batch.unpersist()

    ps = stream_of(spark, data["p_dir"], data["p_schema"]).where(F.col("car") != SENT)
    q = jobs.with_refreshed_dim(ps, lambda s: Tables(s, SF).monitors(), each) \
        .option("checkpointLocation", f"{root}/ckpt-a8").start()
    q.processAllAvailable()
    q.stop()
    t = data["t"]
    assert spark.read.parquet(out_speed).count() == overspeed_passages(t.passages(), t.monitors()).count()
    stored = spark.read.parquet(out_viol)
    per_day = stored.groupBy("car", F.expr("create_time div 86400000")).count()
    assert per_day.where("count > 1").count() == 0


def _feed_files(spark, root, batches, schema, start=0):
    """One parquet file per micro-batch, written in order."""
    for i, rows in enumerate(batches, start):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{i:03d}")
        time.sleep(1.05)


def test_window_closes_at_end_plus_delay(spark, data):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    schema = data["p_schema"]

    def row(t, i):
        return (t, "0001", "00000", "c", 10.0, "1", "1", i)

    q = None
    try:
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(root + "/*")
        _feed_files(spark, root, [[row(1_000, 1)]], schema)
        agg = jobs.stream_avg_speed(src, "1 minute", "1 minute", delay="5 seconds")
        q = jobs.start(agg, "s_close")
        q.processAllAvailable()
        _feed_files(spark, root, [[row(64_999, 2)]], schema, 1)     # watermark 59,999 < end 60,000
        q.processAllAvailable(); time.sleep(1); q.processAllAvailable()
        assert spark.table("s_close").count() == 0
        _feed_files(spark, root, [[row(65_000, 3)]], schema, 2)     # watermark 60,000: [0, 60 s) closes
        q.processAllAvailable(); time.sleep(1); q.processAllAvailable()
        got = [tuple(r) for r in spark.table("s_close").collect()]
        assert got == [(0, 60_000, "0001", 10.0, 1)]
    finally:
        if q is not None:
            q.stop()


def test_stream_top_n_and_processing_time(spark, data):
    from roadwatch.operators import top_n_monitors
    out = []
    ps = stream_of(spark, data["p_dir"], data["p_schema"])
    avg = jobs.stream_avg_speed(ps, "1 day", "6 hours", delay="1 hour")
    writer = jobs.top_n_batch_writer(3, lambda df, epoch: out.extend(tuple(r) for r in df.collect()))
    q = jobs.start(avg, "s_topn", foreach_batch=writer)
    try:
        for _ in range(6):
            q.processAllAvailable()
            time.sleep(0.5)
    finally:
        q.stop()
    want = rows(top_n_monitors(avg_speed(data["t"].passages(), "1 day", "6 hours"), 3))
    assert sorted(out) == sorted(want)
    ps2 = stream_of(spark, data["p_dir"], data["p_schema"])
    q2 = jobs.start(jobs.stream_area_distinct(ps2, "10 seconds", time="processing"), "s_proc")
    try:
        q2.processAllAvailable()
        assert q2.exception() is None
    finally:
        q2.stop()


def test_bloom_vectorised_equals_row_by_row():
    import random as _r
    from roadwatch.streaming.machines import BloomDistinct
    rnd = _r.Random(4)
    recs = [{"area_id": "1", "start_time": 0, "end_time": 1, "car": f"c{rnd.randint(0, 300)}",
             "action_time": i, "event_id": i, "bit1": rnd.randint(0, 511), "bit2": rnd.randint(0, 511)}
            for i in range(1500)]
    a, b, out_a, out_b = BloomDistinct(None, 512), BloomDistinct(None, 512), [], []
    a.feed_all(recs[:700], out_a)
    a = BloomDistinct(a.dump(), 512)            # state survives a round trip between batches
    a.feed_all(recs[700:], out_a)
    for r in recs:
        b.feed(r, out_b)
    assert [o["distinct_cars"] for o in out_a] == [o["distinct_cars"] for o in out_b]


def test_stream_pair_paired_equals_batch(spark, data):
    vs = stream_of(spark, data["v_dir"], data["v_schema"])
    acts = stream_of(spark, data["a_dir"], data["a_schema"])
    s = jobs.stream_pair_actions(vs, acts, timeout="12 hours", delay="1 hour")
    got = sorted((r[0], r[1], r[2], r[5]) for r in drain(s, "s_paired") if r[0] != SENT)
    t = data["t"]
    b = pair_actions(t.violations(), t.police_actions(), "12 hours")
    want = sorted((r.car, r.outcome, r.violation_id, r.action_id) for r in b.collect())
    assert got == want and len(want) > 0


def test_machines_release_state():
    from roadwatch.streaming.machines import BloomDistinct, ClonePlates, PairOneToOne, SevereChains
    out = []
    b = BloomDistinct(None, 64)
    b.feed({"area_id": "1", "start_time": 0, "end_time": 600, "car": "c", "action_time": 5,
            "event_id": 1, "bit1": 3, "bit2": 9}, out)
    assert b.wakeups() == [599] and not b.empty()
    b.advance(599, out)
    assert b.empty()                                  # the window's bitmap is dropped
    c = ClonePlates(None, 10)
    c.feed({"car": "x", "action_time": 0, "monitor_id": "m"}, out)
    c.advance(10_999, out)
    assert not c.empty()
    c.advance(11_000, out)
    assert c.empty()                                  # no later passage can hit it
    s = SevereChains(None, 3, 120_000)
    s.feed({"car": "x", "action_time": 0, "monitor_id": "m"}, out)
    s.advance(120_000, out)
    assert s.empty()
    p = PairOneToOne(None, 5_000)
    p.feed({"car": "x", "kind": 0, "t": 0, "violation_id": 1, "create_time": 0, "msg": "e",
            "action_id": None, "police_id": None, "action_status": None, "action_time": None}, out)
    p.advance(5_000, out)
    assert p.empty() and out[-1]["outcome"] == "no_police"


def test_stream_exact_running_distinct_equals_batch(spark, data):
    ps = stream_of(spark, data["p_dir"], data["p_schema"])
    s = jobs.stream_area_distinct_running(ps, size="1 day", method="exact", delay="1 hour")
    got = {r[5]: r[6] for r in drain(s, "s_exact_running") if r[3] != SENT}
    exact = {r.event_id: r.distinct_cars for r in
             area_distinct_running(data["t"].passages(), "1 day").collect()}
    assert got == exact
