"""Windows closed by the clock."""

import time

from pyspark.sql import functions as F

from roadwatch.streaming import jobs


def test_window_closes_without_further_input(spark, tmp_path):
    rows = [("hot" if i % 3 else f"a{i % 4}", None if i % 7 == 0 else f"c{i % 40}", None if i % 11 == 0 else i) for i in range(300)]
    rows += [("empty", None, 5), (None, "x", 6)]
    df = spark.createDataFrame(rows, "area_id string, car string, action_time long")
    folder = f"{tmp_path}/in"
    df.coalesce(1).write.parquet(folder)
    name = "clock" + "".join(c for c in tmp_path.name if c.isalnum())
    out = jobs.stream_area_distinct_clock(spark.readStream.schema(df.schema).parquet(folder), "2 seconds", shards=4)
    q = jobs.start(out, name, trigger={"processingTime": "1 second"})
    try:
        until = time.time() + 90
        while time.time() < until and q.isActive and not spark.table(name).count():
            time.sleep(1)
        got = spark.table(name).groupBy("area_id", "start_time", "end_time").agg(F.sum("car_count").alias("n"), F.count("*").alias("shards")).collect()
        first = q.lastProgress["batchId"]
        while time.time() < until and q.isActive and q.lastProgress["batchId"] < first + 2:
            time.sleep(1)
        again = spark.table(name).groupBy("area_id").agg(F.sum("car_count").alias("n")).collect()
        state = sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"])
    finally:
        q.stop()
    want = {r.area_id: r.n for r in df.groupBy("area_id").agg(F.count_distinct("car").alias("n")).collect()}
    assert {r.area_id: r.n for r in got} == want and want["empty"] == 0
    assert all(r.end_time - r.start_time == 2000 for r in got) and {r.area_id: r.shards for r in got}["hot"] == 4
    assert {r.area_id: r.n for r in again} == want  # each window once
    assert state == 0  # and nothing of it stays
