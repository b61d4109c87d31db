import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadwatch.plans.scan import keyed_scan, with_time_bucket


def test_keyed_scan_equals_plain_windows(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.randint(0, 50_000), i, rnd.randint(-5, 5)) for i, k in
            enumerate(rnd.choice(["hot"] * 8 + ["a", "b"]) for _ in range(800))]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, v int")
    got = keyed_scan(with_time_bucket(df, "t", 997), ["k"], ["t", "id"], [
        ("p", "prev", F.col("v")), ("n", "next", F.col("id")),
        ("s", "sum", F.col("v")), ("m", "max", F.col("v"))])
    w = Window.partitionBy("k").orderBy("t", "id")
    cum = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.lag("v").over(w).alias("p"), F.lead("id").over(w).alias("n"),
                     F.sum("v").over(cum).alias("s"), F.max("v").over(cum).alias("m"))
    a = sorted(tuple(r) for r in got.select("id", "p", "n", "s", "m").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


def test_island_scan_equals_plain_windows(spark):
    from roadwatch.plans.scan import island_scan
    rnd = random.Random(9)
    rows, i = [], 0
    for k in ["hot", "a", "b"]:
        t = 0
        for _ in range(600 if k == "hot" else 80):
            t += rnd.choice([0, 5, 10, 11, 40, 300])
            rows.append((k, t, i, rnd.randint(0, 1)))
            i += 1
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, kind int")

    def link(p, c):
        return (p["kind"] != c["kind"]) & (c["t"] - p["t"] <= 10)

    got = island_scan(with_time_bucket(df, "t", 97), ["k"], ["t", "id"],
                      F.struct(F.col("t").alias("t"), F.col("kind").alias("kind"), F.col("id").alias("id")), link)
    got = {r.id: (r["_prev"]["id"] if r["_prev"] else None, r._link, r._next_link, r._seq, r._island_start)
           for r in got.collect()}
    want = {}
    by = {}
    for k, t, i, kind in rows:
        by.setdefault(k, []).append((t, i, kind))
    for k, rs in by.items():
        rs.sort()
        links = [False] + [rs[j][2] != rs[j - 1][2] and rs[j][0] - rs[j - 1][0] <= 10 for j in range(1, len(rs))]
        start = 0
        for j, (t, i, kind) in enumerate(rs):
            if not links[j]:
                start = j
            nxt = links[j + 1] if j + 1 < len(rs) else None
            want[i] = (rs[j - 1][1] if j else None, links[j], nxt, j, start)
    assert got == want
