from conftest import monitors_df, passages_df

from roadwatch.operators import listed_cars_only, overspeed_passages, with_limits


def test_overspeed_edge(spark):
    # limit < 1.1 * speed: 1.1 * 100.0 is 110.00000000000001 in double -> hit; 99.9 -> miss.
    p = passages_df(spark, [(1, "A", "c1", 100.0), (2, "A", "c2", 99.9), (3, "Z", "c3", 500.0)])
    m = monitors_df(spark, [("A", 110)])
    out = overspeed_passages(p, m).collect()
    assert [r.car for r in out] == ["c1"]
    assert out[0].limit_speed == 110 and out[0].real_speed == 100.0


def test_duplicate_and_zero_stations(spark):
    p = passages_df(spark, [(1, "A", "c1", 50.0)])
    m = monitors_df(spark, [("A", 60), ("A", 40), ("A", 0)])
    out = overspeed_passages(p, m).collect()
    assert len(out) == 1 and out[0].limit_speed == 40   # one row per station, lowest positive limit


def test_default_limit(spark):
    p = passages_df(spark, [(1, "A", "c1", 50.0), (2, "Q", "c2", 50.0)])
    m = monitors_df(spark, [("A", 80)])
    got = {r.car: r.limit_speed for r in with_limits(p, m, default=60).collect()}
    assert got == {"c1": 80, "c2": 60}


def test_semi_join_never_multiplies(spark):
    p = passages_df(spark, [(1, "A", "c1", 50.0), (2, "A", "c2", 50.0)])
    listed = spark.createDataFrame([("c1",), ("c1",), ("c1",)], "car string")
    assert [r.car for r in listed_cars_only(p, listed).collect()] == ["c1"]
