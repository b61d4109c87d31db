import pytest
from conftest import passages_df

from roadwatch.operators import listed_cars_only, maybe_listed


def cars(df):
    return sorted((r.car is None, r.car or "", r.event_id) for r in df.collect())


def world(spark):
    rows = [(i * 1_000, "A", None if i % 3 == 0 else f"car{i % 200}", 1.0, i) for i in range(900)]   # a third without a car
    listed = [(f"car{i}",) for i in range(0, 200, 9)] * 2 + [(None,), ("elsewhere",)]
    return passages_df(spark, rows), spark.createDataFrame(listed, "car string")


@pytest.mark.parametrize("bits", [1 << 15, 1 << 16, 1 << 27])
def test_filter_keeps_every_listed_row(spark, bits):
    passages, listed = world(spark)
    wanted = cars(listed_cars_only(passages, listed))
    kept = maybe_listed(passages, listed, bits=bits)
    assert kept.columns == passages.columns and wanted and set(wanted) <= set(cars(kept))
    assert kept.count() <= len(wanted) + 30                      # few others
    assert cars(listed_cars_only(kept, listed)) == wanted == cars(listed_cars_only(passages, listed, reduce=True))


def test_crowded_filter_is_still_right(spark):
    passages, listed = world(spark)
    assert cars(listed_cars_only(maybe_listed(passages, listed, bits=8), listed)) == cars(listed_cars_only(passages, listed))


def test_empty_sides(spark):
    passages, listed = world(spark)
    assert maybe_listed(passages, listed.limit(0)).count() == 0
    assert listed_cars_only(passages.limit(0), listed, reduce=True).count() == 0


def test_passages_are_cut_down_before_their_shuffle(spark, tmp_path):
    passages, listed = world(spark)
    passages.write.parquet(str(tmp_path / "p"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # a list beyond broadcast size
    try:
        out = listed_cars_only(spark.read.parquet(str(tmp_path / "p")), listed, reduce=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # From the join down to the scan of the passages: exchange, bitmap join with the bit test.
    join, exchange, bitmap, bit = (plan.index(x) for x in ("SortMergeJoin", "Exchange hashpartitioning(car", "BroadcastHashJoin", "getbit"))
    assert join < exchange < bitmap < bit < plan.index("FileScan parquet")
