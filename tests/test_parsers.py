import pytest
from pyspark.errors import PySparkException

from roadwatch.sources.lines import parse_passages, parse_police_actions, parse_violations


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_permissive_rejects_and_keeps(spark):
    good, bad = parse_passages(lines(spark, [
        "1000,0001,00001,C1,55.5,01,02",           # ok
        "11,22,33,44,5",                            # 5 fields: reject
        "1000,0001,00001,C1,fast,01,02",            # non-numeric speed: reject
        "2000,0002,00002,C2,60.0,03,04,x,y",        # 9 fields: first 7 kept
        "1000,0001,00001,C1,55.5,01,",              # trailing empty field drops: short
    ]), mode="permissive")
    g = sorted(tuple(r) for r in good.collect())
    assert g == [(1000, "0001", "00001", "C1", 55.5, "01", "02"),
                 (2000, "0002", "00002", "C2", 60.0, "03", "04")]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad double in speed", "expected 7 fields, got 5", "expected 7 fields, got 6"]


def test_failfast_raises(spark):
    df = parse_passages(lines(spark, ["1000,0001,00001,C1,55.5,01,02", "11,22,33,44,5"]))
    with pytest.raises(PySparkException):
        df.collect()


def test_failfast_ok(spark):
    df = parse_passages(lines(spark, ["1000,0001,00001,C1,55.5,01,02"]))
    assert df.collect()[0].speed == 55.5


def test_other_parsers(spark):
    v = parse_violations(lines(spark, ["C1,error,5000"])).collect()[0]
    assert (v.car, v.msg, v.create_time) == ("C1", "error", 5000)
    p = parse_police_actions(lines(spark, ["7,C1,done,6000"])).collect()[0]
    assert (p.police_id, p.car, p.action_status, p.action_time) == ("7", "C1", "done", 6000)
