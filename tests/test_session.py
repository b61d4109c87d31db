"""Scale settings apply to a live session and do not change results."""

from roadwatch.session import SCALE_CONF, apply_scale_conf, checkpoint_root
from roadwatch.operators import avg_speed
from roadwatch.sources.derived import Tables


def test_scale_conf_applies_and_results_hold(spark):
    before = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    p = Tables(spark, "/root/testdata/sf0.001").passages()
    want = sorted(tuple(r) for r in avg_speed(p, "1 day", "6 hours").collect())
    try:
        apply_scale_conf(spark, {"spark.sql.shuffle.partitions": "64"})
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(256 * 1024 ** 2)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
        got = sorted(tuple(r) for r in avg_speed(p, "1 day", "6 hours").collect())
        assert got == want
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert checkpoint_root(spark)                   # a checkpoint folder is always available
