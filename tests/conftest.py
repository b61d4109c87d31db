import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from roadwatch.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="roadwatch-tests")
    yield s
    s.stop()


def passages_df(spark, rows):
    """rows: (action_time, monitor_id, car, speed[, event_id]) -> full passage frame."""
    from pyspark.sql import functions as F
    full = []
    for i, r in enumerate(rows):
        t, m, car, speed = r[:4]
        eid = r[4] if len(r) > 4 else i
        full.append((int(t), m, "00000", car, float(speed), "1", "1", int(eid)))
    return spark.createDataFrame(
        full, "action_time bigint, monitor_id string, camera_id string, car string, speed double, "
              "road_id string, area_id string, event_id bigint")


def monitors_df(spark, rows):
    """rows: (monitor_id, speed_limit)"""
    return spark.createDataFrame([(m, "1", int(l), "1") for m, l in rows],
                                 "monitor_id string, road_id string, speed_limit int, area_id string")
