"""Record layouts (snake_case) of the passage, station, violation and police streams."""

from pyspark.sql import types as T

PASSAGE = T.StructType([
    T.StructField("action_time", T.LongType()),   # epoch milliseconds
    T.StructField("monitor_id", T.StringType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("car", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("area_id", T.StringType()),
])
PASSAGE_COLS = [f.name for f in PASSAGE.fields]

MONITOR = T.StructType([
    T.StructField("monitor_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("speed_limit", T.IntegerType()),
    T.StructField("area_id", T.StringType()),
])

SPEEDING = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("monitor_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("real_speed", T.DoubleType()),
    T.StructField("limit_speed", T.IntegerType()),
    T.StructField("action_time", T.LongType()),
])
SPEEDING_COLS = [f.name for f in SPEEDING.fields]

AVERAGE_SPEED = T.StructType([
    T.StructField("start_time", T.LongType()),
    T.StructField("end_time", T.LongType()),
    T.StructField("monitor_id", T.StringType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("car_count", T.IntegerType()),
])

VIOLATION = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("create_time", T.LongType()),
])
VIOLATION_COLS = [f.name for f in VIOLATION.fields]

POLICE_ACTION = T.StructType([
    T.StructField("police_id", T.StringType()),
    T.StructField("car", T.StringType()),
    T.StructField("action_status", T.StringType()),
    T.StructField("action_time", T.LongType()),
])
POLICE_COLS = [f.name for f in POLICE_ACTION.fields]

CLONE_WARNING = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("first_monitor", T.StringType()),
    T.StructField("second_monitor", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("action_time", T.LongType()),
])

TRACK = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("car", T.StringType()),
    T.StructField("action_time", T.LongType()),
    T.StructField("monitor_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("area_id", T.StringType()),
    T.StructField("speed", T.DoubleType()),
])
TRACK_COLS = [f.name for f in TRACK.fields]

# Output tables of the sinks: name -> column list (positional, as inserted).
TABLES = {
    "speeding": SPEEDING_COLS,
    "average_speed": [f.name for f in AVERAGE_SPEED.fields],
    "violation_list": ["car", "violation", "create_time"],
    "track_info": TRACK_COLS,
}
