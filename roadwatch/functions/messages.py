"""Optional display text columns. Typed columns are the contract; these
render the reference's console/alert messages from them with ``format_string``
(JVM-side, no Python)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's display templates, in its wording.
AREA_TEMPLATE = "区域%s,在窗口其实时间%d,到窗口结束时间%d ,一共有%d 辆车"
TOP_N_HEADER = "在窗口%d ----%d 时间范围内:"
TOP_N_TITLE = "整个城市最拥堵的前%d个卡口是:"
TOP_N_ITEM = "卡口:%s,经过的车辆数量为:%d,平均车速为:%s"
DANGER_HEADER = "该车辆涉嫌危险驾驶,"
DANGER_ITEM = "第%d个经过卡口是:%s -->"
POLICE_ON_SCENE = "车辆%s,已经有交警出警了，警号为:%s,出警的状态是：%s,出警的时间:%d"
PAIR_MATCHED = "该违法车辆%s，违法时间%d,已经有交警出警了，警号为:%s,出警的状态是：%s,出警的时间:%d"
NO_VIOLATION_LABEL = "没有对应的违法车辆信息"
NO_POLICE_LABEL = "该违法车辆在5分钟内没有交警出警"


def area_message(df: DataFrame) -> DataFrame:
    return df.withColumn("message", F.format_string(AREA_TEMPLATE, "area_id", "start_time",
                                                    "end_time", "car_count"))


def top_n_message(top: DataFrame, n: int = 3) -> DataFrame:
    """One message per window from H1's output (at most ``n`` rows per window)."""
    items = F.array_sort(F.collect_list(F.struct("rank", "monitor_id", "car_count", "avg_speed")))
    text = F.concat(
        F.format_string(TOP_N_HEADER, F.min("start_time"), F.col("end_time")), F.lit(TOP_N_TITLE % n),
        F.array_join(F.transform(items, lambda x: F.format_string(
            TOP_N_ITEM, x["monitor_id"], x["car_count"], x["avg_speed"].cast("string"))), ""),
        F.lit("\n"))
    return top.groupBy("end_time").agg(text.alias("message"))


def danger_message(df: DataFrame) -> DataFrame:
    items = F.transform("monitor_ids", lambda m, i: F.format_string(DANGER_ITEM, i + 1, m))
    return df.withColumn("message", F.concat(F.lit(DANGER_HEADER), F.array_join(items, "")))


def police_message(df: DataFrame) -> DataFrame:
    return df.withColumn("message", F.format_string(POLICE_ON_SCENE, "car", "police_id",
                                                    "action_status", "action_time"))


def pair_message(df: DataFrame) -> DataFrame:
    """Text for D6 outcomes: the matched message, or the side-output label."""
    matched = F.format_string(PAIR_MATCHED, "car", "create_time", "police_id", "action_status",
                              "action_time")
    return df.withColumn("message", F.when(F.col("outcome") == "matched", matched)
                         .when(F.col("outcome") == "no_violation", F.lit(NO_VIOLATION_LABEL))
                         .otherwise(F.lit(NO_POLICE_LABEL)))
