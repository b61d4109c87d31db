"""Passage, station, violation and police-action tables derived from the
driver's ``events`` and ``supplier`` tables (the reference ships no data).

Every derivation is a projection/filter of a parquet scan, so Catalyst prunes
columns and pushes the ``event_type`` filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.functions.columns import ts_to_millis


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def passages_from_events(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One passage per event; ``event_id`` is kept as the tie-breaking id and
    ``extra`` event columns are carried along.

    ``k`` is extracted from the JSON once into a staged column (the optimizer
    keeps a non-trivial expression used three times in its own projection).
    """
    # ``k`` comes out of a one-element generator: filters the optimizer infers on
    # the derived keys (e.g. ``isnotnull(area_id)`` for joins) then stay above it
    # and reuse the parsed value instead of parsing the JSON again per filter;
    # filters on the other columns (time, ids) still reach the scan.
    staged = events.select("event_id", "ts", "user_id", "value", *extra,
                           F.inline(F.array(F.struct(_k().alias("_k")))))
    k = F.col("_k")
    return staged.select(
        ts_to_millis("ts").alias("action_time"),
        F.lpad(k.cast("string"), 4, "0").alias("monitor_id"),
        F.lpad((F.col("event_id") % 100000).cast("string"), 5, "0").alias("camera_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("car"),
        F.col("value").alias("speed"),
        (k % 20).cast("string").alias("road_id"),
        (k % 10).cast("string").alias("area_id"),
        F.col("event_id"),
        *extra,
    )


def monitors_from_supplier(supplier: DataFrame) -> DataFrame:
    """Station table: zero limits (every 7th supplier) are dropped like C3 does."""
    limit = F.when(F.col("s_suppkey") % 7 == 0, F.lit(0)) \
        .otherwise(F.lit(20) + F.lit(10) * (F.col("s_nationkey") % 8))
    return supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 4, "0").alias("monitor_id"),
        (F.col("s_suppkey") % 20).cast("string").alias("road_id"),
        limit.cast("int").alias("speed_limit"),
        (F.col("s_suppkey") % 10).cast("string").alias("area_id"),
    ).where(F.col("speed_limit") > 0)


def station_history_from_events(events: DataFrame, event_type: str = "signup") -> DataFrame:
    """Versions of the station table: each event of the type sets its station's limit from
    then on (every 7th sets none)."""
    limit = F.when(F.col("event_id") % 7 == 0, F.lit(0)).otherwise(F.lit(20) + F.lit(10) * (F.col("event_id") % 8))
    return events.where(F.col("event_type") == event_type).select(
        F.lpad(_k().cast("string"), 4, "0").alias("monitor_id"), ts_to_millis("ts").alias("valid_from"), limit.cast("int").alias("speed_limit"))


def violations_from_events(events: DataFrame, event_type: str = "error") -> DataFrame:
    return events.where(F.col("event_type") == event_type).select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("car"),
        F.lit(event_type).alias("msg"),
        ts_to_millis("ts").alias("create_time"),
        F.col("event_id"),
    )


def police_actions_from_events(events: DataFrame, event_type: str = "click") -> DataFrame:
    return events.where(F.col("event_type") == event_type).select(
        _k().cast("string").alias("police_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("car"),
        F.lit("done").alias("action_status"),
        ts_to_millis("ts").alias("action_time"),
        F.col("event_id"),
    )


class Tables:
    """Lazy accessors for the derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def events(self) -> DataFrame:
        return load(self.spark, self.sf_dir, "events")

    def passages(self) -> DataFrame:
        return passages_from_events(self.events())

    def monitors(self) -> DataFrame:
        return monitors_from_supplier(load(self.spark, self.sf_dir, "supplier"))

    def station_history(self) -> DataFrame:
        return station_history_from_events(self.events())

    def violations(self, event_type: str = "error") -> DataFrame:
        return violations_from_events(self.events(), event_type)

    def police_actions(self, event_type: str = "click") -> DataFrame:
        return police_actions_from_events(self.events(), event_type)
