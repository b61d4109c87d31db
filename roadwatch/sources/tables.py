"""Dimension and list tables (A7, A9), from JDBC or files.

Columns are taken by position, as the reference's SELECT lists them, and the
positive-limit filter (C3) is expressed as a DataFrame filter so Catalyst
pushes it into the JDBC query or the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _load(spark: SparkSession, source: str, fmt: str, options: dict) -> DataFrame:
    if fmt == "jdbc":
        return spark.read.format("jdbc").option("url", source).options(**options).load()
    return spark.read.format(fmt).options(**options).load(source)


def read_monitors(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """A7 + C3: ``monitor_id, road_id, speed_limit, area_id`` with ``speed_limit > 0``.

    A JDBC source names its table with ``dbtable=`` (default ``t_monitor_info``)."""
    if fmt == "jdbc":
        options.setdefault("dbtable", "t_monitor_info")
    raw = _load(spark, source, fmt, options)
    c = raw.columns
    return raw.select(F.col(c[0]).cast("string").alias("monitor_id"),
                      F.col(c[1]).cast("string").alias("road_id"),
                      F.col(c[2]).cast("int").alias("speed_limit"),
                      F.col(c[3]).cast("string").alias("area_id")) \
        .where(F.col("speed_limit") > 0)


def read_violations(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """The stored violation list ``car, msg, create_time`` (read once; JDBC: ``dbtable=``)."""
    if fmt == "jdbc":
        options.setdefault("dbtable", "t_violation_list")
    raw = _load(spark, source, fmt, options)
    c = raw.columns
    return raw.select(F.col(c[0]).cast("string").alias("car"),
                      F.col(c[1]).cast("string").alias("msg"),
                      F.col(c[2]).cast("long").alias("create_time"))


def one_row_per_station(monitors: DataFrame) -> DataFrame:
    """Keep one row per ``monitor_id`` (lowest limit, then road) so joins never multiply.

    Expressed as a top-1-per-group window: Spark plans it with a partial
    per-partition group limit before the shuffle, so a station listed many
    times is reduced map-side.
    """
    w = Window.partitionBy("monitor_id").orderBy("speed_limit", "road_id", "area_id")
    return monitors.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
