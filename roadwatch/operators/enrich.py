"""Station-limit enrichment and list filters.

The station table is a dimension: it is deduplicated to one row per station,
so the join can never multiply passages. The joins carry no hint: Spark
broadcasts a side whose measured bytes are below its thresholds and otherwise
shuffles both, and AQE's skew split handles a hot station.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from roadwatch.functions.columns import DEFAULT_LIMIT, OVERSPEED_FACTOR, newest_first_key, overspeed, with_tie_id
from roadwatch.plans.scan import DEFAULT_BUCKET_MS, bucketed, keyed_scan
from roadwatch.schemas import TRACK_COLS
from roadwatch.sources.tables import one_row_per_station


def station_limits(monitors: DataFrame) -> DataFrame:
    """``(monitor_id, limit_speed)``: one row per station with a positive limit."""
    return one_row_per_station(monitors.where(F.col("speed_limit") > 0)) \
        .select("monitor_id", F.col("speed_limit").alias("limit_speed"))


def _speeding_projection(df: DataFrame, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    # road_id comes from the passage, not from the station row.
    extra = [c for c in df.columns if c in keep]
    return df.select("car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
                     F.col("limit_speed").cast("int").alias("limit_speed"), "action_time", *extra)


def overspeed_passages(passages: DataFrame, monitors: DataFrame,
                       factor: float = OVERSPEED_FACTOR) -> DataFrame:
    """D1 + C1 + C5: passages of known stations with ``limit < factor * speed``.

    Passages of stations missing from the table produce nothing (inner join).
    """
    joined = passages.join(station_limits(monitors), "monitor_id", "inner")
    return _speeding_projection(joined.where(overspeed("limit_speed", "speed", factor)))


def with_limits(passages: DataFrame, monitors: DataFrame, default: int = DEFAULT_LIMIT,
                keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """D2 + C7: every passage with its station limit, ``default`` for unknown stations."""
    joined = passages.join(station_limits(monitors), "monitor_id", "left")
    return _speeding_projection(
        joined.withColumn("limit_speed", F.coalesce(F.col("limit_speed"), F.lit(int(default)))), keep)


def limits_as_of(passages: DataFrame, history: DataFrame, default: int = DEFAULT_LIMIT, id_col: str = "event_id",
                 bucket_ms: int = DEFAULT_BUCKET_MS, bucketing: str = "time") -> DataFrame:
    """D2 with the limit that was valid when the car passed (A8): every passage with the
    latest limit of its station at or before its time, ``default`` if there is none.

    ``history(monitor_id, valid_from, speed_limit)`` is every version of the
    station table; rows without a positive limit or a time are no versions (C3),
    and of equal times the lowest limit holds. Passages without a time or
    station have the default. An as-of join without a range join: passages and
    versions are one sequence per station, and the last version is carried
    along it by a skew-safe scan, so a busy station is spread over time buckets.
    """
    versions = history.where("speed_limit > 0 AND valid_from IS NOT NULL").groupBy("monitor_id", "valid_from").agg(F.min("speed_limit").alias("_limit"))
    versions = versions.select("monitor_id", F.col("valid_from").alias("action_time"), F.lit(0).alias("_kind"), "_limit")
    rows = with_tie_id(passages, id_col).drop("limit_speed").withColumn("_kind", F.lit(1))
    order = ["action_time", "_kind", id_col]
    both = bucketed(rows.unionByName(versions, allowMissingColumns=True), ["monitor_id"], order, "action_time", bucket_ms, bucketing)
    scanned = keyed_scan(both, ["monitor_id"], order, [("limit_speed", "last", F.col("_limit"))])
    known = F.col("action_time").isNotNull() & F.col("monitor_id").isNotNull()
    return _speeding_projection(scanned.where("_kind = 1").withColumn(
        "limit_speed", F.coalesce(F.when(known, F.col("limit_speed")), F.lit(int(default)))), (id_col,))


#: Bits of the list bitmap: 16 MB however long the list.
LIST_BITS = 1 << 27


def maybe_listed(rows: DataFrame, listed: DataFrame, on: str = "car", bits: int = LIST_BITS) -> DataFrame:
    """``rows`` without most of those whose ``on`` is not in ``listed`` (none of the others; NULL
    is never listed), before any shuffle of them.

    The list is aggregated into a one-hash Bloom filter of ``bits`` bits: pieces of
    4 KB, combined map-side, at most ``bits / 32768`` rows, so its broadcast is
    bounded by ``bits / 8`` bytes. About ``cars / bits`` of the unlisted rows
    stay: a semi join on what is left decides.
    """
    def spot(c):
        return F.pmod(F.xxhash64(c), F.lit(bits))
    marks = listed.where(F.col(on).isNotNull()).select(spot(on).alias("_s")) \
        .groupBy(F.bitmap_bucket_number("_s").alias("_b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_s")).alias("_m"))
    byte = "cast(conv(hex(substring(_m, cast(_p div 8 as int) + 1, 1)), 16, 10) as int)"
    return rows.where(F.col(on).isNotNull()).withColumns({"_b": F.bitmap_bucket_number(spot(on)), "_p": F.bitmap_bit_position(spot(on))}) \
        .join(F.broadcast(marks), "_b").where(F.expr(f"getbit({byte}, cast(_p % 8 as int)) = 1")).drop("_b", "_p", "_m")


def listed_cars_only(passages: DataFrame, listed: DataFrame, reduce: bool = False) -> DataFrame:
    """D3 + C4: passages whose car appears in the list (membership; duplicates never multiply).

    The list is reduced to distinct cars (partial aggregation) before the
    semi join; adaptive execution broadcasts it when its measured size is
    small and keeps a shuffle join otherwise. For a list beyond broadcast size
    ``reduce`` drops passages by :func:`maybe_listed` ahead of that shuffle, for
    one more read of the list.
    """
    cars = listed.select("car").distinct()
    if reduce:  # an inner join with distinct cars: Spark would move a semi join below the filter's
        return maybe_listed(passages, listed).join(cars, "car")
    return passages.join(cars, "car", "left_semi")


def track_rows(passages: DataFrame) -> DataFrame:
    """C6 + C8: track projection with the newest-first row key."""
    extra = [c for c in passages.columns if c == "event_id"]
    return passages.select(newest_first_key("car", "action_time").alias("row_key"),
                           *[c for c in TRACK_COLS if c != "row_key"], *extra)


def last_write_per_row_key(tracks: DataFrame, tie: str = "event_id") -> DataFrame:
    """B4 upsert semantics in batch: one row per ``row_key``, the last written wins.

    Rows sharing a key (same car, same millisecond) are resolved by the write
    sequence where the table has one (``written_ms``), then by ``tie`` (arrival
    order; without that column a hash of the record, so reruns agree). A grouped
    ``max_by`` aggregates partially map-side, so a hot key never gathers in
    one task.
    """
    cols = [c for c in TRACK_COLS if c != "row_key"]
    seq = [F.col("written_ms")] if "written_ms" in tracks.columns else []
    rows = with_tie_id(tracks, tie)
    agg = rows.groupBy("row_key").agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*seq, F.col(tie))).alias("_w"))
    return agg.select("row_key", *[F.col(f"_w.{c}").alias(c) for c in cols])


def tracks(passages: DataFrame, violations: DataFrame, reduce: bool = False) -> DataFrame:
    """D3 + C6 + C8 + B4: newest-first track rows of the cars in the violation list,
    one row per row key (the last write wins). ``reduce`` as in :func:`listed_cars_only`."""
    return last_write_per_row_key(track_rows(listed_cars_only(passages, violations, reduce)))


def newest_tracks(track_table: DataFrame, k: int = 10) -> DataFrame:
    """H2: the ``k`` newest track rows of every car (a top-k report), with their ``rank``.

    Row keys sort newest first; the row number is cut to ``k`` per car before the shuffle.
    """
    n = F.row_number().over(Window.partitionBy("car").orderBy("row_key"))
    return track_table.withColumn("rank", n.cast("long")).where(F.col("rank") <= int(k))


__all__ = ["tracks", "overspeed_passages", "with_limits", "listed_cars_only", "maybe_listed", "track_rows",
           "last_write_per_row_key", "newest_tracks", "station_limits"]
