"""Named queries over a scale-factor folder: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the *whole*
derived tables. Time spans are scaled to the test data (events are minutes
apart, so the reference's seconds-long spans would almost never fire); the
operators' defaults remain the reference's constants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.operators import (
    area_distinct, area_distinct_approx, area_distinct_running, area_distinct_sliding, avg_speed, clone_plate_cars, clone_plates,
    count_batches, dangerous_driving, distinct_from_panes, distinct_panes, interval_join, limits_as_of, newest_tracks,
    overspeed_passages, pair_actions,
    top_n_monitors, tracks, with_limits,
)
from roadwatch.schemas import PASSAGE_COLS
from roadwatch.functions.messages import area_message, top_n_message
from roadwatch.sinks.writers import split_outcomes, upsert_counts, violations_to_insert
from roadwatch.sources.derived import Tables, passages_from_events, violations_from_events
from roadwatch.sources.lines import (
    POLICE_FIELDS, VIOLATION_FIELDS, parse_passages, parse_police_actions, parse_violations, to_lines,
)
from roadwatch.sources.tables import read_monitors, read_violations

# Parameters of the registered queries (test-data scale).
AVG_SIZE, AVG_SLIDE = "1 day", "6 hours"
AREA_WINDOW = "1 day"
CLONE_WITHIN_S = 3600
LIST_CLONE_WITHIN_S = 300   # violation list behind `tracks`: ~40 % of cars at every scale
DANGER_WITHIN = "24 hours"
MATCH_SPAN = "2 hours"
PAIR_TIMEOUT = "12 hours"
BATCH_N = 7
TOP_N = 3
NEWEST_K = 5
BLOOM_BITS = 4096           # small enough here that bits do collide


def q_parse_passages(spark: SparkSession, sf: str) -> DataFrame:
    lines = to_lines(Tables(spark, sf).passages())
    return parse_passages(lines, mode="failfast")


def _mixed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Passage lines where ``signup`` events arrive as 5-field lines (the shape of
    the reference simulator's malformed sends); all other events are whole."""
    p = passages_from_events(Tables(spark, sf).events(), extra=("event_type",))
    whole = F.concat_ws(",", *[F.col(c).cast("string") for c in PASSAGE_COLS])
    short = F.concat_ws(",", *[F.col(c).cast("string") for c in
                               ["action_time", "monitor_id", "camera_id", "car", "road_id"]])
    return p.select(F.when(F.col("event_type") == "signup", short).otherwise(whole).alias("value"))


def q_parse_passages_permissive(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = parse_passages(_mixed_lines(spark, sf), mode="permissive")
    return good


def q_parse_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = parse_passages(_mixed_lines(spark, sf), mode="permissive")
    return rejected


def q_overspeed(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return overspeed_passages(t.passages(), t.monitors())


def q_limits_with_default(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return with_limits(t.passages(), t.monitors(), default=60)


def q_avg_speed(spark: SparkSession, sf: str) -> DataFrame:
    return avg_speed(Tables(spark, sf).passages(), AVG_SIZE, AVG_SLIDE)


def q_top_n_monitors(spark: SparkSession, sf: str) -> DataFrame:
    top = top_n_monitors(q_avg_speed(spark, sf), TOP_N)
    return top.withColumn("rank", F.col("rank").cast("long"))


def q_area_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return area_distinct(Tables(spark, sf).passages(), AREA_WINDOW)


def q_area_distinct_running(spark: SparkSession, sf: str) -> DataFrame:
    return area_distinct_running(Tables(spark, sf).passages(), AREA_WINDOW)


def q_area_distinct_approx(spark: SparkSession, sf: str) -> DataFrame:
    return area_distinct_approx(Tables(spark, sf).passages(), AREA_WINDOW)


def q_clone_plates(spark: SparkSession, sf: str) -> DataFrame:
    return clone_plates(Tables(spark, sf).passages(), within_s=CLONE_WITHIN_S)


def q_dangerous_driving(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    m = dangerous_driving(t.passages(), t.monitors(), factor=1.2, times=3,
                          within=DANGER_WITHIN, default=60)
    return m.withColumn("monitor_ids", F.array_join("monitor_ids", ","))


def q_dangerous_driving_first(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    m = dangerous_driving(t.passages(), t.monitors(), factor=1.2, times=3,
                          within=DANGER_WITHIN, default=60, emit="first")
    return m.withColumn("monitor_ids", F.array_join("monitor_ids", ","))


def _match_inputs(spark: SparkSession, sf: str):
    t = Tables(spark, sf)
    v = t.violations().withColumnRenamed("event_id", "violation_id")
    a = t.police_actions().withColumnRenamed("event_id", "action_id")
    return v, a


def q_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    v, a = _match_inputs(spark, sf)
    return interval_join(v, a, "create_time", "action_time", f"-{MATCH_SPAN}", MATCH_SPAN)


def q_interval_join_outer(spark: SparkSession, sf: str) -> DataFrame:
    v, a = _match_inputs(spark, sf)
    return interval_join(v, a, "create_time", "action_time", f"-{MATCH_SPAN}", MATCH_SPAN,
                         how="full_outer", left_id="violation_id", right_id="action_id")


def q_pair_actions(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return pair_actions(t.violations(), t.police_actions(), PAIR_TIMEOUT)


def q_pair_actions_replay(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return pair_actions(t.violations(), t.police_actions(), PAIR_TIMEOUT, mode="replay")


def q_violations_per_day(spark: SparkSession, sf: str) -> DataFrame:
    """New violations (``error`` events) against a stored list (``signup`` events)."""
    t = Tables(spark, sf)
    existing = violations_from_events(t.events(), "signup").select("car", "msg", "create_time")
    return violations_to_insert(t.violations(), existing)


def q_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Tracks of listed violators. As in the original chain, the violation list is
    what the clone-plate job writes: every car with a clone-plate warning (here
    within 5 minutes)."""
    passages = Tables(spark, sf).passages()
    return tracks(passages, clone_plate_cars(passages, within_s=LIST_CLONE_WITHIN_S))


def q_tracks_reduced(spark: SparkSession, sf: str) -> DataFrame:
    """As `tracks`, passages cut down by the list's bitmap before they are shuffled."""
    passages = Tables(spark, sf).passages()
    return tracks(passages, clone_plate_cars(passages, within_s=LIST_CLONE_WITHIN_S), reduce=True)


def q_newest_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return newest_tracks(q_tracks(spark, sf), NEWEST_K)


def q_parse_violations(spark: SparkSession, sf: str) -> DataFrame:
    return parse_violations(to_lines(Tables(spark, sf).violations(), VIOLATION_FIELDS))


def q_parse_police_actions(spark: SparkSession, sf: str) -> DataFrame:
    return parse_police_actions(to_lines(Tables(spark, sf).police_actions(), POLICE_FIELDS))


def q_station_table(spark: SparkSession, sf: str) -> DataFrame:
    """The station reader takes columns by position: here supplier's first four."""
    return read_monitors(spark, f"{sf}/supplier.parquet").drop("area_id")


def q_violation_table(spark: SparkSession, sf: str) -> DataFrame:
    """The violation-list reader by position: lineitem's order, part and supplier keys."""
    return read_violations(spark, f"{sf}/lineitem.parquet")


def q_outcome_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The side outputs of the pairing, each under its tag."""
    sides = split_outcomes(q_pair_actions(spark, sf))
    out = None
    for tag, df in sides.items():
        part = df.withColumn("side", F.lit(tag))
        out = part if out is None else out.unionByName(part)
    return out


def q_area_counters(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_counts(q_area_distinct_running(spark, sf), value="distinct_cars")


def q_area_distinct_running_bloom(spark: SparkSession, sf: str) -> DataFrame:
    return area_distinct_running(Tables(spark, sf).passages(), AREA_WINDOW, method="bloom", bits=BLOOM_BITS)


def q_area_messages(spark: SparkSession, sf: str) -> DataFrame:
    return area_message(q_area_distinct(spark, sf))


def q_top_n_messages(spark: SparkSession, sf: str) -> DataFrame:
    return top_n_message(q_top_n_monitors(spark, sf), TOP_N)


def q_count_batches(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).passages().select(*PASSAGE_COLS, "event_id")
    return count_batches(p, BATCH_N, ("action_time", "event_id"))


def q_limits_as_of(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return limits_as_of(t.passages(), t.station_history())


def q_area_distinct_panes(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding distinct counts from stored sketches beside the exact ones: the estimate must
    lie within three standard errors (1.04 / sqrt(2**12) each)."""
    t = Tables(spark, sf)
    panes = distinct_panes(t.passages(), AVG_SLIDE)
    estimates = distinct_from_panes(panes, AVG_SIZE, AVG_SLIDE, AVG_SLIDE)
    exact = area_distinct_sliding(t.passages(), AVG_SIZE, AVG_SLIDE)
    both = exact.join(estimates.withColumnRenamed("car_count", "estimate"), ["start_time", "end_time", "area_id"], "full")
    error = F.abs(F.col("estimate") - F.col("car_count"))
    return both.select("start_time", "end_time", "area_id", "car_count",
                       F.coalesce(error <= F.greatest(F.lit(1.0), 3 * 1.04 / 64 * F.col("car_count")), F.lit(False)).alias("within_3_rsd"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_passages": q_parse_passages,
    "parse_passages_permissive": q_parse_passages_permissive,
    "parse_rejects": q_parse_rejects,
    "overspeed": q_overspeed,
    "limits_with_default": q_limits_with_default,
    "avg_speed": q_avg_speed,
    "top_n_monitors": q_top_n_monitors,
    "area_distinct": q_area_distinct,
    "area_distinct_running": q_area_distinct_running,
    "area_distinct_approx": q_area_distinct_approx,
    "clone_plates": q_clone_plates,
    "dangerous_driving": q_dangerous_driving,
    "dangerous_driving_first": q_dangerous_driving_first,
    "interval_join": q_interval_join,
    "interval_join_outer": q_interval_join_outer,
    "pair_actions": q_pair_actions,
    "pair_actions_replay": q_pair_actions_replay,
    "violations_per_day": q_violations_per_day,
    "tracks": q_tracks,
    "count_batches": q_count_batches,
    "parse_violations": q_parse_violations,
    "parse_police_actions": q_parse_police_actions,
    "station_table": q_station_table,
    "violation_table": q_violation_table,
    "newest_tracks": q_newest_tracks,
    "tracks_reduced": q_tracks_reduced,
    "outcome_tables": q_outcome_tables,
    "area_counters": q_area_counters,
    "area_distinct_running_bloom": q_area_distinct_running_bloom,
    "area_messages": q_area_messages,
    "top_n_messages": q_top_n_messages,
    "limits_as_of": q_limits_as_of,
    "area_distinct_panes": q_area_distinct_panes,
}
