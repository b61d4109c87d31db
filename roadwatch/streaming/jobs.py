"""Structured Streaming forms of the operators (section K of the inventory).

Stateless and windowed operators reuse the batch code on a watermarked
stream (append mode); sequential per-key operators run as keyed event-time
folds (:mod:`roadwatch.streaming.state`); sinks are reached through
``foreachBatch``. Every query gets a checkpoint folder under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadwatch.functions.columns import DEFAULT_LIMIT, SEVERE_FACTOR, millis_to_ts, rounded_average, severe_overspeed, with_tie_id
from roadwatch.operators.enrich import overspeed_passages, station_limits
from roadwatch.operators.matching import _REPLAY_SCHEMA, _events
from roadwatch.operators.patterns import CLONE_MSG
from roadwatch.operators.windows import (
    avg_speed, distinct_panes, duration_ms, interval_text, past_end_marker, speed_sums, top_n_monitors, with_event_time,
)
from roadwatch.plans.scan import time_bucket
from roadwatch.session import checkpoint_path
from roadwatch.sources.lines import parse_passages, read_lines_stream
from roadwatch.streaming import machines
from roadwatch.streaming.state import ClockWindow, RunningMarks, fold_by_key, without_time


def watermarked(df: DataFrame, time_col: str, delay, ts_col: str = "ts") -> DataFrame:
    """Event-time column from epoch ms plus a bounded-disorder watermark (5 s / 2 s in the
    reference; its ascending-timestamp jobs get 5 s too, since files and topic
    partitions interleave). The end marker of a bounded input
    (:mod:`roadwatch.streaming.bounded`) moves the watermark and goes no further."""
    return past_end_marker(df.withColumn(ts_col, millis_to_ts(time_col)).withWatermark(ts_col, interval_text(delay)), ts_col)


def passage_stream(spark: SparkSession, path: str, fmt: str = "text", **options) -> DataFrame:
    """A4 + A1: a passage line stream, parsed fail-fast."""
    return parse_passages(read_lines_stream(spark, fmt, path, **options), mode="failfast")


# ---- windowed aggregates: batch code on a watermarked stream ----------------------------

def stream_avg_speed(passages: DataFrame, size="5 minutes", slide="1 minute", delay="5 seconds"):
    """F1 on a stream: each window is emitted once, when the watermark passes its end.

    Where the slide divides the size, two aggregations are chained: a passage
    updates one slide-long pane, and a pane, once closed, is added to the
    ``size / slide`` windows that hold it (by ``window_time``). State writes per
    passage fall from that number to one.
    """
    width, step = duration_ms(size), duration_ms(slide)
    if width % step or width == step:
        return avg_speed(passages, size, slide, watermark=delay)
    panes = with_event_time(passages, watermark=delay).groupBy(F.window("ts", interval_text(step)).alias("_p"), "monitor_id").agg(*speed_sums())
    timed = panes.withColumn("_t", F.window_time("_p"))
    g = timed.groupBy(F.window("_t", interval_text(width), interval_text(step)).alias("w"), "monitor_id") \
        .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    return g.select(F.unix_millis("w.start").alias("start_time"), F.unix_millis("w.end").alias("end_time"), "monitor_id",
                    rounded_average("_s", "_n").alias("avg_speed"), F.col("_n").cast("int").alias("car_count"))


def stream_distinct_panes(passages: DataFrame, pane="10 minutes", delay="5 seconds", lg_k: int = 12) -> DataFrame:
    """F4 on a stream: one stored sketch per area and pane (``pane_start``, ``area_id``,
    ``sketch``), emitted when the pane closes. Append them to a table;
    :func:`roadwatch.operators.distinct_from_panes` merges them into any window."""
    return distinct_panes(passages, pane, lg_k, watermark=delay)


def top_n_batch_writer(n: int, sink: Callable[[DataFrame, int], None]):
    """H1 on a stream: append mode emits every station of a window in the same
    micro-batch, so the per-window ranking is exact inside ``foreachBatch``."""
    def write(batch: DataFrame, epoch: int) -> None:
        sink(top_n_monitors(batch, n), epoch)
    return write


def _window_cols(df: DataFrame, size) -> DataFrame:
    w = F.window("ts", interval_text(size))
    return df.withColumn("_w", w)


def processing_timed(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Processing-time semantics -- the micro-batch's clock is the event time
    (the reference's 10 s area job sets no time characteristic). Not repeatable."""
    return df.withColumn(ts_col, F.current_timestamp()).withWatermark(ts_col, "0 seconds")


def stream_area_distinct(passages: DataFrame, size="10 seconds", delay="5 seconds",
                         time: str = "event") -> DataFrame:
    """F2 on a stream: streaming ``count(DISTINCT)`` is not supported, so cars are
    deduplicated per ``(window, area)`` (state evicted as the watermark passes
    the window) and then counted. ``time="processing"`` windows by arrival (E3)."""
    timed = processing_timed(passages) if time == "processing" \
        else watermarked(passages, "action_time", delay)
    df = _window_cols(timed, size)
    firsts = df.dropDuplicates(["_w", "area_id", "car"])
    g = firsts.groupBy("_w", "area_id").agg(F.count("car").alias("car_count"))  # a missing car is none
    return g.select(F.unix_millis("_w.start").alias("start_time"), F.unix_millis("_w.end").alias("end_time"),
                    "area_id", "car_count")


CLOCK_SCHEMA = T.StructType([
    T.StructField("start_time", T.LongType()), T.StructField("end_time", T.LongType()), T.StructField("area_id", T.StringType()),
    T.StructField("shard", T.LongType()), T.StructField("car_count", T.LongType())])


def stream_area_distinct_clock(passages: DataFrame, size="10 seconds", shards: int = 64) -> DataFrame:
    """F2 / E3 with windows that the clock closes: exact distinct cars per area and
    window of arrival times, in rows of ``shard`` whose ``car_count`` add up.

    A passage belongs to the window of its micro-batch's clock; processing-time
    timers emit a window at its end even if nothing more arrives (with
    ``time="processing"``, :func:`stream_area_distinct` waits for later input).
    A car is in one shard, so ``sum(car_count)`` by window and area is exact,
    and a busy area's state is spread over ``shards`` keys. Passages without a
    car never count, but their window comes out (with 0 if there are no others);
    they are spread by their time. Run it with a processing-time trigger. A
    batch that is run again has the clock of its first attempt.
    """
    size_ms = duration_ms(size)
    now = F.unix_millis(F.current_timestamp())
    keyed = passages.select("area_id", (now - F.pmod(now, F.lit(size_ms))).alias("start_time"),
                            F.pmod(F.xxhash64(F.coalesce("car", F.col("action_time").cast("string"))), F.lit(int(shards))).alias("shard"), "car")
    return keyed.groupBy("area_id", "start_time", "shard").transformWithStateInPandas(
        statefulProcessor=ClockWindow(size_ms, CLOCK_SCHEMA), outputStructType=CLOCK_SCHEMA, outputMode="Append", timeMode="ProcessingTime")


def stream_area_distinct_approx(passages: DataFrame, size="10 minutes", delay="5 seconds",
                                rsd: float = 0.05) -> DataFrame:
    """F4 on a stream: HyperLogLog++ per window and area."""
    df = _window_cols(watermarked(passages, "action_time", delay), size)
    g = df.groupBy("_w", "area_id").agg(F.approx_count_distinct("car", rsd).alias("car_count"))
    return g.select(F.unix_millis("_w.start").alias("start_time"), F.unix_millis("_w.end").alias("end_time"),
                    "area_id", "car_count")


# ---- joins --------------------------------------------------------------------------------

def stream_overspeed(passages: DataFrame, monitors: DataFrame, factor: float = 1.1) -> DataFrame:
    """D1 as a stream-static join with the station table as planned at start; use
    :func:`with_refreshed_dim` (A8) to pick up changes to the table."""
    return overspeed_passages(passages, monitors, factor)


def with_refreshed_dim(stream: DataFrame, loader: Callable[[SparkSession], DataFrame],
                       fn: Callable[[DataFrame, DataFrame, int], None]):
    """Reload the dimension for every micro-batch, then run a batch join inside
    ``foreachBatch``. Returns the ``DataStreamWriter`` (not started): set its
    ``checkpointLocation`` and call ``start()``."""
    def each(batch: DataFrame, epoch: int) -> None:
        fn(batch, loader(batch.sparkSession), epoch)
    return stream.writeStream.foreachBatch(each)


LIMIT_SCHEMA = T.StructType([
    T.StructField("car", T.StringType()), T.StructField("monitor_id", T.StringType()), T.StructField("road_id", T.StringType()),
    T.StructField("real_speed", T.DoubleType()), T.StructField("limit_speed", T.LongType()),
    T.StructField("action_time", T.LongType()), T.StructField("event_id", T.LongType())])


def stream_limits_as_of(passages: DataFrame, history: DataFrame, default: int = DEFAULT_LIMIT, delay="5 seconds",
                        keep="1 hour", id_col: str = "event_id") -> DataFrame:
    """A8 / K broadcast state on streams: each passage with the limit its station had at
    its time, from a stream of table versions (``monitor_id``, ``valid_from``,
    ``speed_limit``). Two inputs, one watermark each; a passage waits until both
    have passed its time, so a version that was in force is never missed. A
    station's state is its newest limit and those of the last ``keep``."""
    p = watermarked(with_tie_id(passages, id_col), "action_time", delay).select(
        "monitor_id", F.lit(1).alias("kind"), F.col("action_time").alias("t"), F.col(id_col).alias("rid"),
        "car", "road_id", F.col("speed").alias("real_speed"), "ts")
    h = watermarked(history, "valid_from", delay).select(
        "monitor_id", F.lit(0).alias("kind"), F.col("valid_from").alias("t"), F.lit(0).cast("long").alias("rid"), "speed_limit", "ts")
    u = p.unionByName(h, allowMissingColumns=True)
    return fold_by_key(u, ["monitor_id"], lambda s: machines.LimitAsOf(s, default, duration_ms(keep)),
                       LIMIT_SCHEMA, "t", ["t", "kind", "rid"])


def stream_interval_join(violations: DataFrame, actions: DataFrame, lower="-5 seconds",
                         upper="5 seconds", delay="2 seconds", how: str = "inner",
                         violation_id: str = "violation_id", action_id: str = "action_id") -> DataFrame:
    """D5 / D7 on streams: watermarks on both sides bound the join state.

    Both forms are keyed by car and time bucket, as in batch: a violation is in
    one bucket, an action in the (at most two) it can match, so a busy car's state
    is spread over the state partitions.

    ``how="full_outer"`` is two left outer joins. In the first, violations are in
    one bucket each: it gives the pairs and, once, each violation without a
    partner. In the second, actions are in one bucket each and violations copied:
    only its actions without a partner are kept, again each once. (A full outer
    join would report every copy.) Each side's rows are held twice for that.
    Rows without a car have no partner and are spread over their buckets; rows
    without a time are reported alone at once. Rows behind the watermark are left
    out, those of the year 1970's first instant or earlier too (Spark's watermark starts there).
    """
    if how not in ("inner", "full_outer"):
        raise ValueError("how must be 'inner' or 'full_outer'")
    lo, hi = duration_ms(lower), duration_ms(upper)
    width = max(hi - lo, 1)
    v, a = watermarked(violations, "create_time", delay, "v_ts"), watermarked(actions, "action_time", delay, "a_ts")
    if how == "full_outer":
        # A key that is never NULL: Spark would filter for named cars below the watermark,
        # which then missed the end marker.
        v, a = [df.where(F.col(ts).isNotNull()).withColumn("_k", F.coalesce(F.concat(F.lit("="), F.col("car")), F.lit(ts)))
                for df, ts in ((v, "v_ts"), (a, "a_ts"))]

    def placed(df: DataFrame, time: str, name: str) -> DataFrame:
        return df.withColumn("_jb", time_bucket(time, width)).alias(name)

    def copied(df: DataFrame, time: str, first: int, last: int, name: str) -> DataFrame:
        ends = [time_bucket(f"({time} + ({d}))", width) for d in (first, last)]
        return df.withColumn("_jb", F.explode(F.sequence(*ends))).alias(name)

    key = "car" if how == "inner" else "_k"
    cond = (F.col("v._jb") == F.col("a._jb")) & (F.col(f"v.{key}") == F.col(f"a.{key}")) \
        & (F.col("a.a_ts") >= F.col("v.v_ts") + F.expr(f"INTERVAL {lo} MILLISECONDS")) \
        & (F.col("a.a_ts") <= F.col("v.v_ts") + F.expr(f"INTERVAL {hi} MILLISECONDS"))
    named = {"v": ("msg", "create_time", violation_id), "a": ("police_id", "action_status", "action_time", action_id)}

    def rows(df: DataFrame, car: str, **sides: str | None) -> DataFrame:
        """The output columns: each side's under its prefix, or NULLs of their type (None)."""
        out = [F.col(car).alias("car")]
        for side, table, of_id in (("v", violations, "violation_id"), ("a", actions, "action_id")):
            for c in named[side]:
                if c in table.columns:
                    value = F.lit(None).cast(table.schema[c].dataType) if sides[side] is None else F.col(sides[side] + c)
                    out.append(value.alias(of_id if c == named[side][-1] else c))
        return df.select(*out)

    pairs = placed(v, "create_time", "v").join(copied(a, "action_time", -hi, -lo, "a"), cond, "inner" if how == "inner" else "left_outer")
    found = rows(pairs, "v.car", v="v.", a="a.")
    if how == "inner":
        return found
    lone = placed(a, "action_time", "a").join(copied(v, "create_time", lo, hi, "v"), cond, "left_outer").where(F.col("v.v_ts").isNull())
    untimed_v, untimed_a = [watermarked(df, time, delay).where(F.col("ts").isNull())
                            for df, time in ((violations, "create_time"), (actions, "action_time"))]
    return found.unionByName(rows(lone, "a.car", v=None, a="a.")) \
        .unionByName(rows(untimed_v, "car", v="", a=None)).unionByName(rows(untimed_a, "car", v=None, a=""))


# ---- keyed event-time folds ---------------------------------------------------------------

CLONE_SCHEMA = T.StructType([
    T.StructField("car", T.StringType()), T.StructField("first_monitor", T.StringType()),
    T.StructField("second_monitor", T.StringType()), T.StructField("msg", T.StringType()),
    T.StructField("action_time", T.LongType())])

DANGER_SCHEMA = T.StructType([
    T.StructField("car", T.StringType()), T.StructField("start_time", T.LongType()),
    T.StructField("end_time", T.LongType()), T.StructField("n_events", T.LongType()),
    T.StructField("monitor_ids", T.ArrayType(T.StringType())), T.StructField("avg_speed", T.DoubleType())])

BLOOM_SCHEMA = T.StructType([
    T.StructField("area_id", T.StringType()), T.StructField("start_time", T.LongType()),
    T.StructField("end_time", T.LongType()), T.StructField("car", T.StringType()),
    T.StructField("action_time", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("distinct_cars", T.LongType())])


MARK_SCHEMA = T.StructType([
    T.StructField("area_id", T.StringType()), T.StructField("start_time", T.LongType()),
    T.StructField("end_time", T.LongType()), T.StructField("car", T.StringType()),
    T.StructField("action_time", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("mark", T.LongType()), T.StructField("late", T.LongType()), T.StructField("ts", T.TimestampType())])


def stream_clone_plates(passages: DataFrame, within_s: int = 10, delay="5 seconds",
                        id_col: str = "event_id") -> DataFrame:
    """I1 on a stream: per-car fold in event-time order (ties by ``id_col``, derived from
    the record if absent). Late passages are compared as they arrive."""
    df = watermarked(with_tie_id(passages, id_col).select("car", "action_time", "monitor_id", id_col), "action_time", delay)
    order = ["action_time", id_col]
    return fold_by_key(df, ["car"], lambda s: machines.ClonePlates(s, within_s, CLONE_MSG),
                       CLONE_SCHEMA, "action_time", order)


def stream_dangerous_driving(passages: DataFrame, monitors: DataFrame, factor: float = SEVERE_FACTOR,
                             times: int = 3, within="2 minutes", default: int = DEFAULT_LIMIT,
                             emit: str = "all", delay="5 seconds", id_col: str = "event_id") -> DataFrame:
    """I2 on a stream: severe passages are filtered in Catalyst (stream-static join with
    the station table), then a per-car fold keeps only the last ``within`` of them."""
    span = duration_ms(within)
    # Watermark the passages themselves (not only the severe ones): every passage advances event time.
    timed = watermarked(with_tie_id(passages, id_col), "action_time", delay)
    hits = _severe_hits(timed, monitors, factor, default, ["car", "action_time", "monitor_id", "ts", id_col])
    order = ["action_time", id_col]
    # As in the reference's pattern matching, passages behind the watermark take no part.
    return fold_by_key(hits, ["car"], lambda s: machines.SevereChains(s, times, span, emit),
                       DANGER_SCHEMA, "action_time", order, late="drop")


def _severe_hits(timed: DataFrame, monitors: DataFrame, factor: float, default: int, keep):
    """Severe passages of a watermarked stream, keeping its event-time column."""
    j = timed.join(station_limits(monitors), "monitor_id", "left") \
        .withColumn("limit_speed", F.coalesce(F.col("limit_speed"), F.lit(int(default))))
    return j.where(severe_overspeed("limit_speed", "speed", factor)).select(*keep)


def stream_pair_actions(violations: DataFrame, actions: DataFrame, timeout="5 seconds",
                        delay="2 seconds", mode: str = "paired", violation_id: str = "event_id",
                        action_id: str = "event_id") -> DataFrame:
    """D6 on streams, ``paired`` (one-to-one, default) or ``replay`` (the original
    timer state machine): both inputs unioned per car, timers in event time."""
    if mode == "replay":
        return stream_pair_actions_replay(violations, actions, timeout, delay, violation_id, action_id)
    u = _pair_events(violations, actions, delay, violation_id, action_id)
    ms = duration_ms(timeout)
    paired = fold_by_key(u, ["car"], lambda s: machines.PairOneToOne(s, ms), _REPLAY_SCHEMA, "t", ["t", "kind", "rid"])
    # A record without a time pairs with nothing: it is reported alone at once.
    alone = without_time(u, "t").select(
        "car", F.when(F.col("kind") == 0, "no_police").otherwise("no_violation").alias("outcome"), *_REPLAY_SCHEMA.fieldNames()[2:])
    return paired.unionByName(alone)


def _pair_events(violations: DataFrame, actions: DataFrame, delay, violation_id: str, action_id: str) -> DataFrame:
    """Both inputs as one stream of events. Ids are derived before event times are added,
    as in the batch form. A watermark per input: Spark goes by the smaller one, so a
    lagging input keeps its partners waiting. Plain column names: leading underscores
    do not survive the trip into the Python fold."""
    v = watermarked(with_tie_id(violations, violation_id), "create_time", delay)
    a = watermarked(with_tie_id(actions, action_id), "action_time", delay)
    return _events(v, a, violation_id, action_id).withColumnsRenamed({"_kind": "kind", "_t": "t", "_id": "rid"})


def stream_pair_actions_replay(violations: DataFrame, actions: DataFrame, timeout="5 seconds",
                               delay="2 seconds", violation_id: str = "event_id",
                               action_id: str = "event_id") -> DataFrame:
    """D6 (replay) on streams: both inputs unioned per car, timers in event time."""
    u = _pair_events(violations, actions, delay, violation_id, action_id)
    ms = duration_ms(timeout)
    return fold_by_key(u, ["car"], lambda s: machines.PairReplay(s, ms), _REPLAY_SCHEMA, "t", ["t", "kind", "rid"])


def stream_area_distinct_running(passages: DataFrame, size="10 minutes", method: str = "bloom",
                                 bits: int = 1 << 22, delay="5 seconds",
                                 id_col: str = "event_id", time: str = "event", shards: int = 64) -> DataFrame:
    """F3 on a stream, one output row per passage: ``method="bloom"`` (fixed
    memory per window, may undercount) or ``"exact"``: the cars of an area's
    window are spread over ``shards`` states, each of which marks first
    passages; a second, chained step adds the marks up and holds one number
    per area and window. A busy area's state and buffers are thus bounded by
    its cars over ``shards``, and no key holds a window's cars whole.
    Passages without a car or a time never count (the latter are left out).
    ``time="processing"`` windows and orders by arrival (E4): a
    passage's time is its micro-batch's clock."""
    if time == "processing":
        passages, delay = passages.withColumn("action_time", F.unix_millis(F.current_timestamp())), "0 seconds"
    if method == "bloom":
        return stream_area_distinct_bloom(passages, size, bits, delay, id_col)
    if method != "exact":
        raise ValueError("method must be 'bloom' or 'exact'")
    size_ms = duration_ms(size)
    t = F.col("action_time")
    df = with_tie_id(passages, id_col).withColumnRenamed(id_col, "event_id") \
        .withColumn("start_time", t - F.pmod(t, F.lit(size_ms))) \
        .withColumn("end_time", F.col("start_time") + F.lit(size_ms))
    spread = F.xxhash64(F.coalesce("car", F.col("event_id").cast("string")))  # passages without a car are spread by their id
    df = df.withColumn("shard", F.pmod(spread, F.lit(int(shards))))
    cols = ["area_id", "start_time", "shard", "end_time", "car", "action_time", "event_id"]
    marked = fold_by_key(watermarked(df.select(*cols), "action_time", delay), ["area_id", "start_time", "shard"],
                         lambda s: machines.FirstPassages(s), MARK_SCHEMA, "action_time", ["action_time", "event_id"], event_time="ts")
    return marked.groupBy("area_id", "start_time").transformWithStateInPandas(
        statefulProcessor=RunningMarks(BLOOM_SCHEMA), outputStructType=BLOOM_SCHEMA, outputMode="Append", timeMode="EventTime")


def stream_area_distinct_bloom(passages: DataFrame, size="10 minutes", bits: int = 1 << 22,
                               delay="5 seconds", id_col: str = "event_id") -> DataFrame:
    """F3 (bloom) on a stream: a fixed-size bitmap per (area, window); the two bit
    offsets are computed in Catalyst (``xxhash64`` and ``hash``), Python only
    tests and sets bits. State is dropped once the watermark passes the window."""
    size_ms = duration_ms(size)
    t = F.col("action_time")
    df = passages.withColumn("start_time", t - F.pmod(t, F.lit(size_ms))) \
        .withColumn("end_time", F.col("start_time") + F.lit(size_ms)) \
        .withColumn("bit1", F.pmod(F.xxhash64("car"), F.lit(bits))) \
        .withColumn("bit2", F.pmod(F.hash("car").cast("long"), F.lit(bits)))
    cols = ["area_id", "start_time", "end_time", "car", "action_time", "bit1", "bit2"]
    if id_col in passages.columns:
        cols.append(id_col)
    order = ["action_time"] + ([id_col] if id_col in passages.columns else [])
    return fold_by_key(watermarked(df.select(*cols), "action_time", delay), ["area_id", "start_time"],
                       lambda s: machines.BloomDistinct(s, bits), BLOOM_SCHEMA, "action_time", order)


# ---- running a query ----------------------------------------------------------------------

def start(df: DataFrame, name: str, sink: str = "memory", output_mode: str = "append",
          foreach_batch: Callable[[DataFrame, int], None] | None = None, trigger: dict | None = None, **options):
    """Start a query with its checkpoint under the shared checkpoint folder."""
    w = df.writeStream.queryName(name).outputMode(output_mode) \
        .option("checkpointLocation", checkpoint_path(df.sparkSession, f"stream-{name}"))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if sink == "console":  # every row, in full
            options = {"numRows": 2 ** 31 - 1, "truncate": False, **options}
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
