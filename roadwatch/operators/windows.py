"""Time-window and count-window operators.

Durations are given as milliseconds or as Spark interval text
(``"5 minutes"``, ``"1 day"``). Windows are epoch-aligned ``[start, end)``,
the same alignment as the reference's tumbling/sliding windows. Pass
``watermark`` to use the same operator on a stream (append mode).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadwatch.functions.columns import millis_to_ts, rounded_average, ts_to_millis, with_tie_id
from roadwatch.plans.scan import DEFAULT_BUCKET_MS, bucketed, keyed_scan, with_rank_bucket

_UNITS = {"millisecond": 1, "ms": 1, "second": 1000, "s": 1000, "minute": 60_000, "min": 60_000,
          "hour": 3_600_000, "h": 3_600_000, "day": 86_400_000, "d": 86_400_000}


def duration_ms(d) -> int:
    """``"5 minutes"`` / ``"2 s"`` / ``120000`` -> milliseconds."""
    if isinstance(d, (int, float)):
        return int(d)
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+)\s*", str(d))
    unit = m.group(2).lower() if m else ""
    unit = unit if unit in _UNITS else unit.removesuffix("s")
    if unit not in _UNITS:
        raise ValueError(f"cannot read duration {d!r}")
    return int(m.group(1)) * _UNITS[unit]


def interval_text(d) -> str:
    return f"{duration_ms(d)} milliseconds"


def with_event_time(df: DataFrame, time_col: str = "action_time", watermark=None) -> DataFrame:
    """Add ``ts`` (TIMESTAMP from epoch ms); with ``watermark`` also bound the disorder."""
    out = df.withColumn("ts", millis_to_ts(time_col))
    if watermark is not None:
        out = past_end_marker(out.withWatermark("ts", interval_text(watermark)), "ts")
    return out


#: Event time of the row that ends a bounded stream (2262-01-01, within what pandas holds).
END_MS = 9_214_646_400_000


def past_end_marker(df: DataFrame, ts_col: str) -> DataFrame:
    """``df`` without the end marker, behind the watermark that has seen it. (The condition
    names the event-time column, so it is not pushed below the watermark.)"""
    return df.where(F.col(ts_col).isNull() | (F.col(ts_col) < F.timestamp_millis(F.lit(END_MS))))


def speed_sums():
    """Exact partial sums behind the average speed."""
    return F.sum(F.col("speed").cast("decimal(18,4)")).alias("_s"), F.count("*").alias("_n")


def avg_speed(passages: DataFrame, size="5 minutes", slide="1 minute", watermark=None) -> DataFrame:
    """E1 + F1: average speed and passage count per station and sliding window.

    Built-in ``sum``/``count`` aggregate partially before the shuffle (the
    reference's incremental accumulator). The average is rounded half up to
    cents from an exact decimal sum; ``car_count`` counts passages.

    In batch, where the slide divides the size, passages are first aggregated
    per slide-long pane and only the panes are copied into the windows that
    hold them; a stream (``watermark``) uses Spark's sliding window
    (:func:`roadwatch.streaming.stream_avg_speed` chains panes instead).
    """
    df = with_event_time(passages, watermark=watermark)
    width, step = duration_ms(size), duration_ms(slide)
    total, count = speed_sums()
    if watermark is None and width % step == 0:
        pane = F.col("action_time") - F.pmod(F.col("action_time"), F.lit(step))
        panes = df.where("action_time IS NOT NULL").groupBy(pane.alias("_p"), "monitor_id").agg(total, count)
        starts = F.explode(F.sequence(F.col("_p") - F.lit(width - step), F.col("_p"), F.lit(step).cast("long")))
        g = panes.select("monitor_id", "_s", "_n", starts.alias("start_time")).groupBy("start_time", "monitor_id") \
            .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
        return g.select("start_time", (F.col("start_time") + F.lit(width)).alias("end_time"), "monitor_id",
                        rounded_average("_s", "_n").alias("avg_speed"), F.col("_n").cast("int").alias("car_count"))
    g = df.groupBy(F.window("ts", interval_text(size), interval_text(slide)).alias("w"), "monitor_id").agg(total, count)
    return g.select(ts_to_millis("w.start").alias("start_time"), ts_to_millis("w.end").alias("end_time"),
                    "monitor_id", rounded_average("_s", "_n").alias("avg_speed"),
                    F.col("_n").cast("int").alias("car_count"))


def top_n_monitors(avg: DataFrame, n: int = 3) -> DataFrame:
    """H1: the ``n`` busiest stations of every window (by ``car_count``, ties by ``monitor_id``).

    ``row_number() <= n`` is planned with a per-partition group limit ahead of
    the shuffle, so each window's candidates are cut to ``n`` map-side.
    """
    w = Window.partitionBy("end_time").orderBy(F.col("car_count").desc(), F.col("monitor_id"))
    return avg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _tumbling(df: DataFrame, size_ms: int) -> DataFrame:
    t = F.col("action_time")
    start = t - F.pmod(t, F.lit(size_ms))
    return df.withColumn("start_time", start).withColumn("end_time", start + F.lit(size_ms))


def area_distinct(passages: DataFrame, size="10 seconds") -> DataFrame:
    """exact number of distinct cars per area and tumbling window.

    ``count(DISTINCT car)`` is planned as a two-level aggregate (first by
    ``(window, area, car)``, then by ``(window, area)``), both partial, so a
    busy area is spread over its cars before it is counted.
    """
    g = _tumbling(passages, duration_ms(size)).groupBy("start_time", "end_time", "area_id") \
        .agg(F.count_distinct("car").alias("car_count"))
    return g


def area_distinct_approx(passages: DataFrame, size="10 minutes", rsd: float = 0.05) -> DataFrame:
    """HyperLogLog++ distinct cars per area and window (mergeable, stream-safe)."""
    return _tumbling(passages, duration_ms(size)).groupBy("start_time", "end_time", "area_id") \
        .agg(F.approx_count_distinct("car", rsd).alias("car_count"))


def distinct_panes(passages: DataFrame, pane="10 minutes", lg_k: int = 12, watermark=None) -> DataFrame:
    """F4 in mergeable form: one HyperLogLog sketch of the cars per area and pane
    (``pane_start``, ``area_id``, ``sketch``), to be stored. Passages without a
    car leave no trace. Partial sketches are merged before the shuffle; a
    sketch is a few KB (``2**lg_k`` registers), whatever an area's traffic.
    """
    width = duration_ms(pane)
    sketch = F.hll_sketch_agg("car", F.lit(lg_k)).alias("sketch")
    if watermark is None:
        start = (F.col("action_time") - F.pmod("action_time", F.lit(width))).alias("pane_start")
        return passages.where("action_time IS NOT NULL AND car IS NOT NULL").groupBy(start, "area_id").agg(sketch)
    timed = with_event_time(passages, watermark=watermark)
    g = timed.groupBy(F.window("ts", interval_text(width)).alias("w"), "area_id").agg(sketch).where(F.hll_sketch_estimate("sketch") > 0)
    return g.select(ts_to_millis("w.start").alias("pane_start"), "area_id", "sketch")


def distinct_from_panes(panes: DataFrame, size, slide, pane) -> DataFrame:
    """F4 over any window from stored panes: ``(start_time, end_time, area_id,
    car_count)`` with the estimated distinct cars of each sliding window that
    holds a pane. ``size`` and ``slide`` are multiples of ``pane``. Sketches of
    an area and window are merged map-side first; panes that were stored twice
    (a repeated append) change nothing, since a union of sketches is idempotent.
    """
    width, step, unit = duration_ms(size), duration_ms(slide), duration_ms(pane)
    if width % unit or step % unit:
        raise ValueError("size and slide must be multiples of the pane")
    p = F.col("pane_start")
    last = p - F.pmod(p, F.lit(step))  # the latest window start at or before the pane
    first = last - F.lit(step) * F.floor((F.lit(width - unit) - (p - last)) / F.lit(step))
    starts = F.explode(F.sequence(first.cast("long"), last, F.lit(step).cast("long")))
    held = panes.where(p - last <= F.lit(width - unit)).select("area_id", "sketch", starts.alias("start_time"))
    return held.groupBy("start_time", "area_id").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("car_count")) \
        .select("start_time", (F.col("start_time") + F.lit(width)).alias("end_time"), "area_id", "car_count")


def area_distinct_sliding(passages: DataFrame, size="10 minutes", slide="5 minutes") -> DataFrame:
    """Exact distinct cars per area and sliding window: a car counts once per pane first, so
    what is copied into windows is ``(pane, area, car)``, not passages."""
    width, step = duration_ms(size), duration_ms(slide)
    if width % step:
        raise ValueError("the slide must divide the size")
    p = F.col("action_time") - F.pmod("action_time", F.lit(step))
    cars = passages.where("action_time IS NOT NULL AND car IS NOT NULL").select("area_id", "car", p.alias("_p")).distinct()
    starts = F.explode(F.sequence(F.col("_p") - F.lit(width - step), F.col("_p"), F.lit(step).cast("long")))
    return cars.select("area_id", "car", starts.alias("start_time")).groupBy("start_time", "area_id") \
        .agg(F.count_distinct("car").alias("car_count")) \
        .select("start_time", (F.col("start_time") + F.lit(width)).alias("end_time"), "area_id", "car_count")


#: Time buckets per window of the running count: the scan's unit of work is
#: (area, bucket), so a busy area's window spreads over this many tasks.
RUNNING_BUCKETS = 64


def area_distinct_running(passages: DataFrame, size="10 minutes", id_col: str = "event_id",
                          bucket_ms: int | None = None, bucketing: str = "time",
                          method: str = "exact", bits: int = 1 << 22) -> DataFrame:
    """one row per passage with the number of distinct cars seen so far in its
    area and tumbling window (event-time order, ties by ``id_col``).

    ``method="exact"``: a passage counts if it is its car's first in the
    window (rows without a car never count, as in :func:`area_distinct`).
    ``method="bloom"``: the fixed bitmap of the original, two bits per car out
    of ``bits`` (from md5, which other engines share); a passage counts if it
    is the first to set one of its bits, so the count may be low.

    First passages are marked by a skew-safe running number over ``(area, window,
    car)``, in the same time buckets, or by a row number over ``(area, window,
    bit)``; a busy area is spread over its cars. A skew-safe running sum over ``(area, window)`` in time buckets of a
    fraction of the window (:data:`RUNNING_BUCKETS`, or ``bucket_ms``) adds
    them up. The input is read once.
    """
    if method not in ("exact", "bloom"):
        raise ValueError("method must be 'exact' or 'bloom'")
    order = ["action_time", id_col]
    width = duration_ms(size)
    cols = ["area_id", "start_time", "end_time", "car", "action_time", id_col]
    slice_ms = bucket_ms or max(1, width // RUNNING_BUCKETS)
    d = _tumbling(with_tie_id(passages, id_col), width).select(*cols)
    if method == "exact":
        # A car's passages are numbered in time buckets too, so that no task holds all of a busy (or missing) car's.
        key = ["area_id", "start_time", "car"]
        nth = keyed_scan(bucketed(d, key, order, "action_time", slice_ms, bucketing), key, order, [("_nth", "sum", F.lit(1).cast("long"))])
        marked = nth.select(*cols, F.when((F.col("_nth") == 1) & F.col("car").isNotNull(), 1).otherwise(0).cast("long").alias("_w"))
    else:
        offsets = [F.pmod(F.conv(F.substring(F.md5("car"), at, 15), 16, 10).cast("long"), F.lit(bits)) for at in (1, 17)]
        nth = F.row_number().over(Window.partitionBy("area_id", "start_time", "_bit").orderBy(*order, "_i"))
        touched = d.select(*cols, F.posexplode(F.array(*offsets)).alias("_i", "_bit"))
        first = F.when((nth == 1) & F.col("_bit").isNotNull(), 1).otherwise(0)
        # Both bits of a passage are brought together again by their position in the scan.
        marked = touched.withColumn("_f", first.cast("long")).groupBy(*cols, "_i").agg(F.max("_f").alias("_f"), F.count("*").alias("_n"))
        marked = marked.groupBy(*cols).agg(F.max("_f").alias("_w"), F.max("_n").alias("_n")) \
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))) \
            .withColumn("_w", F.when(F.col("_copy") == 1, F.col("_w")).otherwise(0)).select(*cols, "_w")
    u = bucketed(marked, ["area_id", "start_time"], order, "action_time", slice_ms, bucketing)
    u = keyed_scan(u, ["area_id", "start_time"], order, [("distinct_cars", "sum", F.col("_w"))])
    return u.select(*cols, "distinct_cars")


def count_batches(df: DataFrame, n: int = 10, order=("action_time", "event_id"),
                  drop_incomplete: bool = True, num_partitions: int | None = None,
                  bucketing: str = "rank", bucket_ms: int = DEFAULT_BUCKET_MS) -> DataFrame:
    """E5: consecutive groups of ``n`` rows in global ``order``; a trailing partial
    group is dropped (it never fires), unless ``drop_incomplete=False``.

    A global position is a running count over a key-less scan: rows are cut
    into balanced ranges of ``order`` (range buckets, checkpointed -- see
    :func:`roadwatch.plans.scan.with_rank_bucket`), numbered inside each, and
    offset by the counts of earlier ones (one summary row per range); the
    total comes from the same summary. ``bucketing="time"`` cuts by time
    slices of ``order[0]`` (epoch ms) instead and materialises nothing; a
    slice is one task, so it must be narrow enough. Rows with a NULL time come
    first.
    """
    order = list(order)
    d = bucketed(df, [], order, order[0], bucket_ms, bucketing) if bucketing == "time" \
        else with_rank_bucket(df, [], order, num_partitions)
    one = F.lit(1).cast("long")
    d = keyed_scan(d, [], order, [("_pos", "sum", one), ("_total", "total", one)])
    out = d.withColumn("row_index", F.col("_pos") - 1).withColumn("batch_id", F.expr(f"row_index div {int(n)}"))
    if drop_incomplete:
        out = out.where(F.col("row_index") < F.expr(f"_total div {int(n)}") * F.lit(int(n)))
    return out.drop("_pos", "_total", "_tb")
