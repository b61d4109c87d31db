"""Sequential pattern operators (I1 clone plates, I2 dangerous driving).

Both are per-car folds in event-time order in the reference. They are
rewritten as set logic over skew-safe keyed scans (``plans.scan``) and
bounded-frame windows, so no car's history is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadwatch.functions.columns import DEFAULT_LIMIT, SEVERE_FACTOR, severe_overspeed, with_tie_id
from roadwatch.operators.enrich import with_limits
from roadwatch.operators.windows import duration_ms
from roadwatch.plans.scan import DEFAULT_BUCKET_MS, bucketed, island_scan, keyed_scan, with_time_bucket

# The reference's display texts.
CLONE_MSG = "涉嫌套牌车"          # "suspected cloned plate"
DANGEROUS_MSG = "该车辆涉嫌危险驾驶"  # "vehicle suspected of dangerous driving"


def clone_plates(passages: DataFrame, within_s: int = 10, id_col: str = "event_id",
                 bucket_ms: int = DEFAULT_BUCKET_MS, bucketing: str = "time") -> DataFrame:
    """The same plate seen twice with ``|dt| div 1000 <= within_s``.

    The reference keeps one stored passage per car: a hit emits and clears
    it, a miss replaces it by the newer passage. In event-time order the
    stored passage is always the previous one, so the fold is
    gaps-and-islands: a row *links* to its predecessor when the gap is short,
    an island is a maximal run of links, and the rows at odd offsets inside
    an island are the hits (pairs never overlap).

    Output: ``car, first_monitor, second_monitor, msg, action_time`` (the
    second passage's time; the reference used the wall clock). On equal
    times both monitors are the later record's, as in the reference.
    """
    order = ["action_time", id_col]
    d = bucketed(with_tie_id(passages, id_col), ["car"], order, "action_time", bucket_ms, bucketing)
    limit_ms = (int(within_s) + 1) * 1000          # |dt| div 1000 <= s  <=>  |dt| < (s + 1) * 1000
    d = island_scan(d, ["car"], order,
                    F.struct(F.col("action_time").alias("t"), F.col("monitor_id").alias("m")),
                    lambda p, c: F.abs(c["t"] - p["t"]) < F.lit(limit_ms))
    hits = d.where(((F.col("_seq") - F.col("_island_start")) % 2) == 1)
    return hits.select(
        "car",
        F.when(F.col("action_time") > F.col("_prev.t"), F.col("_prev.m"))
         .otherwise(F.col("monitor_id")).alias("first_monitor"),
        F.col("monitor_id").alias("second_monitor"),
        F.lit(CLONE_MSG).alias("msg"),
        "action_time",
    )


def clone_plate_cars(passages: DataFrame, within_s: int = 10) -> DataFrame:
    """The cars that :func:`clone_plates` reports at least once (``car``, distinct).

    A car has a hit exactly if two of its passages lie within the limit: two
    in one slice of that length, or the last of a slice and the first of the
    next. One pre-aggregated shuffle, no ordering.
    """
    limit = (int(within_s) + 1) * 1000
    t = F.col("action_time")
    slot = F.expr(f"(action_time - pmod(action_time, {limit})) div {limit}")
    copies = F.array(F.struct(slot.alias("s"), t.alias("own"), F.lit(None).cast("long").alias("after")),
                     F.struct((slot - 1).alias("s"), F.lit(None).cast("long").alias("own"), t.alias("after")))
    slots = passages.select("car", F.inline(copies)).groupBy("car", "s") \
        .agg(F.count("own").alias("n"), F.max("own").alias("last"), F.min("after").alias("next"))
    return slots.where((F.col("n") > 1) | (F.col("next") - F.col("last") < F.lit(limit))).select("car").distinct()


def dangerous_driving(passages: DataFrame, monitors: DataFrame, factor: float = SEVERE_FACTOR,
                      times: int = 3, within="2 minutes", default: int = DEFAULT_LIMIT,
                      emit: str = "all", id_col: str = "event_id",
                      bucket_ms: int = DEFAULT_BUCKET_MS, bucketing: str = "time") -> DataFrame:
    """``times`` or more severe overspeeds of one car within ``within``.

    Semantics of the reference's pattern (single looping condition, relaxed
    contiguity, no skip strategy, strict ``within``): non-matching passages
    are ignored (so severe passages are filtered first), and every severe
    passage starts a match each time its chain reaches ``times`` or more
    elements with ``last - first < within``: a chain of n such passages gives
    (n-1)(n-2)/2 matches for ``times=3``. ``emit="first"`` keeps only the
    shortest match per start.

    Each start only looks ``within`` ahead, so the frame is bounded: rows are
    bucketed by time (bucket >= within) and each severe passage is also
    copied into the previous bucket when it lies within ``within`` of that
    bucket's end (a halo), after which every bucket is scanned on its own.

    ``bucketing="rank"`` (bursts that crowd one time bucket): positions
    instead of frames -- see :func:`_chains_by_position`.

    Output: ``car, start_time, end_time, n_events, monitor_ids (array), avg_speed``
    (``avg_speed`` is 0.0 as in the reference).
    """
    if emit not in ("all", "first"):
        raise ValueError("emit must be 'all' or 'first'")
    span = duration_ms(within)
    width = max(int(bucket_ms), span)
    hits = with_limits(with_tie_id(passages, id_col), monitors, default, keep=(id_col,)) \
        .where(severe_overspeed("limit_speed", "real_speed", factor)) \
        .select("car", "action_time", id_col, "monitor_id")
    if bucketing == "rank":
        return _chains_by_position(hits, times, span, emit, id_col)
    hits = with_time_bucket(hits, "action_time", width, "_hb")
    # Halo: rows close to the start of their bucket are also copied (as non-starts)
    # into the previous bucket, for that bucket's starts. One scan, one explode.
    near_start = F.col("action_time") - F.col("_hb") * F.lit(width) < F.lit(span)
    own = F.struct(F.col("_hb").alias("b"), F.lit(True).alias("native"))
    prev = F.struct((F.col("_hb") - 1).alias("b"), F.lit(False).alias("native"))
    rows = hits.withColumn("_copy", F.explode(F.when(near_start, F.array(own, prev))
                                              .otherwise(F.array(own)))) \
        .withColumn("_hb", F.col("_copy.b")).withColumn("_native", F.col("_copy.native")).drop("_copy")

    # Positions first: a start's chain ends at the last position its time span reaches.
    in_order = Window.partitionBy("car", "_hb").orderBy("action_time", id_col)
    w = Window.partitionBy("car", "_hb").orderBy("action_time").rangeBetween(0, span - 1)
    rows = rows.withColumn("_pos", F.row_number().over(in_order)).withColumn("_reach", F.max("_pos").over(w))
    full = F.col("_native") & (F.col("_reach") - F.col("_pos") + 1 >= times)
    upto = F.max(F.when(full, F.col("_reach"))).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Only rows of some match go on to have chains collected.
    rows = rows.withColumn("_upto", upto).where(F.col("_upto") >= F.col("_pos"))
    elem = F.struct(F.col("action_time").alias("t"), F.col(id_col).alias("i"), F.col("monitor_id").alias("m"))
    framed = rows.withColumn("_frame", F.collect_list(elem).over(w)).where(full)
    # RANGE frames include equal-time peers that sort before the start: drop them.
    after = F.array_sort(F.filter(
        "_frame", lambda x: (x["t"] > F.col("action_time"))
        | ((x["t"] == F.col("action_time")) & (x["i"] >= F.col(id_col)))))
    framed = framed.withColumn("_chain", after).withColumn("_m", F.size("_chain")) \
        .where(F.col("_m") >= times)
    last = F.col("_m") if emit == "all" else F.lit(times)
    matches = framed.withColumn("_len", F.explode(F.sequence(F.lit(times), last)))
    chain = F.slice("_chain", 1, F.col("_len"))
    return matches.select(
        "car",
        F.col("action_time").alias("start_time"),
        F.element_at(chain, -1)["t"].alias("end_time"),
        F.col("_len").cast("long").alias("n_events"),
        F.transform(chain, lambda x: x["m"]).alias("monitor_ids"),
        F.lit(0.0).alias("avg_speed"),
    )


def _chains_by_position(hits: DataFrame, times: int, span: int, emit: str, id_col: str) -> DataFrame:
    """I2 without time frames, for any skew.

    Each car's severe passages get their position ``seq`` (a rank-bucketed
    running count). A probe row at ``t + span - 1`` per passage, ordered after
    the passages of that instant, counts the passages before the chain's
    deadline (``reach``), so a start's chain holds ``m = reach - seq + 1``
    passages. Chains are then fetched by an equi-join on ``(car, position)``
    (unique keys, no skew) and cut into matches; the work grows with the
    output, never with a key's size.
    """
    order = ["action_time", "_probe", id_col]
    real = hits.select("car", "action_time", id_col, "monitor_id", F.lit(0).alias("_probe"))
    probes = hits.select("car", (F.col("action_time") + F.lit(span - 1)).alias("action_time"), id_col,
                         F.lit(None).cast("string").alias("monitor_id"), F.lit(1).alias("_probe"))
    u = bucketed(real.unionByName(probes), ["car"], order, "action_time", DEFAULT_BUCKET_MS, "rank")
    u = keyed_scan(u, ["car"], order, [("_cnt", "sum", (F.col("_probe") == 0).cast("long"))])
    seq = u.where(F.col("_probe") == 0).select("car", id_col, "action_time", "monitor_id",
                                               F.col("_cnt").alias("_seq"))
    reach = u.where(F.col("_probe") == 1).select("car", id_col, F.col("_cnt").alias("_reach"))
    starts = seq.join(reach, ["car", id_col]) \
        .withColumn("_m", F.col("_reach") - F.col("_seq") + 1).where(F.col("_m") >= times)
    if emit == "first":
        starts = starts.withColumn("_m", F.lit(times).cast("long"))
    members = starts.select("car", F.col(id_col).alias("_start"), F.col("action_time").alias("start_time"),
                            "_m", F.explode(F.sequence(F.col("_seq"), F.col("_seq") + F.col("_m") - 1)).alias("_k"))
    elems = seq.select("car", F.col("_seq").alias("_k"), F.col("action_time").alias("_t"),
                       F.col("monitor_id").alias("_mon"))
    chains = members.join(elems, ["car", "_k"]) \
        .groupBy("car", "_start", "start_time", "_m") \
        .agg(F.array_sort(F.collect_list(F.struct("_k", "_t", "_mon"))).alias("_chain"))
    matches = chains.withColumn("_len", F.explode(F.sequence(F.lit(times).cast("long"), F.col("_m"))))
    chain = F.slice("_chain", 1, F.col("_len").cast("int"))
    return matches.select(
        "car", "start_time",
        F.element_at(chain, -1)["_t"].alias("end_time"),
        F.col("_len").cast("long").alias("n_events"),
        F.transform(chain, lambda x: x["_mon"]).alias("monitor_ids"),
        F.lit(0.0).alias("avg_speed"),
    )
