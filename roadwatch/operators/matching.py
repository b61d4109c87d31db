"""Violation / police-action matching (D5 interval join, D7 outer interval join,
D6 one-to-one pairing with a timeout).

Range joins are bucketed: the right side is keyed by ``(car, time bucket)``
and each left row probes only the (at most two or three) buckets its range
touches, so the join is an equi-join plus a range filter and a busy car is
split over its buckets instead of comparing all of its rows pairwise.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from roadwatch.functions.columns import with_tie_id
from roadwatch.operators.windows import duration_ms
from roadwatch.plans.scan import DEFAULT_BUCKET_MS, bucketed, island_scan, time_bucket


def interval_join(left: DataFrame, right: DataFrame, left_time: str = "create_time",
                  right_time: str = "action_time", lower="-5 seconds", upper="5 seconds",
                  key: str = "car", how: str = "inner",
                  left_id: str | None = None, right_id: str | None = None, salts: int = 1) -> DataFrame:
    """``right_time BETWEEN left_time + lower AND left_time + upper`` (both ends
    inclusive) on equal ``key``; many-to-many.

    Bucketed range join: every left row sits in exactly one time bucket of
    width ``upper - lower``; every right row is copied into the (at most two)
    left buckets whose rows it can match. The join is then an equi-join on
    ``(key, bucket)`` plus the range filter, each pair is produced once, and a
    busy key is spread over its buckets.

    ``how="full_outer"`` is one full outer join in the same layout: a left row
    without a partner appears once with NULLs, and a copy of a right row
    without one counts only if all its copies are (they are brought together
    by one more shuffle, in which every other row is spread by its own hash).
    Rows with a NULL key or time have no partner and are spread by their hash.
    Spark splits a hot ``(key, bucket)`` of an inner join at run time, of a full
    outer join it cannot: ``salts`` spreads a bucket's left rows over that many
    parts, each of which gets the right rows. Apart from ``key`` the two
    sides must have distinct column names. ``left_id``/``right_id`` are
    accepted for compatibility and not needed.
    """
    lo, hi = duration_ms(lower), duration_ms(upper)
    if hi < lo:
        raise ValueError("upper must not be below lower")
    if how not in ("inner", "full_outer"):
        raise ValueError("how must be 'inner' or 'full_outer'")
    width = max(hi - lo, 1)
    copies = F.sequence(time_bucket(f"({right_time} + ({-hi}))", width), time_bucket(f"({right_time} + ({-lo}))", width))
    if how == "inner":
        lb, rb = left.withColumn("_jb", time_bucket(left_time, width)), right.withColumn("_jb", F.explode(copies))
        in_range = F.col(right_time).between(F.col(left_time) + F.lit(lo), F.col(left_time) + F.lit(hi))
        return lb.join(rb, [key, "_jb"], "inner").where(in_range).drop("_jb")
    if salts < 1:
        raise ValueError("salts must be positive")
    l_hash, r_hash = F.xxhash64(*left.columns), F.xxhash64(*right.columns)
    partnerless = lambda time: F.col(key).isNull() | F.col(time).isNull()
    lb = left.withColumn("_jb", F.when(partnerless(left_time), l_hash).otherwise(
        time_bucket(left_time, width) * salts + F.pmod(l_hash, F.lit(salts))))
    parts = F.flatten(F.transform(copies, lambda b: F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: b * salts + i)))
    rb = right.withColumn("_copies", F.when(partnerless(right_time), F.array(r_hash)).otherwise(parts)) \
        .withColumn("_n", F.size("_copies")).withColumn("_jb", F.explode("_copies")).drop("_copies").withColumn("_right", F.lit(True))
    l_side, r_side = lb.withColumn("_left", F.lit(True)).alias("_l"), rb.alias("_r")
    cond = (F.col(f"_l.{key}") == F.col(f"_r.{key}")) & (F.col("_l._jb") == F.col("_r._jb")) \
        & F.col(f"_r.{right_time}").between(F.col(f"_l.{left_time}") + F.lit(lo),
                                            F.col(f"_l.{left_time}") + F.lit(hi))
    l_cols, r_cols = [F.col(f"_l.{c}") for c in left.columns], [F.col(f"_r.{c}") for c in right.columns]
    lone = F.col("_l._left").isNull()
    joined = l_side.join(r_side, cond, "full_outer").select(
        F.coalesce(F.col(f"_l.{key}"), F.col(f"_r.{key}")).alias(key),
        *[c for c, n in zip(l_cols, left.columns) if n != key], *[c for c, n in zip(r_cols, right.columns) if n != key],
        lone.alias("_lone"), F.col("_r._n").alias("_n"), F.col("_r._jb").alias("_jb"),
        F.when(lone, F.struct(*r_cols)).alias("_which"),
        F.when(lone, F.xxhash64(*r_cols)).otherwise(F.xxhash64(*l_cols, *r_cols)).alias("_spread"))
    w = Window.partitionBy("_lone", "_spread", "_which")
    kept = joined.withColumn("_seen", F.size(F.collect_set("_jb").over(w))) \
        .withColumn("_first", F.min("_jb").over(w))
    once = ~F.col("_lone") | ((F.col("_seen") == F.col("_n")) & (F.col("_jb") == F.col("_first")))
    return kept.where(once).drop("_lone", "_n", "_jb", "_which", "_spread", "_seen", "_first")


_V_COLS = ["violation_id", "create_time", "msg"]
_P_COLS = ["action_id", "police_id", "action_status", "action_time"]
PAIR_COLS = ["car", "outcome"] + _V_COLS + _P_COLS


def _events(violations: DataFrame, actions: DataFrame, v_id: str, p_id: str) -> DataFrame:
    violations, actions = with_tie_id(violations, v_id), with_tie_id(actions, p_id)
    v = violations.select("car", F.lit(0).alias("_kind"), F.col("create_time").alias("_t"),
                          F.col(v_id).alias("_id"), F.col(v_id).alias("violation_id"),
                          "create_time", "msg")
    p = actions.select("car", F.lit(1).alias("_kind"), F.col("action_time").alias("_t"),
                       F.col(p_id).alias("_id"), F.col(p_id).alias("action_id"),
                       "police_id", "action_status", "action_time")
    return v.unionByName(p, allowMissingColumns=True)


def pair_actions(violations: DataFrame, actions: DataFrame, timeout="5 seconds",
                 mode: str = "paired", violation_id: str = "event_id", action_id: str = "event_id",
                 bucket_ms: int = DEFAULT_BUCKET_MS, bucketing: str = "time") -> DataFrame:
    """One-to-one matching of violations and police actions per car.

    ``mode="paired"`` (default): per car in event-time order (violation
    before action on equal times, then id), a record pairs with the pending
    record of the other kind if it is at most ``timeout`` older; otherwise the
    pending record is reported alone. As set logic: a row *links* to its
    predecessor when kinds differ and the gap is within the timeout; within
    each island of links rows pair up (1,2), (3,4), ...; a row left over is
    ``no_police`` (a violation) or ``no_violation`` (an action).

    ``mode="replay"``: the reference's state machine exactly (one slot per
    kind, a later record of the same kind overwrites the pending one without
    a report, timers are never cancelled so a stale timer can report a newer
    record early). See :func:`pair_actions_replay`.

    Output columns: ``PAIR_COLS`` with ``outcome`` in
    ``matched / no_police / no_violation``.
    """
    if mode == "replay":
        return pair_actions_replay(violations, actions, timeout, violation_id, action_id, bucket_ms,
                                   bucketing)
    if mode != "paired":
        raise ValueError("mode must be 'paired' or 'replay'")
    limit = duration_ms(timeout)
    order = ["_t", "_kind", "_id"]
    payload = F.struct(F.col("_kind").alias("k"), F.col("_t").alias("t"),
                       *[F.col(c) for c in _V_COLS + _P_COLS])
    u = bucketed(_events(violations, actions, violation_id, action_id), ["car"], order, "_t",
                 bucket_ms, bucketing)
    u = island_scan(u, ["car"], order, payload,
                    lambda p, c: (p["k"] != c["k"]) & (c["t"] - p["t"] <= F.lit(limit)))
    pos = F.col("_seq") - F.col("_island_start")
    second = (pos % 2) == 1
    alone = ((pos % 2) == 0) & ~F.coalesce(F.col("_next_link"), F.lit(False))
    cur_v = F.col("_kind") == 0

    def pick(c):
        # For a pair take the field from whichever of (current, previous) carries it.
        mine = F.col(c)
        theirs = F.col(f"_prev.{c}")
        return F.when(second, F.coalesce(mine, theirs)).otherwise(mine).alias(c)

    out = u.where(second | alone).select(
        "car",
        F.when(second, F.lit("matched")).when(cur_v, F.lit("no_police"))
         .otherwise(F.lit("no_violation")).alias("outcome"),
        *[pick(c) for c in _V_COLS + _P_COLS])
    return out


# ---- exact replay of the reference's keyed state machine -------------------------------

_REPLAY_SCHEMA = T.StructType([
    T.StructField("car", T.StringType()), T.StructField("outcome", T.StringType()),
    T.StructField("violation_id", T.LongType()), T.StructField("create_time", T.LongType()),
    T.StructField("msg", T.StringType()), T.StructField("action_id", T.LongType()),
    T.StructField("police_id", T.StringType()), T.StructField("action_status", T.StringType()),
    T.StructField("action_time", T.LongType()),
])


class ReplayMachine:
    """The reference's co-process function for one car, fed time-ordered records.

    One pending slot (only one kind is ever pending), an event-time timer at
    ``t + timeout`` for every stored record; a timer at ``T`` fires before
    any record with ``t > T`` and at end of input. A record of the kind
    already pending overwrites it without a report, and timers are never
    cancelled, so a stale timer can report a newer record early.
    """

    def __init__(self, timeout_ms: int):
        self.timeout = timeout_ms
        self.timers: list[int] = []
        self.slot = None

    def _report(self, out):
        rec = self.slot
        kind = rec["_kind"]
        out.append(_row(rec["car"], "no_police" if kind == 0 else "no_violation",
                        rec if kind == 0 else None, rec if kind == 1 else None))
        self.slot = None

    def feed(self, rec: dict, out: list) -> None:
        import heapq
        while self.timers and self.timers[0] < rec["_t"]:
            heapq.heappop(self.timers)
            if self.slot is not None:
                self._report(out)
        if self.slot is not None and self.slot["_kind"] != rec["_kind"]:
            v, p = (rec, self.slot) if rec["_kind"] == 0 else (self.slot, rec)
            out.append(_row(rec["car"], "matched", v, p))
            self.slot = None
        else:
            heapq.heappush(self.timers, rec["_t"] + self.timeout)
            self.slot = rec

    def finish(self, out: list) -> None:
        if self.slot is not None:
            self._report(out)
        self.timers.clear()


def replay_fold(rows: list[dict], timeout_ms: int) -> list[dict]:
    """Run :class:`ReplayMachine` over one car's records (pure Python, for tests)."""
    m, out = ReplayMachine(timeout_ms), []
    for rec in sorted(rows, key=lambda r: (r["_t"], r["_kind"], r["_id"])):
        m.feed(rec, out)
    m.finish(out)
    return out


def _row(car, outcome, v, p):
    r = {"car": car, "outcome": outcome}
    for c in _V_COLS:
        r[c] = None if v is None else v[c]
    for c in _P_COLS:
        r[c] = None if p is None else p[c]
    return r


def pair_actions_replay(violations: DataFrame, actions: DataFrame, timeout="5 seconds",
                        violation_id: str = "event_id", action_id: str = "event_id",
                        bucket_ms: int = DEFAULT_BUCKET_MS, bucketing: str = "time") -> DataFrame:
    """D6 ``replay``: the reference's state machine exactly, run per *session*.

    When two consecutive records of a car are more than ``timeout`` apart,
    every timer has fired and the slot is empty: the machine restarts. Sessions
    are cut with the skew-safe keyed scan; rows are then hash-partitioned by
    ``(car, session)``, sorted inside partitions, and streamed through the
    machine with ``mapInArrow`` -- batches in, the fold's state carried
    across batches, so a session is never materialised as one group.
    """
    limit = duration_ms(timeout)
    order = ["_t", "_kind", "_id"]
    u = bucketed(_events(violations, actions, violation_id, action_id), ["car"], order, "_t",
                 bucket_ms, bucketing)
    # A session is an island of records at most ``timeout`` apart; its id is its first position.
    u = island_scan(u, ["car"], order, F.struct(F.col("_t").alias("t")),
                    lambda p, c: c["t"] - p["t"] <= F.lit(limit)) \
        .withColumnRenamed("_island_start", "_session")
    u = u.select("car", "_session", "_kind", "_t", "_id", *_V_COLS, *_P_COLS) \
        .repartition("car", "_session") \
        .sortWithinPartitions("car", "_session", *order)
    schema = to_arrow_schema(_REPLAY_SCHEMA)

    def run(batches):
        key, machine = None, ReplayMachine(limit)
        for batch in batches:  # Arrow records: 64-bit ids stay exact next to NULLs
            out: list = []
            for rec in batch.to_pylist():
                k = (rec["car"], rec["_session"])
                if k != key:
                    machine.finish(out)
                    key = k
                machine.feed(rec, out)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        tail: list = []
        machine.finish(tail)
        if tail:
            yield pa.RecordBatch.from_pylist(tail, schema=schema)

    return u.mapInArrow(run, _REPLAY_SCHEMA)
