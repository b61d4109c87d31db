"""Skew-safe ordered scans over a key (the building block of the sequential operators).

A plain ``Window.partitionBy(key).orderBy(time)`` puts every row of a key
into one task, so one busy car or station (a third of all rows, say) would
serialise the job. Here a key's ordered sequence is cut into buckets
``(key, bucket)``; rows are shuffled once by that pair and each bucket is
scanned locally with window functions. One summary row per bucket, computed
from the same shuffled rows (both branches ask for the same columns, so Spark
reads and shuffles the input once and reuses the exchange), is scanned per key,
and the carry is joined back on the partitioning the rows already have.

A bucket is one task, so it must be small: time buckets by choosing their
width, rank buckets by construction. Keys and buckets are compared as structs,
in which NULL equals NULL, so rows with a NULL key or time keep their place.

Scan kinds (all inclusive of the current row unless noted):

``prev``   value of ``expr`` on the previous row of the key (NULL on the first)
``next``   value of ``expr`` on the next row of the key (NULL on the last)
``sum``    running sum of ``expr``
``max``    running max of ``expr``
``last``   latest value of ``expr`` so far that is not NULL
``total``  sum of ``expr`` over the whole key
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET_COL = "_tb"
DEFAULT_BUCKET_MS = 60 * 60 * 1000   # one hour of a key's events per local scan


def time_bucket(time: str, width: int) -> Column:
    """Floor bucket index of an epoch-ms expression (exact integer arithmetic)."""
    return F.expr(f"({time} - pmod({time}, {width})) div {width}")


def with_time_bucket(df: DataFrame, time_col: str, bucket_ms: int,
                     name: str = BUCKET_COL) -> DataFrame:
    """Add the floor bucket index of an epoch-ms column."""
    return df.withColumn(name, time_bucket(time_col, int(bucket_ms)))


def with_rank_bucket(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     num_buckets: int | None = None, name: str = BUCKET_COL) -> DataFrame:
    """Balanced buckets under any skew: range-partition on ``(keys, order)``
    (Spark samples the data for the range bounds) and use the range partition
    index as the bucket. A key's rows occupy consecutive partitions, so the
    bucket is non-decreasing along the key's order -- all the scans need --
    and no bucket holds more than about ``rows / num_buckets`` rows, even when
    one key's rows all share one timestamp.

    The assignment is checkpointed to the shared ``spark.checkpoint.dir``:
    the scans read their input in more than one branch, and two range
    exchanges sample with different seeds, so only a materialised assignment
    guarantees every branch sees the same bucket for a row (and a recomputed
    task cannot move a row). Cost: one range shuffle plus one write and read
    of the input; time buckets are the cheaper default.
    """
    from roadwatch.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    n = num_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys, *order)
    return ranged.withColumn(name, F.spark_partition_id().cast("long")).checkpoint(eager=True)


def bucketed(df: DataFrame, keys: Sequence[str], order: Sequence[str], time_col: str,
             bucket_ms: int, bucketing: str = "time") -> DataFrame:
    """Add the scan bucket: ``"time"`` (fixed time slices, no extra shuffle) or
    ``"rank"`` (balanced range slices, see :func:`with_rank_bucket`)."""
    if bucketing == "time":
        return with_time_bucket(df, time_col, bucket_ms)
    if bucketing == "rank":
        return with_rank_bucket(df, keys, order)
    raise ValueError("bucketing must be 'time' or 'rank'")


def _shuffled(df: DataFrame, keys: Sequence[str], bucket: str) -> tuple[DataFrame, Column, Column]:
    """``df`` shuffled once by ``_part`` (key and bucket), and what makes two branches of
    it read the very same exchange: an aggregate (the largest row hash) for the
    summary and a filter (no row hash is larger) for the rows. Both need every
    column, so neither branch's exchange is pruned to fewer; the filter keeps
    every row."""
    part = df.withColumn("_part", F.struct(*keys, bucket)).repartition("_part")
    row = F.xxhash64(*part.columns)
    return part, F.max(row).alias("_all"), row <= F.col("_all")


def _by_key(summary: DataFrame, keys: Sequence[str], bucket: str):
    """The summary with its key and bucket as columns (one shuffle for all windows over
    them), and the windows over a whole key and along its buckets."""
    names = [f"_k{i}" for i in range(len(keys))]
    named = summary.withColumns({n: F.col(f"_part.{k}") for n, k in zip([*names, "_b"], [*keys, bucket])})
    w_key = Window.partitionBy(*names)
    return named, w_key, w_key.orderBy("_b")


def keyed_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               specs: Sequence[tuple[str, str, Column]],
               bucket: str = BUCKET_COL) -> DataFrame:
    """Add one column per ``(name, kind, expr)`` spec, scanned over each key in ``order``.

    ``order`` must be a total order inside a key (e.g. ``(action_time, id)``)
    and ``bucket`` a column that is non-decreasing along it.
    """
    keys, order = list(keys), list(order)
    rows, whole, kept = _shuffled(df, keys, bucket)
    w_loc = Window.partitionBy("_part").orderBy(*order)
    w_cum = w_loc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ord_struct = F.struct(*[F.col(c) for c in order])

    staged = rows.withColumn("_scan_first", F.lag(F.lit(1)).over(w_loc).isNull()) \
        .withColumn("_scan_last", F.lead(F.lit(1)).over(w_loc).isNull())
    local = {"prev": lambda e: F.lag(e).over(w_loc), "next": lambda e: F.lead(e).over(w_loc),
             "sum": lambda e: F.sum(e).over(w_cum), "max": lambda e: F.max(e).over(w_cum), "total": lambda e: F.lit(0),
             "last": lambda e: F.last(e, ignorenulls=True).over(w_cum)}
    edge = {"prev": lambda e: F.max_by(e, ord_struct), "next": lambda e: F.min_by(e, ord_struct),
            "sum": F.sum, "max": F.max, "total": F.sum, "last": lambda e: F.max_by(e, F.when(e.isNotNull(), ord_struct))}
    aggs: list[Column] = []
    for name, kind, expr in specs:
        if kind not in local:
            raise ValueError(f"unknown scan kind {kind!r}")
        staged = staged.withColumn(f"_l_{name}", local[kind](expr))
        aggs.append(edge[kind](expr).alias(f"_a_{name}"))

    # One row per (key, bucket), from the same shuffled rows.
    summary, w_key, w_s = _by_key(rows.groupBy("_part").agg(whole, *aggs), keys, bucket)
    w_before = w_s.rowsBetween(Window.unboundedPreceding, -1)
    carry_of = {"prev": lambda a: F.lag(a).over(w_s), "next": lambda a: F.lead(a).over(w_s),
                "sum": lambda a: F.sum(a).over(w_before), "max": lambda a: F.max(a).over(w_before),
                "total": lambda a: F.sum(a).over(w_key), "last": lambda a: F.last(a, ignorenulls=True).over(w_before)}
    carry = summary.select("_part", "_all", *[carry_of[kind](F.col(f"_a_{name}")).alias(f"_c_{name}") for name, kind, _ in specs])

    out = staged.join(carry, "_part", "inner").where(kept)
    for name, kind, _ in specs:
        loc, car = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "prev":
            val = F.when(F.col("_scan_first"), car).otherwise(loc)
        elif kind == "next":
            val = F.when(F.col("_scan_last"), car).otherwise(loc)
        elif kind == "sum":
            val = F.coalesce(car, F.lit(0)) + loc
        elif kind == "total":
            val = car
        elif kind == "last":
            val = F.coalesce(loc, car)
        else:
            val = F.greatest(car, loc)
        out = out.withColumn(name, val).drop(f"_l_{name}", f"_c_{name}")
    return out.drop("_scan_first", "_scan_last", "_part", "_all")


def island_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Column,
                link: Callable[[Column, Column], Column], bucket: str = BUCKET_COL) -> DataFrame:
    """Gaps-and-islands over each key's ordered rows, without a per-key task.

    ``payload`` is a struct of the fields ``link(prev, cur)`` needs; a row
    *links* to its predecessor when ``link`` holds. Adds ``_prev`` (the
    predecessor's payload), ``_link``, ``_next_link`` (the successor links to
    this row), ``_seq`` (0-based position in the key) and ``_island_start``
    (position of the island's first row), so ``_seq - _island_start`` is the
    offset inside the island.

    Plan: rows are shuffled once on ``(key, bucket)`` and scanned locally; one
    aggregate of the local scan per bucket (count, first and last payload,
    last island start) gives each bucket its neighbours across bucket edges
    and its island state. It repeats the local scan over the reused exchange,
    without another read or shuffle. The summaries are combined per key (one
    row per bucket) and joined back on the partitioning the rows already have.
    """
    keys, order = list(keys), list(order)
    rows, whole, kept = _shuffled(df.withColumn("_pl", payload), keys, bucket)
    ord_struct = F.struct(*[F.col(c) for c in order])
    w_loc = Window.partitionBy("_part").orderBy(*order)
    w_cum = w_loc.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    staged = rows.withColumn("_li", F.row_number().over(w_loc) - 1) \
        .withColumn("_lp", F.lag("_pl").over(w_loc)) \
        .withColumn("_ln", F.lead("_pl").over(w_loc))
    staged = staged.withColumn("_llink", F.when(F.col("_li") > 0, F.coalesce(link(F.col("_lp"), F.col("_pl")), F.lit(False)))) \
        .withColumn("_lnext", F.when(F.col("_ln").isNotNull(), F.coalesce(link(F.col("_pl"), F.col("_ln")), F.lit(False))))
    staged = staged.withColumn("_lstart", F.max(F.when(F.col("_li") > 0, F.when(~F.col("_llink"), F.col("_li"))))
                               .over(w_cum))

    # Per bucket, from the local scan: size, edge rows and the last island start
    # after the bucket's first row.
    summary_rows = staged.groupBy("_part").agg(
        whole, F.count(F.lit(1)).alias("_n"), F.min_by("_pl", ord_struct).alias("_first"),
        F.max_by("_pl", ord_struct).alias("_last"), F.max("_lstart").alias("_bstart"))
    summary_rows, _, w_k = _by_key(summary_rows, keys, bucket)
    summary = summary_rows \
        .withColumn("_off", F.coalesce(F.sum("_n").over(w_k.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("_prev_last", F.lag("_last").over(w_k)) \
        .withColumn("_next_first", F.lead("_first").over(w_k))
    summary = summary.withColumn(
        "_first_link", F.coalesce(link(F.col("_prev_last"), F.col("_first")), F.lit(False))) \
        .withColumn("_last_next_link", F.when(F.col("_next_first").isNotNull(),
                                               F.coalesce(link(F.col("_last"), F.col("_next_first")), F.lit(False))))
    bucket_start = F.coalesce(F.col("_off") + F.col("_bstart"),
                              F.when(~F.col("_first_link"), F.col("_off")))
    summary = summary.withColumn("_bucket_start", bucket_start) \
        .withColumn("_carry_start", F.max("_bucket_start").over(w_k.rowsBetween(Window.unboundedPreceding, -1))) \
        .select("_part", "_all", "_off", "_prev_last", "_first_link", "_last_next_link", "_carry_start")

    out = staged.join(summary, "_part", "inner").where(kept)
    first = F.col("_li") == 0
    out = out.withColumn("_prev", F.when(first, F.col("_prev_last")).otherwise(F.col("_lp"))) \
        .withColumn("_link", F.when(first, F.col("_first_link")).otherwise(F.col("_llink"))) \
        .withColumn("_next_link", F.when(F.col("_ln").isNull(), F.col("_last_next_link"))
                    .otherwise(F.col("_lnext"))) \
        .withColumn("_seq", F.col("_off") + F.col("_li")) \
        .withColumn("_island_start", F.greatest(
            F.col("_carry_start"),
            F.when(~F.col("_first_link"), F.col("_off")),
            F.col("_off") + F.col("_lstart")))
    return out.drop("_part", "_all", "_pl", "_li", "_lp", "_ln", "_llink", "_lnext", "_lstart", "_off", "_prev_last",
                    "_first_link", "_last_next_link", "_carry_start")
