"""``foreachBatch`` writers: the batch sinks applied one micro-batch at a time.

File tables are written idempotently: every micro-batch owns the partition
``run=<id>/epoch=<id>`` and replaces it with dynamic partition overwrite. The
run is the streaming query's id, which its checkpoint keeps: a batch that is
re-run after a failure rewrites the same rows, and a query that starts over
with a new checkpoint (whose epochs count from 0 again) adds to the table
instead of overwriting it. A writer called outside a stream is a run of its
own. The once-per-day violation writer reads the stored rows of *other*
batches only, so its retry computes the same inserts; it must be the only
query writing its table (two concurrent batches could both insert the same
car-day). JDBC targets append and are at-least-once: a retried batch inserts
its rows again, which a unique key on the table has to catch.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.functions.columns import DAY_MS, day_start_ms, with_tie_id
from roadwatch.operators.enrich import track_rows
from roadwatch.operators.windows import count_batches
from roadwatch.sinks.keyed import KeyedTable, counter_rows, keyed_track_rows
from roadwatch.sinks.writers import split_outcomes, upsert_counts, violations_to_insert, write_table, write_tracks

BatchFn = Callable[[DataFrame, int], None]


class Run:
    """The run a batch belongs to: its streaming query, else this writer."""

    def __init__(self, run_id: str | None = None):
        self.own = run_id or uuid.uuid4().hex

    def of(self, batch: DataFrame) -> str:
        return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or self.own


def _exists(spark: SparkSession, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def write_epoch(df: DataFrame, target: str, epoch: int, run: str, by: tuple[str, ...] = ()) -> None:
    """Replace what batch ``(run, epoch)`` wrote to a parquet table by ``df``."""
    df.withColumn("run", F.lit(run)).withColumn("epoch", F.lit(int(epoch)).cast("long")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by, "run", "epoch").parquet(target)


def epoch_writer(target: str, run_id: str | None = None) -> BatchFn:
    """Every row of every micro-batch, as it is, into a table."""
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, target, epoch, run.of(batch))
    return write


def table_writer(name: str, target: str, fmt: str = "parquet", run_id: str | None = None, **options) -> BatchFn:
    """B1/B2: every micro-batch into the table (idempotent per run and epoch for
    files; JDBC targets append)."""
    from roadwatch.schemas import TABLES
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        if fmt == "jdbc":
            write_table(batch, name, target, fmt, **options)
        else:
            src = batch.withColumnRenamed("msg", "violation") if name == "violation_list" else batch
            write_epoch(src.select(*TABLES[name]), target, epoch, run.of(batch))
    return write


#: Layout of the stream's violation table; ``day`` (start of the day, epoch ms) is its first partition.
VIOLATION_TABLE = "car string, violation string, create_time long, day long, run string, epoch long"


def violation_writer(target: str, run_id: str | None = None) -> BatchFn:
    """Insert a violation only if its car has none stored for that day.

    The table is partitioned by day, and only the days of the batch (and the
    next, whose midnight rows count for the day before) are read. A table that
    cannot be read fails the batch.
    """
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            now, stored = run.of(batch), None
            span = batch.agg(F.min("create_time").alias("a"), F.max("create_time").alias("b")).first()
            if span["a"] is not None and _exists(batch.sparkSession, target):
                stored = batch.sparkSession.read.schema(VIOLATION_TABLE).parquet(target) \
                    .where(F.col("day").between(span["a"] - 2 * DAY_MS, span["b"] + 2 * DAY_MS)) \
                    .where((F.col("run") != now) | (F.col("epoch") != int(epoch))).select("car", "violation", "create_time")
            rows = violations_to_insert(batch, stored).withColumnRenamed("msg", "violation") \
                .select("car", "violation", "create_time", day_start_ms("create_time").alias("day"))
            write_epoch(rows, target, epoch, now, ("day",))
        finally:
            batch.unpersist()
    return write


def track_writer(target: str, run_id: str | None = None) -> BatchFn:
    """B4 (+E5's purpose): each micro-batch is one batched write; nothing is held back."""
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        write_tracks(track_rows(batch), target, epoch=epoch, run=run.of(batch))
    return write


def outcome_writer(targets: dict[str, str], run_id: str | None = None) -> BatchFn:
    """One table per outcome (the reference's side outputs); the batch is
    persisted so the branches do not recompute it."""
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for tag, df in split_outcomes(batch).items():
                if tag in targets:
                    write_epoch(df, targets[tag], epoch, run.of(batch))
        finally:
            batch.unpersist()
    return write


def counter_writer(target: str, key_cols=("end_time", "area_id"), value: str = "car_count",
                   run_id: str | None = None) -> BatchFn:
    """Running counters ``<windowEnd>_<area>``; each batch appends its latest
    value per key, :func:`read_counters` keeps the last (largest) one."""
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(upsert_counts(batch, key_cols, value), target, epoch, run.of(batch))
    return write


def read_counters(spark, target: str, value: str = "car_count") -> DataFrame:
    return spark.read.parquet(target).groupBy("count_key").agg(F.max(value).alias(value))


def keyed_track_writer(table: KeyedTable, run_id: str | None = None) -> BatchFn:
    """Passages into a :func:`roadwatch.sinks.keyed.track_table`, a commit per batch.

    A table's commits are numbered, and that number orders the writes of a key.
    """
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        rows = keyed_track_rows(with_tie_id(batch, "event_id"), table.manifest()["version"])
        table.write(rows, epoch, run.of(batch))
    return write


def keyed_counter_writer(table: KeyedTable, key_cols=("end_time", "area_id"), value: str = "car_count",
                         run_id: str | None = None) -> BatchFn:
    """Running counts into a :func:`roadwatch.sinks.keyed.counter_table`."""
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        table.write(counter_rows(batch, key_cols, value), epoch, run.of(batch))
    return write


def count_batch_writer(target: str, state: str, n: int = 10, order=("action_time", "event_id"),
                       run_id: str | None = None) -> BatchFn:
    """E5: consecutive groups of ``n`` rows of a stream, with the columns
    :func:`roadwatch.operators.windows.count_batches` adds.

    Micro-batches follow one another; inside one, rows are in ``order``. What
    does not fill a group (fewer than ``n`` rows) waits in the folder
    ``state`` for the next micro-batch, one row per batch with the number of
    groups so far; a stream's trailing partial group never fires. A batch reads
    the state of the one before, so a batch that is run again writes the same
    rows. Only the last two states are kept. NULL times come first.
    """
    run = Run(run_id)

    def write(batch: DataFrame, epoch: int) -> None:
        spark, now = batch.sparkSession, run.of(batch)
        rows = with_tie_id(batch, order[-1])
        cols, base = rows.columns, 0
        path = spark._jvm.org.apache.hadoop.fs.Path
        folder = path(f"{state}/run={now}")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        earlier = sorted(e for e in (int(x.split("=")[1]) for x in names if x.startswith("epoch=")) if e < int(epoch))
        rows = rows.withColumn("_new", F.lit(1))
        if earlier:
            held = spark.read.parquet(f"{state}/run={now}/epoch={earlier[-1]}")
            base = held.first()["base"]
            rows = rows.unionByName(held.select(F.inline("tail")).withColumn("_new", F.lit(0)))
        numbered = count_batches(rows, n, ("_new", *order), drop_incomplete=False).select("batch_id", "row_index", *cols).persist()
        try:
            full = numbered.count() // n
            whole = numbered.where(F.col("batch_id") < full)
            write_epoch(whole.withColumn("batch_id", F.col("batch_id") + base).withColumn("row_index", F.col("row_index") + base * n),
                        target, epoch, now)
            tail = F.sort_array(F.collect_list(F.struct("row_index", *cols)))  # fewer than n rows
            numbered.where(F.col("batch_id") >= full).agg(tail.alias("_t")) \
                .select(F.lit(base + full).cast("long").alias("base"),
                        F.transform("_t", lambda r: F.struct(*[r[c].alias(c) for c in cols])).alias("tail")) \
                .write.mode("overwrite").parquet(f"{state}/run={now}/epoch={int(epoch)}")
        finally:
            numbered.unpersist()
        for e in earlier[:-1]:
            fs.delete(path(f"{state}/run={now}/epoch={e}"), True)
    return write
