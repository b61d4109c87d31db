"""Keyed tables on files (B4, B7): a key's newest row wins, read at any time.

Every micro-batch is one sorted run of rows; after ``every`` runs a Spark job
folds them into the compacted rows, and only the buckets that they touch are
written anew. A small manifest names the runs and, per bucket, the compacted
folder that count. It is replaced by one rename, so a reader sees a table
before or after a batch, never in between, and a batch that is run again
changes nothing. What a manifest no longer names stays for ``grace_s`` seconds,
for readers that started before; a folder that a crash left is named by none and
never read. One query writes a table at a time: a second one that commits the
same manifest fails.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.operators.enrich import track_rows
from roadwatch.schemas import TRACK
from roadwatch.sinks.writers import upsert_counts


class KeyedTable:
    """Rows of ``schema``, one per ``key`` (NULL is a key of its own).

    Of rows with one key the one of largest ``newest`` columns stays (then of
    largest row hash). ``lookup`` is the column that readers look up by (a key
    keeps its value); rows
    are dealt into ``buckets`` by it, so a look-up reads one bucket and at most
    ``every`` runs. Rows of a hot value share a bucket folder but are cut by
    key into several files.
    """

    def __init__(self, spark: SparkSession, target: str, schema: str, key: str, lookup: str | None = None,
                 newest: tuple[str, ...] = (), buckets: int = 64, every: int = 16, grace_s: float = 3600):
        self.spark, self.target, self.schema = spark, target.rstrip("/"), schema
        self.key, self.lookup, self.newest = key, lookup or key, newest
        self.buckets, self.every, self.grace_s = buckets, every, grace_s
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    # The manifest.

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.target}/manifest")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self) -> dict:
        """``buckets``: bucket -> folder; ``runs``: folders; ``done``: last batch of each query."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "buckets": {}, "runs": [], "done": {}, "old": []}
        stream = self._fs.open(self._path(f"{self.target}/manifest/{versions[-1]}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, m: dict) -> None:
        m = {**m, "version": m["version"] + 1}
        limit = time.time() - self.grace_s
        gone = [p for p, at in m["old"] if at <= limit]
        m["old"] = [[p, at] for p, at in m["old"] if at > limit]
        draft, final = (self._path(f"{self.target}/manifest/{n}") for n in (f".{uuid.uuid4().hex}", m["version"]))
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"{self.target}: another writer committed version {m['version']}")
        for p in gone:
            self._fs.delete(self._path(f"{self.target}/{p}"), True)
        for v in self._versions():
            if v < m["version"] - 1:
                self._fs.delete(self._path(f"{self.target}/manifest/{v}"), False)

    # Rows.

    def _bucket(self):
        return F.pmod(F.crc32(F.coalesce(F.col(self.lookup).cast("string"), F.lit(""))), F.lit(self.buckets)).cast("int")

    def _last(self, rows: DataFrame) -> DataFrame:
        names = self._columns()
        order = F.struct(*self.newest, F.xxhash64(*names))
        return rows.groupBy(self.key).agg(F.max_by(F.struct(*names), order).alias("_w")).select("_w.*")

    def _columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def _load(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.target}/{f}" for f in folders])

    def write(self, batch: DataFrame, epoch: int = 0, run: str = "batch") -> None:
        """Commit the rows of ``batch`` as batch ``epoch`` of the query ``run`` (again: no effect)."""
        m = self.manifest()
        if int(epoch) <= m["done"].get(run, -1):
            return
        folder = f"runs/{uuid.uuid4().hex}"
        self._last(batch.select(*self._columns())).repartitionByRange(self.key).sortWithinPartitions(self.key) \
            .write.parquet(f"{self.target}/{folder}")
        self._commit({**m, "runs": [*m["runs"], folder], "done": {**m["done"], run: int(epoch)}})
        if len(m["runs"]) + 1 >= self.every:
            self.compact()

    def compact(self) -> None:
        """Fold the runs into the buckets they touch; the other buckets keep their files."""
        m = self.manifest()
        if not m["runs"]:
            return
        new = self._load(m["runs"])
        touched = [str(r[0]) for r in new.select(self._bucket()).distinct().collect()]  # at most `buckets` numbers
        replaced = [m["buckets"][b] for b in touched if b in m["buckets"]]
        folder = f"base/{uuid.uuid4().hex}"
        self._last(self._load(replaced).unionByName(new)).withColumn("bucket", self._bucket()) \
            .repartitionByRange("bucket", self.key).sortWithinPartitions("bucket", self.key) \
            .write.partitionBy("bucket").parquet(f"{self.target}/{folder}")
        now = time.time()
        self._commit({**m, "runs": [], "buckets": {**m["buckets"], **{b: f"{folder}/bucket={b}" for b in touched}},
                      "old": m["old"] + [[p, now] for p in m["runs"] + replaced]})

    def read(self) -> DataFrame:
        """The table as of now, one row per key."""
        m = self.manifest()
        return self._last(self._load([*m["buckets"].values(), *m["runs"]]))

    def rows_of(self, value) -> DataFrame:
        """The rows whose ``lookup`` column is ``value``: its bucket and the runs are read."""
        m = self.manifest()
        own = m["buckets"].get(str(zlib.crc32(str(value).encode()) % self.buckets))
        return self._last(self._load([own] * (own is not None) + m["runs"]).where(F.col(self.lookup) == value))


_TRACK_SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRACK.fields)


def track_table(spark: SparkSession, target: str, **options) -> KeyedTable:
    """Newest-first track rows per ``row_key``, looked up by car; the last write wins, in a
    batch the largest ``event_id``."""
    return KeyedTable(spark, target, f"{_TRACK_SCHEMA}, event_id long, written long", "row_key", "car",
                      ("written", "event_id"), **options)


def counter_table(spark: SparkSession, target: str, value: str = "car_count", **options) -> KeyedTable:
    """Running counters ``<windowEnd>_<area>``; they only grow, so the largest is the last."""
    return KeyedTable(spark, target, f"count_key string, {value} long", "count_key", newest=(value,), **options)


def counter_rows(df: DataFrame, key_cols=("end_time", "area_id"), value: str = "car_count") -> DataFrame:
    """Rows for :func:`counter_table`."""
    return upsert_counts(df, key_cols, value)


def keyed_track_rows(passages: DataFrame, written: int) -> DataFrame:
    """Rows for :func:`track_table`; ``written`` orders writes of one key."""
    return track_rows(passages).withColumn("written", F.lit(written).cast("long"))
