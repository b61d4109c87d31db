"""Generic keyed event-time processor (``transformWithStateInPandas``).

Rows of a key are buffered in a ``ListState`` until the watermark passes
them, then fed in event-time order to a :mod:`machines` fold whose state is
kept in a ``ValueState``. Rows that arrive behind the watermark are late: a
fold either takes them as they come (:meth:`Machine.feed_late`, nothing is
lost) or, with ``late="drop"``, leaves them out as windowed operators do. An event-time timer wakes the key up when the
watermark reaches its next buffered row or machine deadline, so results
appear as soon as the input is final, and state is cleared when a machine
is idle. The per-key work is a small Python helper; partitioning, state
storage, checkpointing and recovery are Spark's.
"""

from __future__ import annotations

import json
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadwatch.streaming.machines import Machine

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _plain(o):
    return o.item() if hasattr(o, "item") else str(o)


class EventTimeFold(StatefulProcessor):
    def __init__(self, make: Callable[[str | None], Machine], time_col: str,
                 order: Sequence[str], out_schema: T.StructType, late: str, whole: Sequence[str] = ()):
        self.whole = list(whole)
        self.make, self.time_col, self.order, self.late = make, time_col, list(order), late
        self.out_fields = [(f.name, isinstance(f.dataType, T.LongType), isinstance(f.dataType, T.TimestampType)) for f in out_schema.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", "state string")
        self.buffer = handle.getListState("buffer", "row string")

    def _buffered(self) -> list[dict]:
        if not self.buffer.exists():
            return []
        return [json.loads(r[0]) for r in self.buffer.get()]

    def _advance(self, rows: list[dict], watermark: int, late: Sequence[dict] = ()) -> Iterator[pd.DataFrame]:
        saved = self.machine.get() if self.machine.exists() else None
        m = self.make(saved[0] if saved else None)
        ready = sorted((r for r in rows if r[self.time_col] <= watermark),
                       key=lambda r: tuple(r[c] for c in self.order))
        rest = [r for r in rows if r[self.time_col] > watermark]
        out: list[dict] = []
        m.feed_all(ready, out)
        if late:
            m.feed_late(sorted(late, key=lambda r: tuple(r[c] for c in self.order)), watermark, out)
        m.advance(watermark, out)
        if rest:
            self.buffer.put([(json.dumps(r, default=_plain),) for r in rest])
        else:
            self.buffer.clear()
        if m.empty():
            self.machine.clear()
        else:
            self.machine.update((m.dump(),))
        pending = [r[self.time_col] for r in rest] + [t for t in m.wakeups() if t > watermark]
        if pending:
            self.handle.registerTimer(int(min(pending)))
        if out:
            yield self._frame(out, watermark)

    def _frame(self, out: list[dict], watermark: int) -> pd.DataFrame:
        """Rows with exact 64-bit integers; TIMESTAMP columns hold the watermark at which they came out."""
        return pd.DataFrame({
            name: pd.array([r.get(name) for r in out], dtype="Int64") if whole
            else pd.Series(pd.to_datetime([watermark] * len(out), unit="ms")) if stamp
            else pd.Series([r.get(name) for r in out])
            for name, whole, stamp in self.out_fields})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for pdf in rows:
            new.extend(pdf.astype(object).where(pdf.notna(), None).to_dict("records"))
        new = [json.loads(json.dumps(r, default=_plain)) for r in new]
        for r in new:
            r.update({c: int(r[c]) for c in self.whole if r[c] is not None})
        watermark = timerValues.getCurrentWatermarkInMs()
        late = [r for r in new if r[self.time_col] <= watermark] if self.late == "feed" else []
        new = [r for r in new if r[self.time_col] > watermark]
        yield from self._advance(self._buffered() + new, watermark, late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(self._buffered(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class RunningMarks(StatefulProcessor):
    """Second step of the running distinct count: adds the marks of one (area, window) up.

    The rows of a micro-batch are those the watermark has just passed, so they
    follow all rows of earlier batches; within a batch they go by time and id, late
    ones last (they count as they come).
    The state is one number, dropped when the window ends. Rows without a mark
    (their window is over) get no count.
    """

    def __init__(self, out_schema: T.StructType):
        self.columns = [f.name for f in out_schema.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "count long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["late", "action_time", "event_id"], kind="stable")
        before = int(self.total.get()[0]) if self.total.exists() else 0
        counted = batch["mark"].notna()
        counts = before + batch["mark"].fillna(0).astype("int64").cumsum()
        batch["distinct_cars"] = counts.astype("Int64").where(counted, pd.NA)
        end = int(batch["end_time"].iloc[0]) - 1
        if counted.any() and end > timerValues.getCurrentWatermarkInMs():
            self.total.update((int(counts.iloc[-1]),))
            self.handle.registerTimer(end)
        else:
            self.total.clear()
        yield batch[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.total.clear()
        return iter(())

    def close(self) -> None:
        pass


class ClockWindow(StatefulProcessor):
    """Distinct cars of one key until the clock passes its window's end.

    A processing-time timer closes the window, with or without further input,
    and the state goes with it. (No time-to-live: after a pause of the query
    it would take cars away before they are counted.)
    """

    def __init__(self, size_ms: int, out_schema: T.StructType):
        self.size_ms, self.columns = size_ms, out_schema.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cars = handle.getMapState("cars", "car string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for car in pdf["car"].dropna().unique():
                self.cars.updateValue((car,), (True,))
        self.handle.registerTimer(int(key[1]) + self.size_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count = sum(1 for _ in self.cars.keys())
        self.cars.clear()
        area, start, shard = key
        yield pd.DataFrame([(start, start + self.size_ms, area, shard, count)], columns=self.columns)

    def close(self) -> None:
        pass


def fold_by_key(df: DataFrame, keys: Sequence[str], make: Callable[[str | None], Machine],
                out_schema: T.StructType, time_col: str, order: Sequence[str], late: str = "feed", event_time: str = "") -> DataFrame:
    """Apply an :class:`EventTimeFold` per key of a watermarked stream (append mode).

    Integers are exact over 64 bits: they travel as text, because a pandas
    column with NULLs would make them doubles. Rows without a time have no
    place in event-time order and are left out (:func:`without_time` returns
    them). ``event_time`` names a TIMESTAMP column of ``out_schema`` on which a
    further stateful operator may go on; it holds the watermark at which a row
    came out.

    Needs the RocksDB state store, which the session must be set to
    (:data:`roadwatch.session.DEFAULT_CONF` does).
    """
    if df.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    if late not in ("feed", "drop"):
        raise ValueError("late must be 'feed' or 'drop'")
    df = df.where(F.col(time_col).isNotNull())
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType) and f.name not in keys]
    df = df.withColumns({c: F.col(c).cast("string") for c in whole})
    proc = EventTimeFold(make, time_col, order, out_schema, late, whole)
    # The watermark is tracked upstream; the fold works on epoch ms, not TIMESTAMP columns.
    df = df.select(*[f.name for f in df.schema.fields
                     if not isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))])
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=out_schema, outputMode="Append", timeMode="EventTime", eventTimeColumnName=event_time)


def without_time(df: DataFrame, time_col: str) -> DataFrame:
    """The rows a fold leaves out, for an output of their own."""
    return df.where(F.col(time_col).isNull())
