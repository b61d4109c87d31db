"""Per-key event-time machines for the stateful stream operators.

Each machine is a small pure-Python fold over one key's records in event-time
order, with a state that serialises to a JSON string (kept in a
``ValueState``). ``feed`` consumes a record, ``advance`` is told that no
record at or before ``watermark`` can still arrive; both append output rows.
``wakeups`` lists event times at which the key must be woken up again
(registered as event-time timers).
"""

from __future__ import annotations

import base64
import bisect
import heapq
import json
import zlib

import numpy as np


class Machine:
    def __init__(self, state: str | None = None):
        self.s = json.loads(state) if state else self.initial()

    def initial(self) -> dict:
        return {}

    def dump(self) -> str:
        return json.dumps(self.s)

    def feed(self, rec: dict, out: list) -> None:
        raise NotImplementedError

    def feed_all(self, recs: list[dict], out: list) -> None:
        """Feed records already in event-time order (machines may vectorise this)."""
        for r in recs:
            self.feed(r, out)

    def feed_late(self, recs: list[dict], watermark: int, out: list) -> None:
        """Records behind the watermark, in event-time order among themselves."""
        self.feed_all(recs, out)

    def advance(self, watermark: int, out: list) -> None:
        pass

    def wakeups(self) -> list[int]:
        return []

    def empty(self) -> bool:
        return not self.s


class ClonePlates(Machine):
    """I1 as links and parity: a passage links to the car's previous one if less than
    ``(within_s + 1)`` seconds lie between; in a run of links every second passage is
    a hit. The state is the latest passage and whether it may still be paired. A
    late passage is compared with that one, whichever is older."""

    def __init__(self, state=None, within_s: int = 10, msg: str = ""):
        super().__init__(state)
        self.limit, self.msg = (within_s + 1) * 1000, msg

    def feed(self, rec, out):
        now = [rec["action_time"], rec["monitor_id"]]
        last, free = self.s.get("last"), self.s.get("free", False)
        hit = free and abs(now[0] - last[0]) < self.limit
        if hit:
            # Equal times: both stations are the later record's.
            first = min(last, now, key=lambda x: x[0]) if last[0] != now[0] else now
            second = now if now[0] >= last[0] else last
            out.append({"car": rec["car"], "first_monitor": first[1], "second_monitor": second[1],
                        "msg": self.msg, "action_time": second[0]})
        if last is None or now[0] >= last[0]:
            self.s["last"], self.s["free"] = now, not hit
        elif hit:
            self.s["free"] = False

    def advance(self, watermark, out):
        # A stored passage no later record can link to behaves like none.
        last = self.s.get("last")
        if last is not None and watermark - last[0] >= self.limit:
            self.s = {}


class SevereChains(Machine):
    """Keep the severe passages of the last ``within`` ms; each new one closes
    every match that ends with it (``times`` or more elements, span < within)."""

    def __init__(self, state=None, times: int = 3, within_ms: int = 120_000, emit: str = "all"):
        super().__init__(state)
        self.times, self.within, self.emit = times, within_ms, emit

    def initial(self):
        return {"hits": []}

    def feed(self, rec, out):
        t = rec["action_time"]
        hits = [h for h in self.s["hits"] if t - h[0] < self.within]
        hits.append([t, rec["monitor_id"]])
        self.s["hits"] = hits
        n = len(hits)
        for start in range(0, n - self.times + 1):
            length = n - start
            if self.emit == "first" and length != self.times:
                continue
            out.append({"car": rec["car"], "start_time": hits[start][0], "end_time": t,
                        "n_events": length, "monitor_ids": [h[1] for h in hits[start:]],
                        "avg_speed": 0.0})

    def advance(self, watermark, out):
        # Nothing after the watermark can extend a chain that started before watermark - within.
        self.s["hits"] = [h for h in self.s["hits"] if h[0] > watermark - self.within]

    def empty(self):
        return not self.s["hits"]


V_COLS = ["violation_id", "create_time", "msg"]
P_COLS = ["action_id", "police_id", "action_status", "action_time"]


def emit_pair(out: list, car, outcome: str, v: dict | None, p: dict | None) -> None:
    """One D6 output row: the violation's and the action's fields (NULL when absent)."""
    row = {"car": car, "outcome": outcome}
    for c in V_COLS:
        row[c] = None if v is None else v[c]
    for c in P_COLS:
        row[c] = None if p is None else p[c]
    out.append(row)


class PairReplay(Machine):
    """D6 replay: one pending record, a never-cancelled timer per stored record.

    Records carry ``kind`` (0 violation, 1 police action) and ``t`` (epoch ms).
    """

    def __init__(self, state=None, timeout_ms: int = 5_000):
        super().__init__(state)
        self.timeout = timeout_ms

    def initial(self):
        return {"slot": None, "timers": []}

    def _fire_before(self, t, out, inclusive=False):
        timers = self.s["timers"]
        while timers and (timers[0] <= t if inclusive else timers[0] < t):
            heapq.heappop(timers)
            slot = self.s["slot"]
            if slot is not None:
                v = slot if slot["kind"] == 0 else None
                p = slot if slot["kind"] == 1 else None
                emit_pair(out, slot["car"], "no_police" if v else "no_violation", v, p)
                self.s["slot"] = None

    def feed(self, rec, out):
        self._fire_before(rec["t"], out)
        slot = self.s["slot"]
        if slot is not None and slot["kind"] != rec["kind"]:
            v, p = (rec, slot) if rec["kind"] == 0 else (slot, rec)
            emit_pair(out, rec["car"], "matched", v, p)
            self.s["slot"] = None
        else:
            heapq.heappush(self.s["timers"], rec["t"] + self.timeout)
            self.s["slot"] = {k: rec.get(k) for k in ["car", "kind", "t"] + V_COLS + P_COLS}

    def feed_late(self, recs, watermark, out):
        """As the original: timers up to the watermark have fired, then a late record is one like any other."""
        self.advance(watermark, out)
        self.feed_all(recs, out)

    def advance(self, watermark, out):
        # Every later record has t > watermark, so timers at or before it fire now.
        self._fire_before(watermark, out, inclusive=True)

    def wakeups(self):
        return list(self.s["timers"])

    def empty(self):
        return self.s["slot"] is None and not self.s["timers"]


class PairOneToOne(Machine):
    """D6 paired: one pending record; the next record of the other kind at most
    ``timeout`` later pairs with it, anything else reports it alone."""

    def __init__(self, state=None, timeout_ms: int = 5_000):
        super().__init__(state)
        self.timeout = timeout_ms

    def initial(self):
        return {"slot": None}

    def _alone(self, out):
        slot = self.s["slot"]
        emit_pair(out, slot["car"], "no_police" if slot["kind"] == 0 else "no_violation",
                         slot if slot["kind"] == 0 else None, slot if slot["kind"] == 1 else None)
        self.s["slot"] = None

    def feed(self, rec, out):
        slot = self.s["slot"]
        if slot is not None and slot["kind"] != rec["kind"] and rec["t"] - slot["t"] <= self.timeout:
            v, p = (rec, slot) if rec["kind"] == 0 else (slot, rec)
            emit_pair(out, rec["car"], "matched", v, p)
            self.s["slot"] = None
            return
        if slot is not None:
            self._alone(out)
        self.s["slot"] = {k: rec.get(k) for k in ["car", "kind", "t"] + V_COLS + P_COLS}

    def feed_late(self, recs, watermark, out):
        """A late record may pair with the pending one, whichever is older; one older
        than the pending record that does not pair with it is reported alone."""
        for rec in recs:
            slot = self.s["slot"]
            if slot is None or slot["t"] <= rec["t"]:
                self.feed(rec, out)
            elif slot["kind"] != rec["kind"] and slot["t"] - rec["t"] <= self.timeout:
                self.s["slot"] = {k: rec.get(k) for k in ["car", "kind", "t"] + V_COLS + P_COLS}
                self.feed(slot, out)
            else:
                self.s["slot"] = {k: rec.get(k) for k in ["car", "kind", "t"] + V_COLS + P_COLS}
                self._alone(out)
                self.s["slot"] = slot

    def advance(self, watermark, out):
        # Later records have t > watermark: none can pair once watermark >= t + timeout.
        slot = self.s["slot"]
        if slot is not None and watermark >= slot["t"] + self.timeout:
            self._alone(out)

    def wakeups(self):
        slot = self.s["slot"]
        return [] if slot is None else [slot["t"] + self.timeout]

    def empty(self):
        return self.s["slot"] is None


class BloomDistinct(Machine):
    """F3 bloom: a fixed bitmap of ``bits`` bits per (area, window); a car whose
    two bits are both set counts as seen (false positives only undercount).
    Every record emits the running count, repeats included. The state is the
    count plus the dense bitmap (zlib-compressed while mostly empty); it is
    dropped when the window ends."""

    def __init__(self, state=None, bits: int = 1 << 22):
        self.bits = bits
        super().__init__(state)
        raw = self.s.get("bitmap")
        self.bitmap = bytearray(zlib.decompress(base64.b64decode(raw))) if raw \
            else bytearray((bits + 7) // 8)

    def initial(self):
        return {"count": 0}

    def dump(self):
        self.s["bitmap"] = base64.b64encode(zlib.compress(bytes(self.bitmap), 1)).decode()
        return json.dumps(self.s)

    def _test_and_set(self, offsets) -> bool:
        seen = all(self.bitmap[o >> 3] & (1 << (o & 7)) for o in offsets)
        if not seen:
            for o in offsets:
                self.bitmap[o >> 3] |= 1 << (o & 7)
        return seen

    def feed_all(self, recs, out):
        """Vectorised: a bit is set before record i iff it was set in the stored
        bitmap or belongs to an earlier record (a seen record's bits are already
        set, so setting them again changes nothing)."""
        if not recs:
            return
        everyone, recs = recs, [r for r in recs if r["car"] is not None]
        n = len(recs)
        bits = np.array([[int(r["bit1"]) % self.bits, int(r["bit2"]) % self.bits] for r in recs],
                        dtype=np.int64).reshape(-1)
        bm = np.frombuffer(self.bitmap, dtype=np.uint8)          # writable view of the bitmap
        stored = ((bm[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1).astype(bool)
        uniq, first_at, inv = np.unique(bits, return_index=True, return_inverse=True)
        carried_before = (first_at[inv] // 2) < np.repeat(np.arange(n), 2)
        seen = (stored | carried_before).reshape(n, 2).all(axis=1)
        np.bitwise_or.at(bm, uniq >> 3, (1 << (uniq & 7)).astype(np.uint8))
        new = iter((~seen).tolist())
        # Passages without a car never count, as in the batch form.
        counts = self.s["count"] + np.cumsum([r["car"] is not None and next(new) for r in everyone])
        self.s["count"] = int(counts[-1])
        self.s["end"] = int(everyone[0]["end_time"])
        for r, c in zip(everyone, counts):
            out.append({"area_id": r["area_id"], "start_time": r["start_time"],
                        "end_time": r["end_time"], "car": r["car"], "action_time": r["action_time"],
                        "event_id": r.get("event_id"), "distinct_cars": int(c)})

    def feed(self, rec, out):
        if rec["car"] is not None and not self._test_and_set([int(rec["bit1"]) % self.bits, int(rec["bit2"]) % self.bits]):
            self.s["count"] += 1
        self.s["end"] = int(rec["end_time"])
        out.append({"area_id": rec["area_id"], "start_time": rec["start_time"],
                    "end_time": rec["end_time"], "car": rec["car"],
                    "action_time": rec["action_time"], "event_id": rec.get("event_id"),
                    "distinct_cars": self.s["count"]})

    def advance(self, watermark, out):
        # Rows of the window are < end; once the watermark reaches end - 1 none can come.
        end = self.s.get("end")
        if end is not None and watermark >= end - 1:
            self.s = self.initial()
            self.bitmap = bytearray((self.bits + 7) // 8)

    def feed_late(self, recs, watermark, out):
        """A late record of an open window is counted as it comes; of a window whose
        state is gone it is reported with no count (``distinct_cars`` NULL)."""
        self.feed_all([r for r in recs if int(r["end_time"]) - 1 > watermark], out)
        for r in recs:
            if int(r["end_time"]) - 1 <= watermark:
                out.append({"area_id": r["area_id"], "start_time": r["start_time"], "end_time": r["end_time"],
                            "car": r["car"], "action_time": r["action_time"], "event_id": r.get("event_id"),
                            "distinct_cars": None})

    def wakeups(self):
        end = self.s.get("end")
        return [] if end is None else [end - 1]

    def empty(self):
        return "end" not in self.s


class FirstPassages(Machine):
    """F3 exact, first step: the cars seen of one (area, window, shard); a passage is
    marked 1 if it is its car's first, without a car never. State grows with the
    shard's distinct cars and is dropped when the window ends."""

    def initial(self):
        return {"seen": []}

    def feed_all(self, recs, out, late=0):
        seen = set(self.s["seen"])
        for r in recs:
            new = r["car"] is not None and r["car"] not in seen
            if new:
                seen.add(r["car"])
            self.s["end"] = int(r["end_time"])
            out.append({**{c: r.get(c) for c in ("area_id", "start_time", "end_time", "car", "action_time", "event_id")}, "mark": int(new), "late": late})
        self.s["seen"] = sorted(seen)

    def feed(self, rec, out):
        self.feed_all([rec], out)

    def advance(self, watermark, out):
        end = self.s.get("end")
        if end is not None and watermark >= end - 1:
            self.s = self.initial()

    def feed_late(self, recs, watermark, out):
        """A late record of an open window is marked as it comes; of a window whose
        state is gone it goes on without a mark (NULL)."""
        self.feed_all([r for r in recs if int(r["end_time"]) - 1 > watermark], out, 1)
        for r in recs:
            if int(r["end_time"]) - 1 <= watermark:
                out.append({**{c: r.get(c) for c in ("area_id", "start_time", "end_time", "car", "action_time", "event_id")}, "mark": None, "late": 1})

    def wakeups(self):
        end = self.s.get("end")
        return [] if end is None else [end - 1]

    def empty(self):
        return "end" not in self.s


class LimitAsOf(Machine):
    """A8 by time: the versions of one station's limit, the newest and those not older
    than ``keep_ms`` behind the watermark; a passage takes the latest at or before its
    time. A late passage does so too, while the version is kept; a late version
    holds for the passages still to come."""

    def __init__(self, state=None, default: int = 60, keep_ms: int = 3_600_000):
        super().__init__(state)
        self.default, self.keep = default, keep_ms

    def initial(self):
        return {"versions": []}

    def feed(self, rec, out):
        versions = self.s["versions"]
        if rec["kind"] == 0:
            if (rec["speed_limit"] or 0) > 0:
                bisect.insort(versions, [rec["t"], -rec["speed_limit"]])  # of equal times the lowest limit is last
            return
        at = bisect.bisect_right(versions, rec["t"], key=lambda v: v[0])
        out.append({**rec, "limit_speed": -versions[at - 1][1] if at else self.default, "action_time": rec["t"], "event_id": rec["rid"]})

    def advance(self, watermark, out):
        versions = self.s["versions"]
        old = bisect.bisect_right(versions, watermark - self.keep, key=lambda v: v[0])
        self.s["versions"] = versions[max(0, old - 1):]

    def empty(self):
        return not self.s["versions"]
