import random

from roadwatch.operators import interval_join, pair_actions
from roadwatch.operators.matching import replay_fold


def frames(spark, vs, ps):
    v = spark.createDataFrame([(c, "error", t, i) for c, t, i in vs],
                              "car string, msg string, create_time bigint, event_id bigint")
    p = spark.createDataFrame([(str(i), c, "done", t, i) for c, t, i in ps],
                              "police_id string, car string, action_status string, action_time bigint, event_id bigint")
    return v, p


def test_interval_edges(spark):
    v, p = frames(spark, [("X", 100_000, 1)],
                  [("X", 95_000, 10), ("X", 94_999, 11), ("X", 105_000, 12), ("X", 105_001, 13), ("Y", 100_000, 14)])
    v = v.withColumnRenamed("event_id", "violation_id")
    p = p.withColumnRenamed("event_id", "action_id")
    got = sorted(r.action_id for r in interval_join(v, p).collect())
    assert got == [10, 12]
    outer = interval_join(v, p, how="full_outer", left_id="violation_id", right_id="action_id").collect()
    assert len(outer) == 2 + 3
    assert sorted(r.action_id for r in outer if r.violation_id is None) == [11, 13, 14]


def one_slot_fold(vs, ps, timeout):
    recs = [(t, 0, i, c) for c, t, i in vs] + [(t, 1, i, c) for c, t, i in ps]
    out, slot = [], {}
    for t, k, i, c in sorted(recs):
        s = slot.get(c)
        if s is not None and s[1] != k and t - s[0] <= timeout:
            v, p = (i, s[2]) if k == 0 else (s[2], i)
            out.append((c, "matched", v, p))
            del slot[c]
            continue
        if s is not None:
            out.append((c, "no_police" if s[1] == 0 else "no_violation",
                        s[2] if s[1] == 0 else None, s[2] if s[1] == 1 else None))
        slot[c] = (t, k, i)
    for c, s in slot.items():
        out.append((c, "no_police" if s[1] == 0 else "no_violation",
                    s[2] if s[1] == 0 else None, s[2] if s[1] == 1 else None))
    return sorted(out, key=str)


def run_pairs(spark, vs, ps, timeout, mode="paired", bucket_ms=3_600_000):
    v, p = frames(spark, vs, ps)
    df = pair_actions(v, p, timeout, mode=mode, bucket_ms=bucket_ms)
    return sorted(((r.car, r.outcome, r.violation_id, r.action_id) for r in df.collect()), key=str)


def test_pairing_cases(spark):
    vs = [("M", 0, 1), ("LV", 0, 2), ("VVP", 0, 3), ("VVP", 1_000, 4)]
    ps = [("M", 5_000, 11), ("LP", 0, 12), ("VVP", 2_000, 13)]
    got = run_pairs(spark, vs, ps, 5_000)
    assert got == sorted([("M", "matched", 1, 11), ("LV", "no_police", 2, None),
                          ("LP", "no_violation", None, 12), ("VVP", "no_police", 3, None),
                          ("VVP", "matched", 4, 13)], key=str)


def random_streams(seed, n_cars=4, n=120):
    rnd = random.Random(seed)
    vs, ps, i = [], [], 0
    for c in range(n_cars):
        t = 0
        for _ in range(n if c == 0 else n // 4):
            t += rnd.choice([0, 1_000, 4_999, 5_000, 5_001, 20_000])
            (vs if rnd.random() < 0.5 else ps).append((f"car{c}", t, i))
            i += 1
    return vs, ps


def test_paired_matches_one_slot_fold(spark):
    vs, ps = random_streams(3)
    assert run_pairs(spark, vs, ps, 5_000, bucket_ms=7_000) == one_slot_fold(vs, ps, 5_000)


def test_replay_matches_python_state_machine(spark):
    vs, ps = random_streams(5)
    want = []
    for car in {c for c, _, _ in vs + ps}:
        recs = [{"car": c, "_kind": 0, "_t": t, "_id": i, "violation_id": i, "create_time": t, "msg": "error",
                 "action_id": None, "police_id": None, "action_status": None, "action_time": None}
                for c, t, i in vs if c == car]
        recs += [{"car": c, "_kind": 1, "_t": t, "_id": i, "violation_id": None, "create_time": None, "msg": None,
                  "action_id": i, "police_id": str(i), "action_status": "done", "action_time": t}
                 for c, t, i in ps if c == car]
        want += [(r["car"], r["outcome"], r["violation_id"], r["action_id"]) for r in replay_fold(recs, 5_000)]
    got = run_pairs(spark, vs, ps, 5_000, mode="replay", bucket_ms=7_000)
    assert got == sorted(want, key=str)


def test_replay_quirks():
    # A second violation overwrites the first without a report; the first one's timer
    # (never cancelled) then reports the second one early.
    recs = [{"car": "X", "_kind": 0, "_t": t, "_id": i, "violation_id": i, "create_time": t, "msg": "e",
             "action_id": None, "police_id": None, "action_status": None, "action_time": None}
            for i, t in [(1, 0), (2, 3_000)]]
    recs.append({"car": "X", "_kind": 1, "_t": 6_000, "_id": 3, "violation_id": None, "create_time": None,
                 "msg": None, "action_id": 3, "police_id": "p", "action_status": "done", "action_time": 6_000})
    out = replay_fold(recs, 5_000)
    assert [(r["outcome"], r["violation_id"], r["action_id"]) for r in out] == [
        ("no_police", 2, None), ("no_violation", None, 3)]


def test_rank_bucketing_matches_folds(spark):
    vs, ps = random_streams(8)
    v, p = frames(spark, vs, ps)
    paired = pair_actions(v, p, 5_000, bucketing="rank")
    got = sorted(((r.car, r.outcome, r.violation_id, r.action_id) for r in paired.collect()), key=str)
    assert got == one_slot_fold(vs, ps, 5_000)
    replay_rank = pair_actions(v, p, 5_000, mode="replay", bucketing="rank")
    replay_time = pair_actions(v, p, 5_000, mode="replay")
    key = lambda r: (r.car, r.outcome, r.violation_id, r.action_id)
    assert sorted(map(key, replay_rank.collect()), key=str) == sorted(map(key, replay_time.collect()), key=str)
