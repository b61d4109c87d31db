import random

from conftest import monitors_df, passages_df

from roadwatch.operators import clone_plates, dangerous_driving


def clone_fold(rows, within_s):
    """Keyed one-slot fold, rows (t, monitor, car, id) in arrival = event-time order."""
    out, state = [], {}
    for t, m, car, i in sorted(rows, key=lambda r: (r[0], r[3])):
        first = state.get(car)
        if first is None:
            state[car] = (t, m)
            continue
        ft, fm = first
        if abs(t - ft) // 1000 <= within_s:
            out.append((car, fm if t > ft else m, fm if t < ft else m, t))
            del state[car]
        elif t > ft:
            state[car] = (t, m)
    return sorted(out)


def run_clone(spark, rows, within_s=10, bucket_ms=3_600_000):
    p = passages_df(spark, [(t, m, car, 50.0, i) for t, m, car, i in rows])
    return sorted((r.car, r.first_monitor, r.second_monitor, r.action_time)
                  for r in clone_plates(p, within_s, bucket_ms=bucket_ms).collect())


def test_clone_boundary(spark):
    rows = [(0, "a", "X", 0), (10_999, "b", "X", 1), (100_000, "a", "Y", 2), (111_000, "b", "Y", 3)]
    assert run_clone(spark, rows) == [("X", "a", "b", 10_999)]


def test_clone_chain_and_equal_times(spark):
    rows = [(t, f"m{t}", "X", i) for i, t in enumerate([0, 5_000, 9_000, 19_999, 40_000])]
    rows += [(5_000, "m1", "Z", 10), (5_000, "m2", "Z", 11)]
    got = run_clone(spark, rows)
    assert got == [("X", "m0", "m5000", 5_000), ("X", "m9000", "m19999", 19_999),
                   ("Z", "m2", "m2", 5_000)]


def test_clone_random_matches_fold_across_buckets(spark):
    rnd = random.Random(7)
    rows, i = [], 0
    for car in ["A", "B", "C", "HOT"]:
        t = 0
        for _ in range(400 if car == "HOT" else 60):
            t += rnd.choice([0, 300, 2_000, 9_000, 10_999, 11_000, 30_000])
            rows.append((t, f"m{rnd.randint(0, 5)}", car, i))
            i += 1
    # A 5-second bucket makes every carry path (prev, running max) cross bucket edges.
    assert run_clone(spark, rows, 10, bucket_ms=5_000) == clone_fold(rows, 10)


def cep_brute(hits, times, within):
    """All (car, start, end, n) with >= times severe hits and end - start < within."""
    out = []
    by_car = {}
    for t, i, m, car in sorted(hits):
        by_car.setdefault(car, []).append((t, i, m))
    for car, hs in by_car.items():
        hs.sort()
        for a in range(len(hs)):
            for b in range(a + times - 1, len(hs)):
                if hs[b][0] - hs[a][0] < within:
                    out.append((car, hs[a][0], hs[b][0], b - a + 1, ",".join(h[2] for h in hs[a:b + 1])))
    return sorted(out)


def run_cep(spark, rows, limits, within=120_000, emit="all", bucket_ms=3_600_000):
    p = passages_df(spark, rows)
    m = monitors_df(spark, limits)
    df = dangerous_driving(p, m, within=within, emit=emit, bucket_ms=bucket_ms)
    return sorted((r.car, r.start_time, r.end_time, r.n_events, ",".join(r.monitor_ids))
                  for r in df.collect())


def test_cep_span(spark):
    lim = [("A", 50)]  # severe from 60.0
    ok = [(0, "A", "X", 60.0), (60_000, "A", "X", 70.0), (119_999, "A", "X", 61.0)]
    far = [(0, "A", "Y", 60.0), (60_000, "A", "Y", 70.0), (120_000, "A", "Y", 61.0)]
    got = run_cep(spark, ok + far, lim)
    assert got == [("X", 0, 119_999, 3, "A,A,A")]


def test_cep_multiplicity_and_default_limit(spark):
    lim = [("A", 50)]
    rows = []
    for car, n in [("c3", 3), ("c4", 4), ("c5", 5)]:
        for k in range(n):
            rows.append((k * 1_000, "A", car, 99.0))
            rows.append((k * 1_000 + 500, "A", car, 10.0))      # non-hits between are ignored
    rows += [(0, "Q", "d", 72.0), (1, "Q", "d", 72.0), (2, "Q", "d", 72.0)]   # unknown: limit 60 -> 72.0 hits
    rows += [(0, "Q", "e", 71.9), (1, "Q", "e", 71.9), (2, "Q", "e", 71.9)]   # 71.9 misses
    rows = [(t, m, c, s, i) for i, (t, m, c, s) in enumerate(rows)]
    got = run_cep(spark, rows, lim)
    counts = {}
    for car, *_ in got:
        counts[car] = counts.get(car, 0) + 1
    assert counts == {"c3": 1, "c4": 3, "c5": 6, "d": 1}
    first = run_cep(spark, rows, lim, emit="first")
    assert sorted({r[0]: r[3] for r in first}.items()) == [("c3", 3), ("c4", 3), ("c5", 3), ("d", 3)]
    assert len(first) == 1 + 2 + 3 + 1


def test_cep_random_matches_brute_force_with_halo(spark):
    rnd = random.Random(11)
    rows, i = [], 0
    for car in ["A", "B", "HOT"]:
        t = 0
        for _ in range(300 if car == "HOT" else 80):
            t += rnd.choice([0, 1_000, 20_000, 50_000, 119_999, 120_000])
            rows.append((t, f"m{rnd.randint(0, 3)}", car, rnd.choice([30.0, 59.9, 60.0, 90.0]), i))
            i += 1
    lim = [(f"m{k}", 50) for k in range(4)]
    hits = [(t, i, m, car) for t, m, car, s, i in rows if 50 * 1.2 <= s]
    # A 150 s bucket puts many frames across bucket edges (served by the halo copies).
    got = run_cep(spark, rows, lim, bucket_ms=150_000)
    assert got == cep_brute(hits, 3, 120_000)


def test_clone_rank_buckets_split_a_burst(spark):
    """A hot car whose passages share few timestamps: rank buckets still agree with the fold."""
    rnd = random.Random(21)
    rows, i = [], 0
    for car, n in [("HOT", 900), ("a", 50), ("b", 50)]:
        t = 0
        for _ in range(n):
            t += rnd.choice([0, 0, 0, 9_000, 12_000]) if car == "HOT" else rnd.choice([3_000, 20_000])
            rows.append((t, f"m{rnd.randint(0, 3)}", car, i))
            i += 1
    p = passages_df(spark, [(t, m, car, 50.0, i) for t, m, car, i in rows])
    got = sorted((r.car, r.first_monitor, r.second_monitor, r.action_time)
                 for r in clone_plates(p, 10, bucketing="rank").collect())
    assert got == clone_fold(rows, 10)


def test_operators_accept_records_without_ids(spark):
    """Passages parsed from text have no id column: a derived id breaks ties."""
    from roadwatch.operators import area_distinct_running, pair_actions
    p = passages_df(spark, [(0, "a", "X", 99.0), (5_000, "b", "X", 99.0), (9_000, "c", "X", 99.0)]).drop("event_id")
    assert len(clone_plates(p, 10).collect()) == 1
    m = monitors_df(spark, [("a", 50), ("b", 50), ("c", 50)])
    assert len(dangerous_driving(p, m).collect()) == 1
    assert [r.distinct_cars for r in area_distinct_running(p, "1 minute").orderBy("action_time").collect()] == [1, 1, 1]
    v = spark.createDataFrame([("X", "e", 0)], "car string, msg string, create_time bigint")
    a = spark.createDataFrame([("1", "X", "done", 1_000)],
                              "police_id string, car string, action_status string, action_time bigint")
    assert [r.outcome for r in pair_actions(v, a, "5 seconds").collect()] == ["matched"]


def test_cep_rank_positions_match_brute_force(spark):
    rnd = random.Random(31)
    rows, i = [], 0
    for car in ["A", "HOT"]:
        t = 0
        for _ in range(250 if car == "HOT" else 60):
            t += rnd.choice([0, 0, 1_000, 50_000, 119_999, 120_000])
            rows.append((t, f"m{rnd.randint(0, 3)}", car, rnd.choice([30.0, 60.0, 90.0]), i))
            i += 1
    lim = [(f"m{k}", 50) for k in range(4)]
    hits = [(t, i, m, car) for t, m, car, s, i in rows if 50 * 1.2 <= s]
    p, m = passages_df(spark, rows), monitors_df(spark, lim)
    got = sorted((r.car, r.start_time, r.end_time, r.n_events, ",".join(r.monitor_ids))
                 for r in dangerous_driving(p, m, bucketing="rank").collect())
    assert got == cep_brute(hits, 3, 120_000)
    first = dangerous_driving(p, m, emit="first", bucketing="rank").count()
    assert first == dangerous_driving(p, m, emit="first").count()
