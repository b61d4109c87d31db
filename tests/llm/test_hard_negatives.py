import numpy as np
import pytest
from pyspark.sql import functions as F

from roadwatch.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors):
    ok = [(i, label, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v, label in rows
          if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a in sorted({r for r in ok if r[0] in anchors}):
        rest = list(ok)
        rest.remove(a)
        scored = [(-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1] == a[1]) for r in rest if len(r[2]) == len(a[2])]
        negatives = sorted((s, i) for s, i, same in scored if not same)
        for s, i in sorted((s, i) for s, i, same in scored if same)[:5]:
            window = [(t, n) for t, n in negatives if 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a[0], i, k + 1, n, -s, -t) for k, (t, n) in enumerate(window)]
    return sorted(out)


def rows_of(rng, n=400, d=16, rounded=False):
    base = rng.standard_normal((8, d))
    x = base[rng.integers(0, 8, n)] + rng.standard_normal((n, d)) * rng.choice([0, .1, 1], n)[:, None]
    if rounded:  # many equal scores
        x = np.round(x) * rng.choice([.01, 1], n)[:, None]
    return [(i if i % 17 else i // 2, [float(np.float32(c)) for c in v], int(rng.integers(0, 4)) if i % 40 else None) for i, v in enumerate(x)]


ODD = [(7, [1.0] * 3, 1), (11, [.5] * 3, 1), (10, [2.0] * 3, 2), (50, None, 1), (60, [None] * 16, 1), (70, [float("inf")] * 16, 2),
       (30, [0.0] * 16, 1), (40, [], 1), (41, [], 1), (None, [1.0] * 16, 1)]


@pytest.mark.parametrize("cell,block,ask,leaf,rounded", [(8192, 1 << 21, 1 << 19, 64, False), (60, 16 * 40, 16 * 3, 5, False),
                                                         (20, 16 * 40, 16 * 3, 5, True)])
def test_against_brute_force(spark, monkeypatch, cell, block, ask, leaf, rounded):
    for name, value in (("CELL_ROWS", cell), ("BLOCK_VALUES", block), ("ASK_VALUES", ask), ("LEAF", leaf)):
        monkeypatch.setattr(H, name, value)
    rows = rows_of(np.random.default_rng(cell), rounded=rounded)
    rows += [rows[i] for i in (3, 10, 20)] + ODD  # repeated rows, odd rows, other lengths
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "h", "v", "cell", "score", "rank")})
    got = sorted(map(tuple, H.hard_negatives(df, df.where("vec_id % 10 = 0")).collect()))
    assert got and got == brute(rows, set(range(0, 1000, 10)))


def test_small_and_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(empty, empty).count() == 0
    one = spark.createDataFrame([(0, [1.0, 0.0], 1)], SCHEMA)
    assert H.hard_negatives(one, one).count() == 0
    three = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.5], 2)], SCHEMA)
    assert [tuple(r) for r in H.hard_negatives(three, three.where("vec_id = 0")).collect()] == [(0, 1, 1, 2, 65536, 49152)]


def test_huge_components_stay_exact(spark):
    big = float(np.float32(3e6))
    rows = [(0, [big, 1.0, 0.0], 1), (1, [big, 2.0, 0.0], 1), (2, [big * 0.75, 3.0, 1.0], 2), (3, [big * 0.75, 3.0, 1.0], 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, H.hard_negatives(df, df.where("vec_id = 0")).collect())) == brute(rows, {0})


def test_cover_tree_covers():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((700, 8))
    x[100:300] = x[100]  # copies
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    order, levels = H.cover_tree(x)
    assert sorted(order.tolist()) == list(range(700))
    held = []
    for depth, n in enumerate(levels):
        for c, r, a, z, leaf in zip(n.centres, n.radius, n.start, n.end, n.leaf):
            assert (H.angle(x[order[a:z]] @ c) <= r + 1e-7).all()
            if leaf:
                held += range(a, z)
        if depth:  # radii fall from level to level
            assert (n.radius <= 2 * levels[depth - 1].radius[n.parent] + 1e-7).all()
    assert sorted(held) == list(range(700))


def test_outside_nodes_are_skipped():
    """Clustered rows: most leaves lie outside a narrow window and are not read."""
    rng = np.random.default_rng(5)
    centres = 50 * rng.standard_normal((40, 16))
    x = np.floor(256 * (centres[rng.integers(0, 40, 4000)] + 0.01 * rng.standard_normal((4000, 16))))
    norm = np.sqrt((x * x).sum(axis=1)).max()
    _, levels = H.cover_tree(H.Sphere(norm).lift(x))
    q = x[:50]
    own = (q * q).sum(axis=1)
    starts, ends, reach = H.descend(q, (0.9 * own).astype(np.int64), (1.1 * own).astype(np.int64), levels, norm)
    read = ((reach > -np.inf) * (ends - starts)).sum(axis=1)
    assert read.mean() < 0.25 * len(x)
