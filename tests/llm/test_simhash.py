from pyspark.sql import functions as F
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from roadwatch.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component_id long"


def brute_fp(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius=3):
    seen, out = {}, {}
    distinct = sorted(set(fps.values()))
    for root in distinct:
        if root in seen:
            continue
        stack, seen[root] = [root], root
        while stack:
            x = stack.pop()
            for y in distinct:
                if y not in seen and (x ^ y).bit_count() <= radius:
                    seen[y] = root
                    stack.append(y)
    low = defaultdict(list)
    for i, f in fps.items():
        low[seen[f]].append(i)
    for i, f in fps.items():
        out[i] = min(low[seen[f]])
    return out


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_every_pair_within_the_radius_shares_a_table(radius):
    rng = np.random.default_rng(radius)
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        flip = sum(1 << int(i) for i in rng.choice(64, radius, replace=False))
        assert any(flip & m == 0 for m in masks)
        m = next(m for m in masks if flip & m == 0)
        assert any(flip & s == 0 for s in simhash.second_masks(m, radius))


def texts():
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{int(x)}" for x in rng.integers(0, 400, 160)) for _ in range(6)]
    out = [None, "", " \t\n", "One two", "one\x0b two", "One", "é b c", base[0], base[0], base[0].upper()]
    for b in base:
        for _ in range(25):
            w = b.split()
            w[int(rng.integers(0, len(w)))] = "zz"
            out.append(" ".join(w))
    out.append(" ".join(["long"] * 150_000))
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return [(r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in simhash.simhash_groups(df).collect()]


def test_against_brute_force_with_clashing_columns(spark):
    rows = [(i, t, "x", -1) for i, t in enumerate(texts())]
    got = {d: (f, c) for d, f, c in run(spark, rows)}
    fps = {i: brute_fp(t) for i, t, _, _ in rows}
    assert {d: f for d, (f, _) in got.items()} == fps
    assert {d: c for d, (_, c) in got.items()} == brute_components(fps)


def test_split_buckets_give_the_same_groups(spark, monkeypatch):
    rows = [(i, t, "x", -1) for i, t in enumerate(texts()[:100])]
    whole = sorted(run(spark, rows))
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", 3)
    assert sorted(run(spark, rows)) == whole


def test_null_ids_repeated_rows_and_empty_table(spark):
    got = run(spark, [(None, "a b c d", "", 0), (7, "a b c d", "", 0), (7, "a b c d", "", 0), (None, "x y z", "", 0)])
    assert sorted((c is None, c) for _, _, c in got) == [(False, 7)] * 3 + [(True, None)]
    assert run(spark, []) == []


def test_drop_near_copies(spark):
    df = spark.createDataFrame([(3, "a b c d", "", 0), (2, "A b c d", "", 0), (2, "A b c d", "", 0), (5, "q r s t u", "", 0),
                                (None, "a b c d", "", 0)], SCHEMA)
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [2, 5]  # the row without an id is a copy like the others


def test_one_row_stays_per_group(spark):
    from roadwatch.llm import simhash
    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue white black")
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "x"), (None, c, "p"), (None, c, "q"), (5, "lone words only here now", "x"), (5, "lone words only here now", "x"), (None, b, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("th", F.lit(1)).withColumn("fp", F.lit("f"))
    for n in (1, 5):
        got = simhash.drop_near_copies(df.repartition(n))
        assert got.columns == df.columns
        found = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
        assert found == sorted([(1, a), (1, b), (None, c), (5, "lone words only here now")], key=str)
    assert simhash.drop_near_copies(df.limit(0)).count() == 0
