import hashlib
import re
from collections import defaultdict

import pytest

from roadwatch.llm.mixing import materialise, mix

SCHEMA = "doc_id long, text string, source string, size string, taken int"


def brute(rows, weights=(3, 1, 2), share=1.5, most=2):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows]
    tot = defaultdict(int)
    for s, (_, _, src, *_) in zip(size, rows):
        tot[src] += s
    names = sorted((s for s in tot if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in tot else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, budget = {}, set(names), share * sum(tot.values())
    while open_:
        left = budget - sum(target.values())
        above = {s for s in open_ if left * w[s] / sum(w[x] for x in open_) >= most * tot[s]}
        if not above:
            target.update({s: left * w[s] / sum(w[x] for x in open_) for s in open_})
            break
        target.update({s: most * tot[s] for s in above})
        open_ -= above
    out = []
    for s in names:
        own = sorted((hashlib.md5(str(r[0] if r[0] is not None else "").encode()).hexdigest(), r[0] or -1, n, i)
                     for i, (r, n) in enumerate(zip(rows, size)) if r[2] == s)
        passes, rest = divmod(int(target[s]), tot[s]) if tot[s] else (0, 0)
        for _, _, n, i in own:
            take = min(n, rest)
            rest -= take
            out.append((rows[i][0], n, tot[s], passes * n + take))
    return sorted(out, key=str), target


def rows_of(n, source):
    return [(i, " ".join(["w"] * (i * 7 % 23)) or None, source(i), "x", 1) for i in range(n)]


@pytest.mark.parametrize("source", [lambda i: f"s{i % 7}", lambda i: "hot" if i % 3 else f"s{i % 11}",
                                    lambda i: None if i % 4 == 0 else ("é" if i % 2 else "Z")])
def test_against_brute_force(spark, source):
    rows = rows_of(300, source) + [(None, "a b c", "Z", "x", 1)]
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    want, target = brute(rows)
    assert sorted(((r.doc_id, r.size, r.source_size, r.taken) for r in got), key=str) == want
    assert all(abs(r.target - target[r.source]) < 1e-6 and r.taken <= 2 * r.size for r in got)
    for s in target:
        assert sum(r.taken for r in got if r.source == s) == int(target[s] + 1e-9)


def test_empty_wordless_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).count() == 0
    got = mix(spark.createDataFrame([(1, None, "a", "", 0), (2, " \t", None, "", 0)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    got = mix(spark.createDataFrame([(1, "a b", "s", "", 0)] * 4, SCHEMA)).collect()
    assert sorted(r.taken for r in got) == [2, 2, 4, 4]


def test_materialised_words_equal_taken(spark):
    rows = rows_of(200, lambda i: f"s{i % 4}")
    mixed = mix(spark.createDataFrame(rows, SCHEMA).drop("size", "taken"))
    want = defaultdict(int)
    for r in mixed.collect():
        want[r.source] += r.taken
    got = defaultdict(int)
    for r in materialise(mixed).collect():
        got[r.source] += len((r.text or "").split())
    assert got == want


def test_rows_without_an_id_spread_over_ranges(spark):
    """A third of all rows share the NULL id (and an empty id has the same key)."""
    from pyspark.sql import functions as F
    from roadwatch.llm.mixing import _range
    rows = [(None if i % 3 == 0 else "" if i % 50 == 1 else str(i), " ".join(f"w{i % 9}x{j}" for j in range(1 + i * 7 % 23)), "hot" if i % 4 else "z", "x", 1)
            for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA.replace("doc_id long", "doc_id string"))
    got = mix(df).select("doc_id", "source", "size", "source_size", "taken", F.xxhash64("text").alias("h")).collect()
    for s in ("hot", "z"):
        own = [r for r in got if r.source == s]
        key = lambda r: (hashlib.md5((r.doc_id or "").encode()).hexdigest(), r.doc_id is not None, r.doc_id or "", r.size, r.h)
        budget = sum(r.taken for r in own)
        passes, rest = divmod(budget, own[0].source_size)
        want = []
        for r in sorted(own, key=key):
            take = min(r.size, rest)
            rest -= take
            want.append((r.doc_id, r.h, passes * r.size + take))
        assert sorted(((r.doc_id, r.h, r.taken) for r in own), key=str) == sorted(want, key=str)
    spread = df.withColumn("n", F.regexp_count("text", F.lit(r"\S+"))).groupBy(
        _range(F.md5(F.coalesce("doc_id", F.lit(""))), F.col("doc_id"), F.col("n"), F.xxhash64("text")).alias("r")).count()
    assert spread.agg(F.max("count")).first()[0] < 60    # 300 rows have no id
