import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadwatch.llm import repeats as R

SCHEMA = "doc_id long, text string"


def brute(rows, length=13):
    docs = [(i, re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())) for i, t in rows]
    low = {}
    for i, w in docs:
        if i is not None:
            for j in range(len(w) - length + 1):
                k = tuple(w[j:j + length])
                low[k] = min(low.get(k, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for j in range(len(w) - length + 1):
            if i is not None and low[tuple(w[j:j + length])] < i:
                gone[j:j + length] = [True] * length
        spans = [(m.start(), m.end()) for m in re.finditer("1+", "".join("01"[g] for g in gone))]
        out.append((i, len(w), spans, b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted([(r.doc_id, r.n_words, [tuple(s) for s in r.repeats], r.kept) for r in R.remove_repeats(df, **kw).collect()], key=str)


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(r.choice([2, 20, 400]))] + ["é", " x", "z" * 5000]
    passages = [[r.choice(words) for _ in range(r.randint(5, 60))] for _ in range(12)]
    rows = []
    for i in range(120):
        t = []
        for _ in range(r.randint(0, 4)):
            t += r.choice(passages) if r.random() < .5 else [r.choice(words) for _ in range(r.randint(0, 50))]
        text = r.choice([" ", "\n", "\t "]) * r.randint(0, 1) + r.choice([" ", "\n", "  ", "\x0b"]).join(t)
        rows.append((r.choice([i, i, i, None, r.randint(0, 120)]), text if r.random() < .95 else None))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "h", "first", "kept", "digest")})
    assert run(df) == brute(rows)


@pytest.mark.parametrize("length,anchor", [(3, 1), (4, 4), (20, 2)])
def test_other_lengths(spark, length, anchor):
    rows = corpus(7)
    assert run(spark.createDataFrame(rows, SCHEMA), length=length, anchor=anchor) == brute(rows, length)


def test_copies_and_repeats_within_a_document(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(i, text) for i in range(300)] + [(400, " ".join(["x"] * 2000)), (401, " ".join(["x"] * 40) + " y"), (402, "short text"), (403, "short text"), (404, "")]
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got == brute(rows)
    assert sum(k != "" for i, _, _, k in got if i < 300) == 1  # one copy stays


def test_windows_shared_by_three_documents_in_pieces(spark):
    w = [f"p{i}" for i in range(40)]
    rows = [(1, " ".join(w[:20])), (2, " ".join(w[10:])), (3, " ".join(w)), (0, "q " + " ".join(w[25:38]) + " q")]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_tables_and_string_ids(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    text = " ".join(f"a{i}" for i in range(15))
    df = spark.createDataFrame([("b", text), ("a", "z " + text)], "doc_id string, text string")
    assert run(df) == [("a", 16, [], "z " + text), ("b", 15, [(0, 15)], "")]


def test_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 1 << 10)  # many blocks; words over a block are long words
    rnd = random.Random(3)
    long = [str(rnd.randint(0, 10 ** 6)) for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, "start " + " ".join(long[30_000:30_020]) + " end")]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    texts = ["aa b aa", " b\naa\tcc", "", "aa" * 3000 + " aa"]
    seen = {}
    for block in (1 << 22, 4):
        monkeypatch.setattr(R, "BLOCK", block)
        monkeypatch.setattr(R, "LONG_WORD", 5)
        data, starts, ends, first = R.cut_words(pa.array(texts))
        assert first.tolist() == [0, 3, 6, 6, 8]
        for lane in R.word_hashes(data, starts, ends):
            for s, e, h in zip(starts, ends, lane.tolist()):
                seen.setdefault(data[s:e].tobytes(), set()).add(h)
    assert all(len(h) == 2 for h in seen.values())  # one per lane
