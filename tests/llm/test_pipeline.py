import re

import numpy as np
import pytest

import corpus_pipeline as P
from roadwatch.llm import simhash, toxicity
from roadwatch.llm.common import word_count

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    folder = str(tmp_path_factory.mktemp("sf"))
    docs, labels = [], []
    for i in range(240):
        words = [f"word{int(x)}" for x in rng.integers(0, 900, 80)]
        toxic = i % 6 == 0
        if toxic:
            words[5:5] = ["vilething", "nastything", "vilething"]
        if i % 7 == 3:
            words[9:9] = ["password=hunter2hunter2"]
        docs.append([i, " ".join(words), "en", None if i % 5 == 4 else f"s{i % 5}", 0])
        labels.append((i, 1, int(toxic)))
    docs[31][1] = docs[30][1] = docs[29][1].upper()
    docs += [[500, None, None, None, None], [501, "", "en", "s0", 0], [None, "orphan text of five words", "en", "s1", 25], docs[2][:]]
    for d in docs:
        d[4] = len(d[1] or "")
    spark.createDataFrame([tuple(d) for d in docs], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_one_by_one(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = {}
    for name, stage in P.STAGES:
        got = stage(spark, docs, tables).collect()
        out[name] = got
        if name != P.STAGES[-1][0]:
            docs = spark.createDataFrame(got, SCHEMA)
            assert list(got[0].asDict()) == [f.name for f in docs.schema]
    # Toxic documents go, clean ones stay.
    left = {r.doc_id for r in out["toxicity"]}
    assert not any(i % 6 == 0 for i in left if i is not None and i < 240 and i not in (30,))
    assert {i for i in range(240) if i % 6 and i not in (29, 30, 31)} <= left and {500, 501, None} <= left
    # One of each group: brute force over the fingerprints.
    kept = out["toxicity"]
    fp = simhash.fingerprints([(r.text or "").encode() for r in kept], 3).tolist()
    root = list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                root = [root[b] if x == root[a] else x for x in root]
    groups = {}
    for r, g in zip(kept, root):
        groups.setdefault(g, []).append(r.doc_id)
    want = sorted(min(i for i in g if i is not None) for g in groups.values() if any(i is not None for i in g))
    assert sorted(r.doc_id for r in out["simhash_near_dedup"] if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in out["simhash_near_dedup"]) == 1
    # Secrets are blacked out, everything else is as it was.
    before = {r.doc_id: r for r in out["simhash_near_dedup"]}
    assert len(out["secret_scans"]) == len(before)
    for r in out["secret_scans"]:
        old = before[r.doc_id].text
        assert r.text == (None if old is None else re.sub(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8,}", "[assign]", old))
        assert r.n_chars == (None if r.text is None else len(r.text))
    # The mix holds each source's budget to the word; bins hold the mix.
    mixed = sum(len((r.text or "").split()) for r in out["mixing"])
    total = sum(len((r.text or "").split()) for r in out["secret_scans"])
    assert 1.5 * total - len({r.source for r in out["secret_scans"]}) <= mixed <= 1.5 * total
    assert sum(r["size"] for r in out["best_fit_packing"]) == mixed


def test_run_and_empty_tables(spark, tables, tmp_path):
    assert P.run(spark, tables).count() > 100
    for t in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_all_rows_stay_if_only_toxic_labels_match(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/labels.parquet").where("toxic = 1").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert P.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()


def test_word_counts(spark):
    rows = [("a b", 2), (None, 0), ("", 0), ("\t\n a\x0bb\x0cc\rd e f ", 5), ("\x1c \x1d", 2)]
    df = spark.createDataFrame(rows, "t string, n int")
    assert all(r.n == r.c for r in df.withColumn("c", word_count(df.t)).collect())


def test_training_bounds():
    assert toxicity.MAX_POSITIVE + toxicity.MAX_NEGATIVE <= 10_000 and toxicity.MAX_FEATURES <= 4096


def test_hash_sample_is_exact_and_bounded(spark):
    from roadwatch.llm.common import hash_sample
    df = spark.range(20_000).withColumnRenamed("id", "k")
    some = hash_sample(df, ["k"], 300, 20_000)
    assert some.count() == 300
    assert sorted(r.k for r in some.collect()) == sorted(r.k for r in hash_sample(df, ["k"], 300, 0).collect())
    assert hash_sample(df.limit(5), ["k"], 300, 5).count() == 5
