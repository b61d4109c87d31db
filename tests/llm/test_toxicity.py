import zlib

import numpy as np

from roadwatch.llm import toxicity as T

DOCS = "doc_id long, text string, score string"


def corpus(n=400):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(n):
        words = [f"word{int(x)}" for x in rng.integers(0, 300, 60)]
        toxic = int(i % 5 == 0)
        if toxic:
            words[3:3] = ["muslims", "vilething", "nastything"] if i % 2 else ["vilething", "awfulthing"]
        docs.append((i, " ".join(words), "x"))
        labels.append((i, toxic))
    return docs, labels


def fit(spark, docs, labels, **kw):
    d = spark.createDataFrame(docs, DOCS)
    lab = T.training_rows(spark.createDataFrame(labels, "doc_id long, toxic int"))
    return d, T.train(d, lab, **kw)


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus()
    extra = [(1000, None, "x"), (1001, "", "x"), (None, "vilething nastything awfulthing", "x"), (7, docs[7][1], "x")]
    d, model = fit(spark, docs + extra, labels)
    got = T.score(d, model).collect()
    assert len(got) == len(docs) + 4 and all(0 <= r.score <= 1 for r in got)
    toxic = dict(labels)
    held = [r for r in got if r.doc_id in toxic and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 100 and np.mean([(r.score >= 0.7) == bool(toxic[r.doc_id]) for r in held]) >= 0.98
    assert all(r.score < 0.7 for r in got if r.doc_id in (1000, 1001))
    assert next(r for r in got if r.doc_id is None).score >= 0.7


def test_held_out_rule(spark):
    got = spark.range(50).withColumnRenamed("id", "doc_id").withColumn("h", T.held_out()).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    docs, labels = corpus()
    plain = fit(spark, docs, labels, counterfactual=0.0)[1]
    fair = fit(spark, docs, labels, counterfactual=30.0)[1]
    a, b = ("muslims word1 word2", "christians word1 word2")
    gap = [abs(m.scorer()(a) - m.scorer()(b)) for m in (plain, fair)]
    assert gap[1] < 0.25 * gap[0] and fair.scorer()(a) < 0.7


def test_a_repeated_id_counts_once(spark):
    docs, labels = corpus()
    once = fit(spark, docs, labels)[1]
    often = fit(spark, docs + [docs[10]] * 50, labels + [labels[10]] * 5)[1]
    assert once.weights.keys() == often.weights.keys() and abs(once.bias - often.bias) < 1e-9


def test_swaps_stay_in_their_group():
    assert T.swaps({"word"}) == []
    got = T.swaps({"muslims", "x"})
    assert len(got) == T.MAX_SWAPS and all("muslims" not in s and "x" in s for s in got)


def test_no_labels_or_one_class(spark):
    docs, labels = corpus(20)
    for lab in ([], [(i, 0) for i in range(20)], [(1, None), (None, 1)]):
        d, model = fit(spark, docs, lab)
        assert all(r.score <= 0.5 for r in T.score(d, model).collect())
    assert T.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_only_toxic_labels(spark):
    docs, _ = corpus(20)
    d, model = fit(spark, docs, [(i, 1) for i in range(20)])
    assert not model.weights and all(r.score <= 0.5 for r in T.score(d, model).collect())
