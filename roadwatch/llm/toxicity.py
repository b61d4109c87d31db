"""Toxicity: a counterfactually regularised linear classifier.

Features of a text are the distinct hashed words and word beginnings it holds.
Their association with the label is counted on a bounded sample of labelled
rows (distributed, per class); the strongest are kept; and a logistic model is
fitted on the sample's sparse feature lists. In every sampled text that
mentions identity terms these are swapped for others of their group, and the
squared change of the model's logit is penalised (counterfactual logit
pairing), so a neutral mention of a group does not raise a score. Scoring is
one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.llm.common import cut, hash_sample, slices

#: Identity terms by group: each is swapped for the next ones of its group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("mothers", "fathers"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "mexican", "american", "chinese", "indian"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("young", "old"), ("disabled", "blind", "deaf"), ("immigrants", "refugees", "natives"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
#: Bounds of the training sample (rows per class), the model and the swaps per text.
MAX_POSITIVE = 3000
MAX_NEGATIVE = 6000
MAX_FEATURES = 2048
MAX_SWAPS = 3
#: Word beginnings of these lengths are features beside the whole word.
PREFIXES = (4, 5, 6)
#: Least association (z score of two proportions) and positive texts of a feature.
MIN_Z = 4.0
MIN_POSITIVE = 3
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
#: Words whose features a task remembers.
_CACHE = 150_000


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word (signed 64-bit)."""
    out = [xxhash.xxh64_intdigest(word) - (1 << 63)]
    for n in PREFIXES:
        if len(word) > n:
            out.append(xxhash.xxh64_intdigest("^" + word[:n]) - (1 << 63))
    return out


def swaps(words: set[str], groups=IDENTITY_GROUPS, most: int = MAX_SWAPS) -> list[set[str]]:
    """Counterfactual word sets: swap ``s`` replaces every identity term by the one ``s`` places on."""
    to = {t: g for g in groups for t in g}
    terms = [w for w in words if w in to]
    if not terms:
        return []
    out = []
    for s in range(1, 1 + min(most, max(len(to[t]) for t in terms) - 1)):
        new = {to[w][(to[w].index(w) + s) % len(to[w])] if w in to else w for w in words}
        if new != words and new not in out:
            out.append(new)
    return out


@dataclass
class Model:
    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0

    def scorer(self):
        cache: dict[str, tuple[int, ...]] = {}
        known = self.weights

        def score(text: str | None) -> float:
            hit: set[int] = set()
            for w in set(_WORD.findall(text.lower())) if text else ():
                f = cache.get(w)
                if f is None:
                    if len(cache) >= _CACHE:
                        cache.clear()
                    f = cache[w] = tuple(x for x in features(w) if x in known)
                if f:
                    hit.update(f)
            z = self.bias + sum(known[x] for x in sorted(hit))
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))
        return score


def fit_logistic(rows: list[list[int]], y: np.ndarray, pairs: list[tuple[int, list[int]]], n: int,
                 counterfactual: float = 1.0, ridge: float = 1e-4, rounds: int = 400, rate: float = 0.1):
    """Weights and bias of the penalised logistic model, by full-batch Adam.

    Loss: class-balanced log loss + ``ridge`` * |w|^2 + ``counterfactual`` *
    mean squared logit change over ``pairs`` (row, swapped row's features).
    """
    def dense(lists):
        x = np.zeros((len(lists), n), np.float32)
        for i, r in enumerate(lists):
            x[i, r] = 1
        return x

    x = dense(rows)
    delta = (dense([p for _, p in pairs]) - x[[i for i, _ in pairs]]) if pairs else np.zeros((0, n), np.float32)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())).astype(np.float32)
    w, b = np.zeros(n, np.float32), np.float32(0)
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, rounds + 1):
        err = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) * share
        g = x.T @ err + 2 * ridge * w
        if len(delta):
            g += 2 * counterfactual * (delta.T @ (delta @ w)) / len(delta)
        g = np.append(g, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), np.float32(b - step[-1])
    return w.astype(float), float(b)


def training_rows(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``labels`` rows that may be learned from: crc32 of the id's text, mod 3, is not 1."""
    return labels.where(F.col(id_col).isNotNull() & ~held_out(id_col))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          groups=IDENTITY_GROUPS, counterfactual: float = 1.0) -> Model:
    """Fit on ``labels`` (already restricted to rows that may be learned from).

    The sample takes the ids of lowest hash, at most :data:`MAX_POSITIVE` and
    :data:`MAX_NEGATIVE` per class; NULL labels and ids are left out, an id that
    is labelled or found more than once counts once per label, with its
    smallest text, and NULL texts are empty. Without
    rows of both classes the model is empty: every score is 0.5 or below.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)) \
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    labelled = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    low = [hash_sample(known.where(F.col("y") == c), ["id"], n, labelled.get(c, 0)) for c, n in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    sample = cut(low[0].unionByName(low[1]))
    texts = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                .join(F.broadcast(sample), "id")  # at most MAX_POSITIVE + MAX_NEGATIVE ids
                .groupBy("id", "y").agg(F.min("text").alias("text")))

    def counts(batches):
        seen: dict[int, list[int]] = {}
        for batch in slices(batches):
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in {f for w in set(_WORD.findall((t or "").lower())) for f in features(w)}:
                    seen.setdefault(f, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array([c[1] for c in seen.values()], pa.int64()),
                                          pa.array([c[0] for c in seen.values()], pa.int64())], ["f", "pos", "neg"])

    sizes = texts.groupBy("y").count().collect()
    total = {r["y"]: r["count"] for r in sizes}
    if not total.get(1) or not total.get(0):
        return Model(bias=min(0.0, float(np.log((total.get(1, 0) + 0.5) / (total.get(0, 0) + 1.5)))))
    tab = texts.select("y", "text").mapInArrow(counts, "f long, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, q = F.col("pos") / total[1], F.col("neg") / total[0]
    mean = (F.col("pos") + F.col("neg")) / (total[1] + total[0])
    z = (p - q) / F.sqrt(mean * (1 - mean) * (1 / total[1] + 1 / total[0]) + 1e-12)
    best = tab.where(F.col("pos") >= MIN_POSITIVE).withColumn("z", z).where(F.col("z") >= MIN_Z) \
        .orderBy(F.desc("z"), "f").limit(MAX_FEATURES).collect()
    number = {r["f"]: i for i, r in enumerate(best)}
    for g in groups:  # swapped terms are always features, so that the penalty reaches them
        for t in g:
            number.setdefault(features(t)[0], len(number))

    def vectors(batches):
        def pick(words):
            return sorted({number[f] for w in words for f in features(w) if f in number})
        for batch in slices(batches):
            out = []
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_WORD.findall((t or "").lower()))
                out.append((y, pick(words), [pick(s) for s in swaps(words, groups)]))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.list_(pa.int32())),
                                              pa.array([o[2] for o in out], pa.list_(pa.list_(pa.int32())))], ["y", "x", "swapped"])

    got = texts.select("y", "text").mapInArrow(vectors, "y int, x array<int>, swapped array<array<int>>").collect()
    got.sort(key=lambda r: (r["y"], r["x"]))
    y = np.array([r["y"] for r in got], np.float32)
    pairs = [(i, s) for i, r in enumerate(got) for s in r["swapped"]]
    w, b = fit_logistic([r["x"] for r in got], y, pairs, len(number), counterfactual)
    return Model({f: float(w[i]) for f, i in number.items() if w[i]}, b)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``keep`` columns (default: all) of every row and its ``score`` from 0 to 1.

    NULL and empty texts get the score of no features. A column called
    ``name`` in ``docs`` is replaced; repeated rows are scored alike.
    """
    keep = [c for c in (keep or docs.columns) if c != name]
    cols = [*keep, *([] if text_col in keep else [text_col])]
    at = cols.index(text_col)

    def run(batches):
        one = model.scorer()
        for b in slices(batches):
            s = [one(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(s, pa.float64())], [*keep, name])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*cols).mapInArrow(run, f"{schema}, `{name}` double")
