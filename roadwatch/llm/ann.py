"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are scaled to length 1, rotated by a random orthogonal matrix and
dealt to the lists of a coarse clustering. A query probes its nearest lists.
Within a list the vectors lie in column blocks; after each block the partial
squared distance, scaled to all dimensions, is an unbiased estimate (the
rotation is random), and a candidate is abandoned as soon as a test rejects
that its distance may still be below the query's current bound (Gao and Long,
2023). A first round over each query's nearest list gives the bound for its
other lists. What survives is scored exactly on the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadwatch.llm.common import cut, hash_sample
from roadwatch.llm.vectors import cosine, lengths, matrix, unit, usable

#: Distinct vectors on which lists and probes are fitted (fewer for very long
#: vectors: at most SAMPLE_VALUES components in all).
SAMPLE = 16384
SAMPLE_VALUES = 4_000_000
MAX_LISTS = 1024
#: Share of the sample's true neighbours that the probed lists must hold.
AIM = 0.99
#: Width of a column block, and the test's significance (epsilon in the paper).
COLUMNS = 16
EPSILON = 2.1
#: Vectors and queries of one list that meet in one task.
VECTOR_CHUNK = 8192
QUERY_CHUNK = 2048


@dataclass
class Index:
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int


def fit(sample: np.ndarray, count: int, k: int, seed: int = 7) -> Index:
    """Rotation, list centroids (spherical k-means) and probes from a sample of
    vectors; ``count`` is the number of all distinct vectors.

    ``probes`` is the least number of nearest lists that hold :data:`AIM` of
    the sample's own ``k`` nearest neighbours. Neighbours in a sample are
    farther away than in the whole table, so the estimate is on the safe side.
    """
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    x = unit(sample) @ rotation
    n = int(min(MAX_LISTS, max(1, round(count ** 0.5)), max(1, len(x) // 8)))
    c = x[rng.choice(len(x), n, replace=False)]
    for _ in range(8):
        own = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        empty = np.bincount(own, minlength=n) == 0
        total[empty] = x[rng.choice(len(x), int(empty.sum()))]
        c = total / np.maximum(1e-300, np.sqrt((total * total).sum(axis=1, keepdims=True)))
    own = (x @ c.T).argmax(axis=1)
    ask = rng.choice(len(x), min(len(x), 512), replace=False)
    near = x[ask] @ x.T
    near[np.arange(len(ask)), ask] = -np.inf
    m = min(k, len(x) - 1)
    if m < 1 or n == 1:
        return Index(rotation, c, n)
    best = np.argpartition(-near, m - 1, axis=1)[:, :m]
    place = np.argsort(np.argsort(-(x[ask] @ c.T), axis=1), axis=1)
    rank = np.take_along_axis(place, own[best], axis=1).ravel()
    return Index(rotation, c, int(min(n, np.quantile(rank, AIM) + 2)))


def scan(q: np.ndarray, x: np.ndarray, bound: float, k: int, epsilon: float = EPSILON) -> np.ndarray:
    """Positions in ``x`` (columns: vectors) that may be among the ``k`` nearest to ``q``.

    Column blocks are read in turn for the candidates still alive; the bound
    (infinite if there is none yet) falls to the whole distance of the ``k``
    nearest of them so far.
    """
    d, alive = len(q), np.arange(x.shape[1])
    partial = np.zeros(len(alive))
    for a in range(0, d, COLUMNS):
        z = min(d, a + COLUMNS)
        block = x[a:z, alive] - q[a:z, None]
        partial += (block * block).sum(axis=0)
        if len(alive) >= k:
            whole = x[:, alive[np.argpartition(partial, k - 1)[:k]]] - q[:, None]
            bound = min(bound, float((whole * whole).sum(axis=0).max()))
        slack = 1.0 if z == d else min(1.0, (1 + epsilon / np.sqrt(z)) ** 2 * z / d)
        keep = partial <= bound * slack + 1e-9
        alive, partial = alive[keep], partial[keep]
    return alive


def search(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` its ``k``
    nearest rows of ``df`` by cosine (all, if fewer), rows of the query's own id
    left out; nearest first, ties to the smaller id.

    Approximate: recall depends on the probed lists (see :func:`fit`); scores
    are exact. Vectors that are NULL, zero, hold NULL or non-finite components
    take no part, nor do rows without an id. A query's candidates are the
    vectors of its own length, and each length present has an index of its own.
    Equal vectors are one candidate that carries its ``k + 1`` smallest
    ids, so large groups of copies cost one vector and no result is lost. A
    query id that comes with several vectors is answered for each of them
    (equal rows once). Other columns are ignored.
    """
    found = [_search(df, queries, k, id_col, vec_col, d) for d in lengths(df, vec_col)]
    if not found:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _search(df: DataFrame, queries: DataFrame, k: int, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """:func:`search` among the vectors of length ``dim``."""
    kind = df.schema[vec_col].dataType.simpleString()

    def valid(t: DataFrame) -> DataFrame:
        v = F.col(vec_col)
        return t.where(F.col(id_col).isNotNull() & usable(v) & (F.size(v) == dim)) \
            .select(F.col(id_col).cast("long").alias("id"), v.cast(kind).alias("v"))

    copies = Window.partitionBy("v").orderBy("id")
    base = cut(valid(df).distinct().withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))  # at most k + 1 ids each
    count = base.count()
    take = max(1, min(SAMPLE, SAMPLE_VALUES // dim))
    sample = hash_sample(base.select("v"), ["v"], take, count).toArrow()
    index = fit(matrix(sample.column(0)), count, k)
    shared = df.sparkSession.sparkContext.broadcast((index.rotation, index.centroids, index.probes))  # bounded: lists and dimensions

    def assign(batches):
        rotation, centroids, _ = shared.value
        for b in batches:
            own = (unit(matrix(b.column(0))) @ rotation @ centroids.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.int32())], ["v", "ids", "list"])

    listed = cut(base.select("v", "ids").mapInArrow(assign, f"v {kind}, ids array<long>, list int"))
    sizes = listed.groupBy("list").agg(F.ceil(F.count("*") / VECTOR_CHUNK).cast("int").alias("chunks"))

    def probe(batches):
        rotation, centroids, probes = shared.value
        for b in batches:
            near = np.argsort(-(unit(matrix(b.column(1))) @ rotation @ centroids.T), axis=1, kind="stable")[:, :probes]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.tolist(), pa.list_(pa.int32()))], ["q", "v", "lists"])

    named = valid(queries).distinct()
    asked = cut(named.select("v").distinct().withColumn("q", F.monotonically_increasing_id()))  # fixed by the checkpoint
    probing = cut(asked.select("q", "v").mapInArrow(probe, f"q long, v {kind}, lists array<int>"))

    # A list's vectors and queries meet in chunks of bounded size, each pair of chunks in one group.
    chunk = F.pmod(F.xxhash64("v"), F.col("chunks").cast("long")).cast("int").alias("vc")

    def scanned(asks: DataFrame) -> DataFrame:
        """``asks(q, v, list, bound)`` against the lists: the best ids with their scores."""
        per = cut(asks.groupBy("list").agg(F.ceil(F.count("*") / QUERY_CHUNK).cast("int").alias("qchunks")))
        left = asks.join(per, "list").join(sizes, "list").select(
            "q", F.col("v").alias("qv"), "bound", "list", F.pmod(F.xxhash64("q"), F.col("qchunks").cast("long")).cast("int").alias("qc"),
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("vc"))
        right = listed.join(sizes, "list").join(per, "list").select(
            "v", "ids", "list", chunk, F.explode(F.sequence(F.lit(0), F.col("qchunks") - 1)).alias("qc"))

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            out = ([], [], [])
            if a.num_rows and b.num_rows:
                rotation = shared.value[0]
                queries_, vectors_, ids = matrix(a.column("qv")), matrix(b.column("v")), b.column("ids").to_pylist()
                rq, x = unit(queries_) @ rotation, np.ascontiguousarray((unit(vectors_) @ rotation).T)
                for i, (q, bound) in enumerate(zip(a.column("q").to_pylist(), a.column("bound").to_pylist())):
                    at = scan(rq[i], x, np.inf if bound is None else bound, k + 1)
                    if len(at):
                        s = cosine(np.broadcast_to(queries_[i], (len(at), dim)), vectors_[at])
                        best = sorted((-c, j) for c, p in zip(s.tolist(), at.tolist()) for j in ids[p])[:k + 1]
                        for c, j in best:
                            out[0].append(q), out[1].append(j), out[2].append(-c)
            return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["q", "vec_id", "score"])

        key = ["list", "vc", "qc"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "q long, vec_id long, score double")

    first = cut(scanned(probing.select("q", "v", F.col("lists")[0].alias("list"), F.lit(None).cast("double").alias("bound"))))
    # The bound: the distance of the (k+1)-th best of the nearest list, where it has as many.
    nth = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    bound = first.withColumn("n", F.row_number().over(nth)).where(F.col("n") == k + 1) \
        .select("q", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("bound"))
    others = probing.join(bound, "q", "left").select("q", "v", "bound", F.explode(F.slice("lists", 2, max(1, index.probes))).alias("list"))
    found = first.unionByName(scanned(others)).withColumn("n", F.row_number().over(nth)).where(F.col("n") <= k + 1) \
        .groupBy("q").agg(F.collect_list(F.struct("vec_id", "score")).alias("best"))  # at most k + 1 each
    answers = named.join(asked, "v").select("id", "q").join(found, "q") \
        .select("id", "q", F.explode(F.slice(F.array_sort(
            F.filter("best", lambda x: x["vec_id"] != F.col("id")),
            lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1)
            .when(x["vec_id"] < y["vec_id"], -1).when(x["vec_id"] > y["vec_id"], 1).otherwise(0)), 1, k)).alias("x"))
    rank = F.row_number().over(Window.partitionBy("id", "q").orderBy(F.desc("x.score"), "x.vec_id"))
    return answers.select(F.col("id").alias("query_id"), rank.cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
