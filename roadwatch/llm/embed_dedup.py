"""Near-duplicate embeddings by a pivot-permutation index.

Reference points (pivots) are drawn from the data, far apart from each other.
Each vector is described by its nearest pivots in order; vectors that are
close see the same pivots first. Inverted lists are kept by pair of pivots,
so two vectors meet exactly if they share two or more of their first
:data:`PREFIX` pivots, and the number they share must reach a minimum before
the cosine is computed. A pair is counted in one list only, that of its two
lowest shared pivots, so links are counted without gathering pairs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.llm.common import components, cut, hash_sample
from roadwatch.llm.vectors import cosine, lengths, matrix, unit, usable

PREFIX = 7
#: Shared pivots that make a candidate (2 or more).
SHARED = 2
THRESHOLD = 0.9
#: Pivots grow with the square root of the vectors (so list lengths stay level), within these bounds.
MIN_PIVOTS, MAX_PIVOTS = 64, 2048
#: Sampled vectors per pivot, and the components a sample may have in all.
DRAWN, SAMPLE_VALUES = 4, 4_000_000
#: Pivots closer than this are not both taken while others are left.
APART = 0.7
#: Rows of a list that meet in one task; longer lists are dealt into chunks, and every pair of chunks meets.
CHUNK = 2048
#: Pairs whose pivots are compared at a time.
PAIRS = 1 << 16


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of the sample (unit length) in order, first those that are not close
    to one taken before, then the skipped ones."""
    x = unit(sample)
    taken: list[int] = []
    near = np.full(len(x), -1.0)
    for i in range(len(x)):
        if len(taken) < n and near[i] < APART:
            taken.append(i)
            near = np.maximum(near, x @ x[i])
    chosen = set(taken)
    taken += [i for i in range(len(x)) if i not in chosen][:max(0, n - len(taken))]
    return x[taken]


def describe(x: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The numbers of each row's nearest pivots, nearest first."""
    s = unit(x) @ pivots.T
    return np.argsort(-s, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def compare(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, key: tuple[int, int],
            threshold: float, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and ``y`` (original vectors; ``px``, ``py``: their pivots) that link and whose lowest two shared pivots are ``key``.

    All rows of a list share its two pivots. One matrix product finds the pairs near
    the threshold; for these the shared pivots are counted, a block at a time, and
    only at the threshold itself is the cosine computed again in full precision.
    """
    s = unit(x) @ unit(y).T
    i, j = np.nonzero(s >= threshold - 1e-9)
    close = s[i, j] < threshold + 1e-9
    keep = np.ones(len(i), bool)
    for at in range(0, len(i), PAIRS):
        a, b = px[i[at:at + PAIRS]], py[j[at:at + PAIRS]]
        common = np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, np.iinfo(np.int64).max)
        lowest = np.sort(common, axis=1)
        count = (lowest < np.iinfo(np.int64).max).sum(axis=1)
        # A pair whose lowest shared pivots are others belongs to their list.
        keep[at:at + PAIRS] = (count >= shared) & (lowest[:, 0] == key[0]) & (lowest[:, 1] == key[1])
    for at in np.array_split(np.flatnonzero(close & keep), 1 + int((close & keep).sum()) // PAIRS):
        keep[at] = cosine(x[i[at]], y[j[at]]) >= threshold
    return i[keep], j[keep]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                    shared: int = SHARED) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row per row of ``df``.

    Rows link if the index brings them together and the cosine of their
    vectors is at least ``threshold``; nothing below it links. ``n_links``
    counts other rows, equal vectors included (these are collapsed and counted
    before anything is compared). ``component_id`` is the smallest id
    reachable, ``kept`` whether it is the row's own. Vectors that are NULL,
    zero or hold NULL or non-finite components link with nothing, vectors of
    different lengths not with each other (each length present has its own
    pivots and lists), nor do rows without an id (their ``component_id``
    and ``kept`` are NULL). Rows that share an id count as one node of the
    component. Other columns are ignored.
    """
    ident, v = F.col(id_col).cast("long"), F.col(vec_col)
    ok = ident.isNotNull() & usable(v)
    rows = df.select(ident.alias("id"), F.when(ok, v).alias("v"))
    out = rows.where("v IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    present = lengths(df, vec_col)
    if present:
        whole = cut(rows.where("v IS NOT NULL"))
        parts = [_linked(whole.where(F.size("v") == d), d, threshold, shared) for d in present]
        if len(parts) > 1:
            # An id that comes with vectors of several lengths is one node: it joins their components.
            both = reduce(DataFrame.unionByName, parts)
            parts = [_joined(cut(both))]
        out = out.unionByName(parts[0])
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def _joined(rows: DataFrame) -> DataFrame:
    """``rows(id, n_links, component_id)`` of several lengths with the components an id connects merged."""
    roots = components(rows.select(F.col("id").alias("a"), F.col("component_id").alias("b"))).select(F.col("node").alias("id"), "root")
    return rows.join(roots, "id", "left").select("id", "n_links", F.coalesce("root", "component_id").alias("component_id"))


def _linked(rows: DataFrame, dim: int, threshold: float, shared: int) -> DataFrame:
    distinct = cut(rows.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies")))
    count = distinct.count()
    n = int(min(MAX_PIVOTS, max(MIN_PIVOTS, round(2 * count ** 0.5))))
    drawn = max(1, min(DRAWN * n, SAMPLE_VALUES // dim))
    sample = hash_sample(distinct.select("v"), ["v"], drawn, count).toArrow()
    pivots = choose_pivots(matrix(sample.column(0)), n)
    prefix = min(PREFIX, len(pivots))
    kind = rows.schema["v"].dataType.simpleString()
    shared_pivots = rows.sparkSession.sparkContext.broadcast(pivots)  # bounded: MAX_PIVOTS rows

    def lists(batches):
        pv = shared_pivots.value
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(describe(matrix(b.column(2)), pv, prefix).tolist(), pa.list_(pa.int32()))], ["node", "copies", "v", "p"])

    described = cut(distinct.select("node", "copies", "v").mapInArrow(lists, f"node long, copies long, v {kind}, p array<int>"))
    if prefix < 2:  # a single vector: no pair
        found = described.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).cast("long").alias("links")).limit(0)
    else:
        found = cut(_pairs(described, threshold, shared))
    roots = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    summary = distinct.join(links, "node", "left").join(roots.withColumnRenamed("root", "component_id"), "node", "left") \
        .select("v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "node").alias("component_id"))
    return rows.join(summary, "v").select("id", "n_links", "component_id")


def _pairs(described: DataFrame, threshold: float, shared: int) -> DataFrame:
    """``(a, links, b)``: per list and node with links there, their number and a node of the same component."""
    ordered = F.array_sort("p")
    pair = F.flatten(F.transform(ordered, lambda x, i: F.transform(
        F.slice(ordered, i + 2, F.size(ordered)), lambda y: F.struct(x.alias("p"), y.alias("q")))))
    rows = described.withColumn("k", F.explode(pair)).select("node", "copies", "v", "p", F.col("k.p").alias("kp"), F.col("k.q").alias("kq"))
    sizes = described.select(F.explode(pair).alias("k")).groupBy(F.col("k.p").alias("kp"), F.col("k.q").alias("kq")).count() \
        .where("count > 1").select("kp", "kq", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    # Chunk c of a list meets every chunk: it goes to the groups (least, greatest) of c and each other.
    mine = F.pmod(F.xxhash64("node"), F.col("chunks").cast("long")).cast("int")
    dealt = rows.join(sizes, ["kp", "kq"]).withColumn("c", mine) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .select("node", "copies", "v", "p", "kp", "kq", "c", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))

    def run(t: pa.Table) -> pa.Table:
        node, copies, chunk = (t.column(c).to_numpy() for c in ("node", "copies", "c"))
        x, p = matrix(t.column("v")), matrix(t.column("p")).astype(np.int64)
        key, i, j = (t.column("kp")[0].as_py(), t.column("kq")[0].as_py()), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))

        def top(k):
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        for s in range(0, len(left), 512):
            rows_ = left[s:s + 512]
            a, b = compare(x[rows_], x[right], p[rows_], p[right], key, threshold, shared)
            a, b = rows_[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for u, w in zip(a.tolist(), b.tolist()):
                u, w = top(u), top(w)
                if u != w:
                    root[max(u, w)] = min(u, w)
        on = np.flatnonzero(links)
        return pa.table([node[on], links[on], node[[top(k) for k in on.tolist()]] if len(on) else node[on]], names=["a", "links", "b"])

    return dealt.groupBy("kp", "kq", "i", "j").applyInArrow(run, "a long, links long, b long")
