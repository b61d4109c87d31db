"""Hard-negative mining with cover trees over norm-augmented candidates.

A candidate ``y`` gets one more coordinate, ``sqrt(M**2 - |y|**2)`` with M the
largest norm, and an anchor a zero: inner products stay, and all candidates
lie on one sphere, where a node's covering radius is an angle. Everything below
a node with centre ``c`` and angle ``r`` then has an inner product with ``q``
between ``|q| M cos(t + r)`` and ``|q| M cos(t - r)``, ``t`` being the angle
between ``q`` and ``c``: a node outside the wanted window of scores is skipped.

The top level is a net of cells for the whole table (centres from a bounded
sample, radii over all rows); each cell's rows lie in blocks of bounded size,
and each block holds a cover tree: a node's children are centres picked
farthest first, so they are as far apart as they cover, and radii fall level
by level. An anchor visits its most promising cell first and then, with the
scores found there as bound, the cells that may still hold better ones.
Leaves are verified exactly, in integers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadwatch.llm.common import cut, hash_sample
from roadwatch.llm.vectors import by_length, finite, matrix

#: Components x become floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these shares (in hundredths) of the positive's.
LOW, HIGH = 50, 95
#: Rows of a cell aimed at, most cells, and the sample for their centres.
CELL_ROWS, MAX_CELLS = 8192, 1024
SAMPLE, SAMPLE_VALUES = 8192, 4_000_000
#: Rows and anchors that meet in one task (fewer for very long vectors).
BLOCK_VALUES, ASK_VALUES = 1 << 21, 1 << 19
#: Children of a node, rows of a leaf.
FANOUT, LEAF = 16, 64
#: Leaves read per round, best first; the last round reads all that may still matter.
ROUNDS = (4, 16, None)
#: Angles come from rounded cosines: bounds are widened by this share.
SLACK = 1e-6
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(x: np.ndarray) -> np.ndarray:
    """Whole numbers as doubles (exact: scaling by a power of two and floor)."""
    return np.floor(x * SCALE)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: doubles if these hold them
    exactly, else Python integers, clipped to 64 bits."""
    if a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2.0 ** 53:
        return a @ b.T
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object)
    return np.clip(whole(a) @ whole(b).T, LEAST, MOST).astype(np.int64)


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


class Sphere:
    """Augmentation to the sphere of radius ``norm`` (directions only: all of length 1)."""

    def __init__(self, norm: float):
        self.norm = norm or 1.0

    def lift(self, y: np.ndarray) -> np.ndarray:
        y = y / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(axis=1)))
        return np.hstack([y, rest[:, None]])


def bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``q`` with what a node may hold."""
    size = np.sqrt((q * q).sum(axis=1, keepdims=True))
    t = angle((q / np.where(size > 0, size, 1)) @ centres[:, :-1].T)
    wide = size * norm
    slack = SLACK * wide + 1e-6
    return wide * np.cos(np.minimum(np.pi, t + radius)) - slack, wide * np.cos(np.maximum(0.0, t - radius)) + slack


def farthest_first(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to ``n`` rows of ``x`` (length 1), each the farthest from those before,
    starting with the first; every row's nearest of them and its cosine to it."""
    taken, owner, near = [0], np.zeros(len(x), np.int64), x @ x[0]
    while len(taken) < n:
        far = int(near.argmin())
        if near[far] >= 1 - 1e-12:
            break  # only copies are left
        s = x @ x[far]
        closer = s > near
        owner[closer], near[closer] = len(taken), s[closer]
        taken.append(far)
    return np.array(taken), owner, near


@dataclass
class Level:
    """Nodes of one level: centres, covering angles, rows (from, to), parents."""
    centres: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    end: np.ndarray
    parent: np.ndarray
    leaf: np.ndarray


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, list[Level]]:
    """Order of the rows of ``x`` (length 1) and the levels of their cover tree, the root's first."""
    order = np.arange(len(x))
    level = [(0, len(x), 0, 0)]  # from, to, parent, place of the centre in order
    levels = []
    while level:
        rows, following = ([], [], [], [], [], []), []
        for a, z, parent, centre in level:
            order[[a, centre]] = order[[centre, a]]
            part = x[order[a:z]]
            picked, owner, near = farthest_first(part, FANOUT if z - a > LEAF else 1)
            reach = angle(part @ part[0]).max()
            split = len(picked) > 1
            if split:
                by = np.argsort(owner, kind="stable")
                place = np.empty(len(by), np.int64)
                place[by] = np.arange(len(by))
                order[a:z] = order[a:z][by]
                stops = np.cumsum(np.bincount(owner, minlength=len(picked)))
                for j, (s, e) in enumerate(zip([0, *stops[:-1].tolist()], stops.tolist())):
                    following.append((a + s, a + e, len(rows[0]), a + int(place[picked[j]])))
            for to, value in zip(rows, (part[0], reach, a, z, parent, not split)):
                to.append(value)
        levels.append(Level(*(np.array(r) for r in rows)))
        level = following
    return order, levels


def descend(q: np.ndarray, low: np.ndarray, high: np.ndarray, levels: list[Level], norm: float):
    """The leaves (start, end) and, per row of ``q``, the greatest inner product each
    may hold below the window's end; -inf where the leaf or a node above it lies outside."""
    alive = np.ones((len(q), 1), bool)
    starts, ends, reach = [], [], []
    for n in levels:
        least, most = bounds(q, n.centres, n.radius, norm)
        on = alive[:, n.parent] & (most >= low[:, None]) & (least <= high[:, None])
        starts.append(n.start[n.leaf])
        ends.append(n.end[n.leaf])
        reach.append(np.where(on, np.minimum(most, high[:, None]), -np.inf)[:, n.leaf])
        alive = on
    return np.concatenate(starts), np.concatenate(ends), np.hstack(reach)


def search_block(q: np.ndarray, low: np.ndarray, high: np.ndarray, label: np.ndarray, k: int, same: bool,
                 x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of a block for each anchor (row of ``q``): score in the
    anchor's window, label equal (``same``) or different; ties to smaller ids.
    Positions of anchors and rows, and scores."""
    norm = float(np.sqrt((x * x).sum(axis=1)).max(initial=0.0)) or 1.0
    order, levels = cover_tree(Sphere(norm).lift(x))
    x, ids, labels = x[order], ids[order], labels[order]
    out = ([], [], [])
    for a in range(0, len(q), 1024):
        part = slice(a, a + 1024)
        starts, ends, reach = descend(q[part], low[part], high[part], levels, norm)
        floor = low[part].copy()
        best = [np.zeros(0, np.int64)] * 3  # anchor, row, score
        for count in ROUNDS:
            reach[reach < floor[:, None]] = -np.inf
            if count is None or count >= reach.shape[1]:
                now = reach > -np.inf
            else:
                now = np.zeros(reach.shape, bool)
                np.put_along_axis(now, np.argpartition(-reach, count, axis=1)[:, :count], True, axis=1)
                now &= reach > -np.inf
            found = [best]
            for leaf in np.flatnonzero(now.any(axis=0)).tolist():
                who, s = np.flatnonzero(now[:, leaf]), slice(starts[leaf], ends[leaf])
                score = products(q[part][who], x[s])
                equal = labels[s][None, :] == label[part][who][:, None]
                i, j = np.nonzero((equal == same) & (score >= floor[who][:, None]) & (score <= high[part][who][:, None]))
                found.append([who[i], j + starts[leaf], score[i, j].astype(np.int64)])
                if sum(len(f[0]) for f in found) > 1 << 20:
                    found = [_best(found, ids, k)]
            reach[now] = -np.inf
            best = _best(found, ids, k)
            full = np.bincount(best[0], minlength=len(floor)) == k
            least = np.full(len(floor), MOST)
            np.minimum.at(least, best[0], best[2])
            floor = np.where(full, np.maximum(floor, least), floor)
            if not (reach > -np.inf).any():
                break
        for to, value in zip(out, (best[0] + a, order[best[1]], best[2])):
            to.append(value)
    return tuple(np.concatenate(v) if v else np.zeros(0, np.int64) for v in out)


def _best(found: list, ids: np.ndarray, k: int) -> list[np.ndarray]:
    who, row, score = (np.concatenate([f[i] for f in found]) for i in range(3))
    by = np.lexsort((ids[row], ~score, who))
    who, row, score = who[by], row[by], score[by]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    return [v[place < k] for v in (who, row, score)]


class Cells:
    """The top level: per vector length a net of cells, with the sphere and covering angles over all rows."""

    def __init__(self, norms: dict[int, float], centres: dict[int, np.ndarray], radius: dict[int, tuple] = {}):
        self.norms, self.centres, self.radius = norms, centres, radius

    def assign(self, d: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row and its angle to the centre (without centres: one cell that reaches everywhere)."""
        if d not in self.centres:
            return np.zeros(len(x), np.int32), np.full(len(x), np.pi)
        s = Sphere(self.norms[d]).lift(x) @ self.centres[d].T
        cell = s.argmax(axis=1)
        return cell.astype(np.int32), angle(s[np.arange(len(x)), cell])

    def route(self, d: int, q: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> tuple[list[list[int]], np.ndarray]:
        """Per anchor the cells that may hold scores from ``low`` to ``high``, and the most
        promising one of the window from ``start`` on (it does not move as ``low`` rises)."""
        cells, radius = self.radius.get(d, (np.zeros(0, np.int32), np.zeros(0)))
        if not len(cells):
            return [[] for _ in q], np.full(len(q), -1)
        if d in self.centres:
            least, most = bounds(q, self.centres[d][cells], radius, self.norms[d])
        else:
            least, most = np.full((len(q), 1), -np.inf), np.full((len(q), 1), np.inf)
        on = (most >= low[:, None]) & (least <= high[:, None])
        reach = np.where((most >= start[:, None]) & (least <= high[:, None]), np.minimum(most, high[:, None]), -np.inf)
        return [cells[r].tolist() for r in on], np.where(reach.max(axis=1) > -np.inf, cells[reach.argmax(axis=1)], -1)


def _fit(rows: DataFrame) -> Cells:
    spark = rows.sparkSession

    def norms(batches):
        held: dict[int, list] = {}
        for b in batches:
            for d, part in by_length(b, "v"):
                x = quantised(matrix(part.column("v")))
                s = held.setdefault(d, [0, 0.0])
                s[0] += len(x)
                s[1] = max(s[1], float(np.sqrt((x * x).sum(axis=1)).max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([s[0] for s in held.values()], pa.int64()),
                                          pa.array([s[1] for s in held.values()], pa.float64())], ["d", "n", "norm"])

    # A row per length.
    of = {r.d: (r.n, r.norm) for r in rows.mapInArrow(norms, "d int, n long, norm double").groupBy("d").agg(F.sum("n").alias("n"), F.max("norm").alias("norm")).collect()}
    cells = Cells({d: norm for d, (_, norm) in of.items()}, {})
    count, widest = sum(n for n, _ in of.values()), max(of, default=1)
    sample = hash_sample(rows.select("v"), ["v"], max(1, min(SAMPLE, SAMPLE_VALUES // max(1, widest))), count).toArrow()
    for batch in sample.combine_chunks().to_batches():
        for d, part in by_length(batch, "v"):
            n = int(min(MAX_CELLS, -(-of[d][0] // CELL_ROWS), -(-part.num_rows // 8)))
            if d and n > 1 and d not in cells.centres:
                x = Sphere(of[d][1]).lift(quantised(matrix(part.column("v"))))
                cells.centres[d] = x[farthest_first(x, n)[0]]
    return cells


def hard_negatives(df: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Scores are inner products of vectors whose components x became
    ``floor(256 * x)``. An anchor's positives are its best ``positives`` other
    rows of ``df`` with its label; per positive, ``rank`` numbers the best
    ``negatives`` rows of another label whose score lies between ``low`` and
    ``high`` hundredths of the positive's (none, if that is negative). Higher
    scores come first, ties by smaller id; all results are exact.

    Rows take part if id, label and vector are not NULL and every component is
    present and finite; zero vectors do (their scores are 0). Only vectors of
    the same length are compared. ``anchors`` holds the columns of ``df``;
    repeated anchors (same id, label and vector) are answered once. An anchor
    is left out once of its own positives if ``df`` holds it; rows that merely
    share its id are rows like any other, and repeated rows each count.
    Inner products beyond 64 bits are clipped there. Other columns are ignored.
    """
    spark = df.sparkSession

    def valid(t: DataFrame) -> DataFrame:
        return t.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(F.col(vec_col))) \
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("v"))

    rows, asked = valid(df), valid(anchors)
    kind = df.schema[vec_col].dataType.simpleString()
    cells = _fit(rows)

    def assign(batches):
        for b in batches:
            for d, part in by_length(b, "v"):
                cell, far = cells.assign(d, quantised(matrix(part.column("v"))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(cell), d, np.int32)), pa.array(cell), pa.array(far)],
                                                 ["id", "label", "v", "d", "cell", "far"])

    placed = cut(rows.mapInArrow(assign, f"id long, label long, v {kind}, d int, cell int, far double"))
    block = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_VALUES) / F.greatest("d", F.lit(1))))
    summary = placed.groupBy("d", "cell").agg(F.count("*").alias("n"), F.max("far").alias("far")) \
        .select("d", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"), "far")
    summary = cut(summary)
    of: dict[int, list] = {}
    for r in summary.collect():  # a row per cell: at most MAX_CELLS per length
        of.setdefault(r.d, []).append((r.cell, r.far))
    cells.radius = {d: (np.array([c for c, _ in v], np.int32), np.array([f for _, f in v])) for d, v in of.items()}
    shared = spark.sparkContext.broadcast((cells.norms, cells.centres, cells.radius))  # bounded: cells and lengths
    sizes = summary.select("d", "cell", "blocks")
    dealt = placed.join(sizes, ["d", "cell"]).withColumn("block", F.pmod(F.xxhash64("id", "label"), F.col("blocks").cast("long")).cast("int"))

    def best(asks: DataFrame, k: int, same: bool) -> DataFrame:
        """``asks(id, h, p, label, v, low, high)``: ``(id, h, p, row, score, rank)``, the ``k`` best rows of each."""
        nth = Window.partitionBy("id", "h", "p").orderBy(F.desc("score"), "row")

        def visits(a: DataFrame, rest: bool) -> DataFrame:
            def run(batches):
                for b in batches:
                    for d, part in by_length(b, "v"):
                        lows, highs, starts = (part.column(c).to_numpy() for c in ("low", "high", "start"))
                        on, first = Cells(*shared.value).route(d, quantised(matrix(part.column("v"))), lows, highs, starts)
                        to = [[c for c in r if c != f] for r, f in zip(on, first.tolist())] if rest else [[f] if f >= 0 else [] for f in first.tolist()]
                        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "h", "p", "label", "v", "low", "high")),
                                                          pa.array(np.full(part.num_rows, d, np.int32)), pa.array(to, pa.list_(pa.int32()))],
                                                         ["id", "h", "p", "label", "v", "low", "high", "d", "cells"])
            return a.select("id", "h", "p", "label", "v", "low", "high", "start") \
                .mapInArrow(run, f"id long, h long, p long, label long, v {kind}, low long, high long, d int, cells array<int>") \
                .withColumn("cell", F.explode("cells")).drop("cells")

        def scanned(a: DataFrame) -> DataFrame:
            chunk = F.greatest(F.lit(1), F.floor(F.lit(ASK_VALUES) / F.greatest("d", F.lit(1))))
            per = a.groupBy("d", "cell").agg(F.count("*").alias("n")).select("d", "cell", F.ceil(F.col("n") / chunk).cast("int").alias("parts"))
            per = cut(per)
            left = a.join(per, ["d", "cell"]).join(sizes, ["d", "cell"]) \
                .withColumn("part", F.pmod(F.xxhash64("id", "h", "p"), F.col("parts").cast("long")).cast("int")) \
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            right = dealt.join(per, ["d", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

            def run(x: pa.Table, y: pa.Table) -> pa.Table:
                z = np.zeros(0, np.int64)
                who, at, score = z, z, z
                if x.num_rows and y.num_rows:
                    who, at, score = search_block(
                        quantised(matrix(x.column("v"))), x.column("low").to_numpy(), x.column("high").to_numpy(), x.column("label").to_numpy(),
                        k, same, quantised(matrix(y.column("v"))), y.column("id").to_numpy(), y.column("label").to_numpy())
                return pa.table([*(x.column(c).take(pa.array(who)) for c in ("id", "h", "p")), y.column("id").take(pa.array(at)), pa.array(score)],
                                names=["id", "h", "p", "row", "score"])

            key = ["d", "cell", "block", "part"]
            return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "id long, h long, p long, row long, score long")

        asks = asks.withColumn("start", F.col("low"))
        first = cut(scanned(cut(visits(asks, False))))
        bound = first.withColumn("n", F.row_number().over(nth)).where(F.col("n") == k).select("id", "h", "p", F.col("score").alias("__low"))
        again = asks.join(bound, ["id", "h", "p"], "left").withColumn("low", F.greatest("low", "__low")).drop("__low")
        found = first.unionByName(scanned(cut(visits(again, True))))
        return found.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") <= k)

    named = cut(asked.withColumn("h", F.xxhash64("label", "v")).dropDuplicates(["id", "h"]))
    whole = named.select("id", "h", F.lit(0).cast("long").alias("p"), "label", "v", F.lit(LEAST).cast("long").alias("low"), F.lit(MOST).cast("long").alias("high"))
    # The anchor itself is among its rows: one more is fetched, and one row of its id and score goes.
    near = best(whole, positives + 1, True)
    squared = F.aggregate(F.transform("v", lambda x: F.floor(x.cast("double") * SCALE).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"),
                          lambda s, x: F.coalesce(F.try_add(s, F.try_multiply(x, x)).cast("decimal(38,0)"), F.lit(MOST).cast("decimal(38,0)")))
    own = named.select("id", "h", F.least(squared, F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("self"))
    nth = Window.partitionBy("id", "h").orderBy("rank")
    near = near.join(own, ["id", "h"]).withColumn("is_self", (F.col("row") == F.col("id")) & (F.col("score") == F.col("self"))) \
        .withColumn("selves", F.sum(F.col("is_self").cast("int")).over(nth)) \
        .where(~F.col("is_self") | (F.col("selves") > 1)).withColumn("place", F.row_number().over(nth)).where(F.col("place") <= positives)
    near = cut(near.select("id", "h", F.col("row").alias("positive_id"), F.col("score").alias("positive_score")))
    share = lambda part, up: (F.ceil if up else F.floor)(F.col("positive_score").cast("decimal(20,0)") * part / F.lit(100)).cast("long")
    windows = near.where("positive_score >= 0").select("id", "h", F.col("positive_score").alias("p"), share(low, True).alias("low"), share(high, False).alias("high")).distinct() \
        .join(named, ["id", "h"]).select("id", "h", "p", "label", "v", "low", "high")
    hard = best(windows, negatives, False)
    return near.join(hard.withColumnRenamed("p", "positive_score"), ["id", "h", "positive_score"]) \
        .select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("row").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
