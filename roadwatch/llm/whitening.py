"""Embedding whitening by spectrum slicing.

The covariance is summed by Spark (a few rows per task); its leading
eigenvalues are isolated by inertia counts: by Sylvester's law the signs of D
in the LDL^T factors of ``V - s*I`` tell how many eigenvalues lie above ``s``,
and bisection on ``s`` brackets each wanted one alone. Rayleigh quotient
iteration converges inside the bracket cubically, and counts just beside the
result certify its number. No eigenvector solver of a library takes part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.llm.vectors import by_length, finite, matrix

#: Fixed values of the contract: entries c become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries are clipped to this size first, so that sums of integers stay exact.
LIMIT = 2.0 ** 40
EPS = np.finfo(np.float64).eps


def above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``a`` greater than ``shift``: the
    positive ones of D in the LDL^T factors of ``a - shift*I`` (Bunch-Kaufman
    pivots of one or two rows). Exact up to a change of ``a`` by rounding."""
    m = a - shift * np.eye(len(a))
    n, k, count, alpha = len(m), 0, 0, (1 + 17 ** 0.5) / 8
    while k < n:
        pivot, two = k, False
        below = np.abs(m[k + 1:, k])
        if k < n - 1 and (top := below.max()) > 0 and abs(m[k, k]) < alpha * top:
            r = k + 1 + int(below.argmax())
            row = np.abs(m[r, k:])
            row[r - k] = 0
            if abs(m[k, k]) * row.max() < alpha * top * top:
                two = abs(m[r, r]) < alpha * row.max()
                pivot = r
        at = k + two
        if pivot not in (k, at):
            m[[at, pivot]] = m[[pivot, at]]
            m[:, [at, pivot]] = m[:, [pivot, at]]
        if two:
            e, c = m[k:k + 2, k:k + 2], m[k + 2:, k:k + 2]
            det = e[0, 0] * e[1, 1] - e[0, 1] * e[1, 0]
            count += 1 if det < 0 else 2 * (e[0, 0] + e[1, 1] > 0)
            m[k + 2:, k + 2:] -= c @ np.linalg.solve(e, c.T)
            k += 2
        else:
            p, c = m[k, k], m[k + 1:, k]
            count += p > 0
            if p != 0:
                m[k + 1:, k + 1:] -= np.outer(c / p, c)
            k += 1
    return int(count)


def leading(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a covariance, falling, and their unit
    eigenvectors as rows (fewer, if the others are zero to rounding). An
    eigenvector's entry of largest size is positive."""
    d = len(v)
    scale = np.abs(v).sum(axis=1).max(initial=0.0)
    if not scale:
        return np.zeros(0), np.zeros((0, d))
    v = v / scale
    margin = 16 * max(d, 8) * EPS
    seen = {-1.0: d, 1.0 + margin: 0}  # shifts and the eigenvalues above them

    def counted(s: float) -> int:
        if s not in seen:
            seen[s] = above(v, s)
        return seen[s]

    rng = np.random.default_rng(11)
    values, vectors = [], np.zeros((0, d))

    def free(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - vectors.T @ (vectors @ x)
        return x / np.linalg.norm(x)

    def solve(shift: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(v - shift * np.eye(d), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (shift + margin) * np.eye(d), x)
        return free(y / np.abs(y).max())

    for k in range(1, min(count, d) + 1):
        if counted(margin) < k:
            break
        lo = max(s for s, c in seen.items() if c >= k)
        hi = min(s for s, c in seen.items() if c < k)
        x = free(rng.standard_normal(d))
        while True:
            while counted(lo) - counted(hi) > 1 and hi - lo > margin:
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if counted(mid) >= k else (lo, mid)
            # Into the bracket by inverse iteration at its middle, then by Rayleigh quotients.
            for _ in range(3):
                x = solve((lo + hi) / 2, x)
            best = (np.inf, 0.0, x)
            for _ in range(30):
                rho = float(x @ (v @ x))
                left = float(np.linalg.norm(v @ x - rho * x))
                if left >= best[0] / 2:
                    break
                best = (left, rho, x)
                x = solve(rho, x)
            left, rho, x = best
            sure = max(4 * left, margin)
            if left < 1e-10 and counted(rho + sure) < k <= counted(rho - sure):
                break
            if hi - lo <= margin:
                raise ArithmeticError(f"eigenvalue {k} is not certified")
            mid = (lo + hi) / 2  # another eigenvalue was found: narrow the bracket
            lo, hi = (mid, hi) if counted(mid) >= k else (lo, mid)
        values.append(rho)
        vectors = np.vstack([vectors, x])
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]) if len(vectors) else np.zeros(0)
    return np.array(values) * scale, vectors * signs[:, None]


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """Entries as the contract's integers."""
    return np.floor(SCALE * np.clip(x, -LIMIT / SCALE, LIMIT / SCALE)).astype(np.int64) + OFFSET


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``n * x - total``, exactly (Python integers where 64 bits might not do)."""
    if n * int(np.abs(x).max(initial=0)) + int(max(map(abs, total.tolist()), default=0)) < 1 << 62:
        return n * x - total.astype(np.int64)
    return n * x.astype(object) - total


def squares(c: np.ndarray) -> pa.Array:
    """Row sums of squares as decimals, exactly; NULL beyond 38 digits."""
    most = int(np.abs(c).max(initial=0))
    if c.dtype != object and most * most * max(1, c.shape[1]) < 1 << 62:
        return pa.array((c * c).sum(axis=1)).cast(pa.decimal128(38, 0))
    from decimal import Context, Decimal
    wide = Context(prec=60)
    sums = [sum(e * e for e in row) for row in c.tolist()]
    return pa.array([wide.create_decimal(Decimal(s)) if s < 10 ** 38 else None for s in sums], pa.decimal128(38, 0))


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)``: for
    each row with a vector and each component its whitened coordinate.

    Vectors that are NULL or hold NULL or non-finite entries are dropped; all
    others, zero vectors and repeated rows included, are the fit list. An entry
    c becomes ``floor(1024 * c) + 100000`` (c is clipped to about 1e9 in size).
    ``deviation`` is the exact sum of ``(n * x - S)**2`` as decimal(38, 0), NULL
    beyond that. Vectors of different lengths have no common covariance: those
    of each length are fitted on their own, with their own ``n``. Components of
    eigenvalue zero (constant or too few vectors) cannot be whitened and are
    not returned, so a single vector, and a table whose vectors are all equal,
    give no rows. Rows without an id stay. Other columns are ignored.

    The driver holds one covariance per length (dimension squared); every pass
    over the vectors is a map and a sum.
    """
    spark = df.sparkSession
    rows = df.where(finite(F.col(vec_col))).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    # Partial sums are emitted per task: no more tasks than a few per core.
    few = rows.coalesce(max(1, 4 * spark.sparkContext.defaultParallelism))

    def sums(batches):
        held: dict[int, list] = {}
        for b in batches:
            for d, part in by_length(b, "v"):
                s = held.setdefault(d, [0, np.zeros(d, object)])
                s[0] += part.num_rows
                s[1] = s[1] + whole_numbers(matrix(part.column("v"))).sum(axis=0)
        for d, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()),
                                              pa.array([n, *s.tolist()], pa.int64())], ["d", "i", "s"])

    totals: dict[int, tuple[int, np.ndarray]] = {}
    # Bounded: a number per dimension and length.
    for d, pairs in few.mapInArrow(sums, "d int, i int, s long").groupBy("d", "i").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s")) \
            .groupBy("d").agg(F.sort_array(F.collect_list(F.struct("i", "s"))).alias("p")).collect():
        totals[d] = (int(pairs[0].s), np.array([int(p.s) for p in pairs[1:]], object))

    def products(of):
        """A map from vectors to partial sums of ``of(d, x)``'s outer products, in upper triangles."""
        def run(batches):
            held: dict[int, np.ndarray] = {}
            for b in batches:
                for d, part in by_length(b, "v"):
                    y = of(d, whole_numbers(matrix(part.column("v"))))
                    held[d] = held.get(d, 0) + y.T @ y
            for d, g in held.items():
                i, j = np.triu_indices(len(g))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                                                  pa.array(j.astype(np.int32)), pa.array(g[i, j])], ["d", "i", "j", "g"])
        out: dict[int, np.ndarray] = {}
        summed = few.mapInArrow(run, "d int, i int, j int, g double").groupBy("d", "i", "j").agg(F.sum("g").alias("g")).toArrow()
        for d in np.unique(summed.column("d").to_numpy()).tolist():
            at = summed.column("d").to_numpy() == d
            i, j, g = (summed.column(c).to_numpy()[at] for c in "ijg")
            m = out[d] = np.zeros((i.max() + 1,) * 2)
            m[i, j] = m[j, i] = g
        return out

    def deviations(d, x):
        n, total = totals[d]
        return (centred(x, n, total) / n).astype(np.float64)

    fits = {}
    for d, g in products(deviations).items():
        v = g / totals[d][0]
        values, vectors = leading(v, components)
        if len(values):
            fits[d] = (values, vectors / np.sqrt(values)[:, None], values / np.trace(v))

    def project(d, x):
        return deviations(d, x) @ fits[d][1].T if d in fits else np.zeros((0, 1))

    errors = {d: float(np.abs(g / totals[d][0] - np.eye(len(g))).max()) for d, g in products(project).items() if d in fits}
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for d, part in by_length(b, "v"):
                if d not in fits:
                    continue
                n, total = totals[d]
                k = len(fits[d][0])
                x = whole_numbers(matrix(part.column("v")))
                deviation = squares(centred(x, n, total))
                m = part.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     deviation.take(each), pa.array(project(d, x).ravel()), pa.array(np.tile(fits[d][2], m)), pa.array(np.full(m * k, errors[d]))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double") \
        .withColumnRenamed("id", id_col)
