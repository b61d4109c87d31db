"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh, 2016).

Fingerprints are 64-bit SimHashes of word shingles. For radius ``r`` every bit
position gets a non-zero label of ``r + 1`` bits, and each of the
``2**(r+1) - 1`` non-zero vectors ``v`` is one table whose mask keeps the
positions whose label has odd inner product with ``v``. The labels of any
``r`` positions span at most ``r`` dimensions, so some ``v`` is orthogonal to
all of them: two fingerprints within ``r`` bits agree on that table's mask.
No pair is lost, and every candidate is verified by its bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.llm.common import components, cut, slices

BITS = 64
SEED = 42
#: Shingles hashed at a time: bounds the memory of one very long text.
CHUNK = 1 << 16
#: Larger buckets are split further (exactly) before they are compared.
BUCKET_LIMIT = 4096
#: Free bits per block in that second split.
BLOCK_BITS = 5


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The ``2**(radius+1) - 1`` table masks (see the module docstring)."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((1 + i % n) & v).bit_count() & 1) for v in range(1, n + 1)]


def second_masks(mask: int, radius: int) -> list[int]:
    """For fingerprints that agree on ``mask``: masks of the other bits, in blocks of
    which all but ``radius`` are kept, so that every pair within ``radius`` agrees on one."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    blocks = [free[i:i + BLOCK_BITS] for i in range(0, len(free), BLOCK_BITS)]
    return [_signed(sum(1 << i for j, block in enumerate(blocks) if j not in drop for i in block))
            for drop in combinations(range(len(blocks)), min(radius, len(blocks)))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(words: list[bytes], k: int) -> Iterator[np.ndarray]:
    """XXH64 of each k-word shingle, in chunks (fewer words: one, the whole sequence)."""
    text, n = b" ".join(words), max(1, len(words) - k + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(k, len(words)) - 1:].tolist()
    h = xxhash.xxh64_intdigest
    for i in range(0, n, CHUNK):
        yield np.array([h(text[s:e], SEED) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], np.uint64)


def fingerprints(texts: list[bytes | None], k: int) -> np.ndarray:
    """SimHash of each text as unsigned 64-bit integers; texts without words give 0."""
    ones, n = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    parts: list[np.ndarray] = []
    owner: list[int] = []

    def flush() -> None:
        bits = np.unpackbits(np.concatenate(parts).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = 0
        for i, part in zip(owner, parts):
            ones[i] += bits[at:at + len(part)].sum(axis=0, dtype=np.int32)
            at += len(part)
        parts.clear(), owner.clear()

    held = 0
    for i, t in enumerate(texts):
        words = t.lower().split() if t else []
        if words:
            for h in shingle_hashes(words, k):
                parts.append(h)
                owner.append(i)
                n[i] += len(h)
                held += len(h)
                if held >= CHUNK:
                    flush()
                    held = 0
    if parts:
        flush()
    set_bits = (2 * ones > n[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, text_hash: bool = False) -> DataFrame:
    """``(id_col, fp)``: one row per document, ``fp`` the SimHash as a signed long
    (with ``text_hash`` also ``th``, a hash of the text)."""
    def run(batches):
        for b in slices(batches):
            fp = fingerprints(b.column(1).cast(pa.binary()).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], [id_col, "fp", *extra])

    kind, extra = docs.schema[id_col].dataType.simpleString(), ["th"] if text_hash else []
    return docs.select(id_col, text_col, *([F.xxhash64(text_col).alias("th")] if text_hash else [])) \
        .mapInArrow(run, f"`{id_col}` {kind}, fp long" + ", th long" * text_hash)


def _stars(radius: int):
    """Per bucket: members joined to a root of their connected part, found by growing
    parts from a frontier; each member is compared once with those not yet reached."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        left = np.unique(t.column("fp").to_numpy())
        a, b = [], []
        while len(left) > 1:
            root, left = left[0], left[1:]
            front = np.array([root])
            while len(front) and len(left):
                now, front = front[:256], front[256:]
                near = (np.bitwise_count((now[:, None] ^ left[None, :]).view(np.uint64)) <= radius).any(axis=0)
                if near.any():
                    new, left = left[near], left[~near]
                    a.append(new)
                    b.append(np.full(len(new), root))
                    front = np.concatenate([front, new])
        z = np.zeros(0, np.int64)
        return pa.table([np.concatenate([z, *a]), np.concatenate([z, *b])], schema=schema)
    return run


def link_edges(fps: DataFrame, radius: int) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fps(fp)`` that connect
    exactly what pairs within ``radius`` bits connect.

    Buckets of two are verified in place; larger ones are grown into stars.
    A bucket over :data:`BUCKET_LIMIT` is first split by a second cover of its
    table's free bits (blocks of :data:`BLOCK_BITS`, all but ``radius`` blocks
    kept), whose parts hold at most ``2**(radius * BLOCK_BITS)`` values.
    """
    masks = covering_masks(radius)
    keys = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                               for t, m in enumerate(masks)]))
    rows = fps.select("fp", keys.alias("k")).select("fp", "k.t", "k.key")
    buckets = cut(rows.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                  .where("n > 1"))
    pairs = buckets.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")

    many = rows.join(buckets.where("n > 2").select("t", "key", "n"), ["t", "key"])
    subs = fps.sparkSession.createDataFrame(
        [(t, s, m) for t, mask in enumerate(masks) for s, m in enumerate(second_masks(mask, radius))], "t int, s int, m long")
    small = many.where(F.col("n") <= BUCKET_LIMIT).select("fp", "t", "key", F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sk"))
    large = many.where(F.col("n") > BUCKET_LIMIT).join(F.broadcast(subs), "t") \
        .select("fp", "t", "key", "s", F.col("fp").bitwiseAND(F.col("m")).alias("sk"))
    grouped = small.unionByName(large)
    stars = grouped.groupBy("t", "key", "s", "sk").applyInArrow(_stars(radius), "a long, b long")
    return pairs.unionByName(stars).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, radius: int = 3) -> DataFrame:
    """``(id_col, fp, component_id)``: one row per input row; documents whose
    fingerprints differ in at most ``radius`` bits are linked, and
    ``component_id`` is the smallest id reachable.

    Equal fingerprints are collapsed (map-side combined) before anything is
    compared, so groups of exact copies of any size cost one row. NULL and
    empty texts have fingerprint 0 and link like any other. Rows with a NULL
    id belong to their component but never name it (NULL if no member has an
    id). Repeated rows are returned as often as they come in; other columns
    are ignored.
    """
    fp = cut(with_fingerprint(docs, id_col, text_col, shingle))
    distinct = fp.groupBy("fp").agg(F.min(id_col).alias("low"))
    roots = components(link_edges(distinct.select("fp"), radius))
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = member.groupBy("root").agg(F.min("low").alias("component_id"))
    names = member.join(low, "root").select("fp", "component_id")
    return fp.join(names, "fp").select(id_col, "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Of equal ids the text of smaller hash stays; ids come before NULL. Exactly
    one row stays per group, whatever repeats: different texts under one id, in
    different groups, both stay, and equal texts without ids are one group. Of
    rows equal in id and text the one of smallest hash over all columns stays.
    """
    fp = cut(with_fingerprint(docs, id_col, text_col, shingle, text_hash=True))
    ident = F.col(id_col)
    distinct = fp.groupBy("fp").agg(F.min(F.struct(ident.isNull().alias("none"), ident.alias("id"), "th")).alias("low"))
    roots = components(link_edges(distinct.select("fp"), radius))
    low = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("low").alias("low")) \
        .select(F.col("low.id").alias("__id"), F.col("low.th").alias("__th"))
    rows = docs.withColumn("__h", F.xxhash64(text_col))
    kept = rows.join(low, ident.eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left_semi")
    # Map-side combined, so that many equal rows are no task's burden.
    one = kept.groupBy(ident.alias("__id"), "__h").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row"))
    return one.select("__row.*")
