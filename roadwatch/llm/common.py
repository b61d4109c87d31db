"""Shared helpers: table reading, lineage cuts, word counts, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.session import checkpoint_root

#: A word: a maximal run of anything but space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    A reliable checkpoint: a lost executor costs a re-read, not a recomputation.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new sub-folder (not yet created) of the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hash_sample(df: DataFrame, cols: list[str], n: int, count: int) -> DataFrame:
    """The ``n`` rows of lowest hash of ``cols`` (all, if ``count`` is not more).

    Rows are first cut at a hash below which about twice as many are expected,
    so that the final ordering sees a few thousand rows however many
    partitions there are.
    """
    h = F.xxhash64(*cols)
    if count > 4 * n + 1000:
        df = df.where(F.pmod(h, F.lit(1 << 40)) < F.lit(int((1 << 40) * (2 * n + 500) / count)))
    return df.orderBy(F.pmod(h, F.lit(1 << 40)), *cols).limit(n)


def slices(batches, rows: int = 256):
    """Arrow batches cut into slices of at most ``rows`` rows, so that a task holds the
    Python objects of a few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def word_count(text: Column) -> Column:
    """Number of words in ``text`` (NULL: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` of longs.

    Returns ``(node, root)``, root the smallest node reachable; nodes without
    an edge to another node are absent. Alternates large-star and small-star
    steps: every neighbour moves to the smallest member of its star until
    nothing changes (logarithmically many rounds). Each step is a map-side
    combined minimum and one join, so a node with very many neighbours is
    never gathered anywhere; rounds are checkpointed. Empty input gives an
    empty result; NULL ends, loops and repeated edges are ignored.
    """
    def canon(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def star(both: DataFrame, keep: str) -> DataFrame:
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.where(keep).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    cur = cut(canon(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))))
    before = state(cur)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = cut(canon(star(both, "b > a")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.select("a", F.col("m").alias("b")))
        cur = cut(canon(small))
        after = state(cur)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components: no fixed point; raise max_rounds")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
