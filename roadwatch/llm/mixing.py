"""Mixing sources to target weights.

Every document gets a hash-random key. Each source is sorted by key through
key ranges (``(source, range)`` is the unit of work, so a hot source spreads
over as many tasks as any other data of its size); word totals of the ranges
give distributed prefix sums, and the source is cut at its exact budget, full
passes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadwatch.llm.common import cut, word_count

#: Weights of the sources in code-point order (NULL last), repeating.
WEIGHTS = (3, 1, 2)
#: Leading hex digits of the key that name a range: 16**3 ranges per source.
RANGE_DIGITS = 3
#: Rows without an id share one key; their ranges are by size and this many shares of the text hash.
NULL_SHARES = 256


def source_targets(totals: DataFrame, weights=WEIGHTS, share=1.5, most=2) -> DataFrame:
    """``totals(source, source_size, ...)`` with each source's ``target`` (double).

    Sources share ``share`` times all sizes by weight; none gets more than
    ``most`` times its size, and the excess is shared again by weight until
    none is above (water filling: sources reach their cap in order of cap per
    weight). One row per source passes through this step.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = totals.withColumn("w", pick.cast("long")).withColumn("cap", F.col("source_size") * most)
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("left", F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        .withColumn("wleft", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    # Capped while the cap is at most the level reached by what is left.
    t = t.withColumn("open", F.col("cap") * F.col("wleft") > F.col("left") * F.col("w"))
    first = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    t = t.withColumn("opened", F.max("open").over(first))
    level = [F.first(F.when(F.col("open"), F.col(c)), ignorenulls=True).over(
        first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for c in ("left", "wleft")]
    return t.withColumn("_l", level[0]).withColumn("_w", level[1]).select(
        *totals.columns,
        F.when(F.col("opened"), F.col("w") * F.col("_l") / F.col("_w")).otherwise(F.col("cap")).cast("double").alias("target"))


def _range(key: Column, id_: Column, size: Column, text_hash: Column) -> Column:
    """The range of a row: leading digits of the key, and for rows without an id, which
    share one key, size and leading bits of the text hash. Ranges are ordered as rows
    are: by key, id (NULL first), size and text hash."""
    shared = F.md5(F.lit(""))
    null = id_.isNull()
    return F.struct(
        F.conv(F.substring(key, 1, RANGE_DIGITS), 16, 10).cast("int").alias("key"),
        F.when(null, 1).when(key < shared, 0).otherwise(2).alias("side"),
        F.when(null, size).otherwise(0).cast("long").alias("size"),
        F.when(null, F.floor(text_hash / F.lit(2.0 ** 64 / NULL_SHARES))).otherwise(0).cast("int").alias("share"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share=1.5, most=2) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` (columns of
    those names in ``docs`` are replaced).

    ``taken`` is the number of words the mix takes from the row: ``floor(target
    / source_size)`` full passes and then, in key order, rows until exactly
    ``floor(target)`` words are taken; the row at the cut gives its first
    words. Keys are md5 of the id, ties by id, size and text hash, so reruns
    agree. NULL texts have size 0; a NULL source is a source of its own; a
    source without words has target 0. Repeated rows are rows of their own. Rows
    without an id are spread over ranges of size and text hash.
    """
    plain = docs.drop("size", "source_size", "target", "taken")
    keyed = plain.withColumn("size", word_count(F.col(text_col))) \
        .withColumn("__key", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))) \
        .withColumn("__s", F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")))  \
        .withColumn("__h", F.xxhash64(text_col)) \
        .withColumn("__r", _range(F.col("__key"), F.col(id_col), F.col("size"), F.col("__h")))
    tot = cut(keyed.groupBy("__s", F.col(source_col).alias("source"), "__r").agg(F.sum("size").alias("__sum")))
    sizes = tot.groupBy("__s", "source").agg(F.sum("__sum").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    prior = Window.partitionBy("__s").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = tot.select("__s", "__r", F.coalesce(F.sum("__sum").over(prior), F.lit(0)).alias("__prior")) \
        .join(targets.select("__s", "source_size", "target"), "__s")
    in_order = Window.partitionBy("__s", "__r").orderBy("__key", id_col, "size", "__h") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.join(ranges, ["__s", "__r"])
    ahead = F.col("__prior") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    passes = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(0)
    rest = F.floor("target") - passes * F.col("source_size")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - ahead))
    return rows.withColumn("taken", taken.cast("long")).select(*plain.columns, "size", "source_size", "target", "taken")


def materialise(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mixed corpus: each row as often as it is taken whole, then the words of
    a row cut at the budget (text up to the end of its last word taken)."""
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0))
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0))
    copies = F.explode(F.sequence(F.lit(1), (whole + F.when(part > 0, 1).otherwise(0)).cast("int")))
    rows = mixed.where("taken > 0").withColumn("__whole", whole).withColumn("__part", part).withColumn("__copy", copies)
    # The cut happens once per source, so an expression per row is enough.
    words = F.expr(f"array_join(slice(regexp_extract_all(`{text_col}`, '(?s)([\\\\x20\\\\x09-\\\\x0D]*[^\\\\x20\\\\x09-\\\\x0D]+)', 1), 1, cast(__part as int)), '')")
    return rows.withColumn(text_col, F.when(F.col("__copy") > F.col("__whole"), words).otherwise(F.col(text_col))) \
        .drop("__whole", "__part", "__copy", "size", "source_size", "target", "taken")
