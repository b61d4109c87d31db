"""The corpus pipeline: five stages over `documents`, each read from the one before.

1. toxicity: documents that the classifier scores at the threshold or above go.
2. SimHash near-dedup: one document of each group stays.
3. secret scans: what is found is blacked out in the text; the document stays.
4. mixing: sources are taken to their target weights (documents repeat, one
   per source is cut at the budget).
5. best-fit packing: the mix as pieces in bins, by tokens.

Every stage works on all rows of the one before. All but the last return the
columns of `documents`; where a text changes, `n_chars` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.llm import mixing, packing, secret_scan, simhash, toxicity
from roadwatch.llm.common import scratch, table


def _recounted(out: DataFrame, like: DataFrame) -> DataFrame:
    if "n_chars" in like.columns:
        out = out.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return out.select(*like.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the threshold. The model learns from the labelled
    rows of `docs` that may be learned from; without labels of both classes all rows stay."""
    model = toxicity.train(docs, toxicity.training_rows(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model, name="__score").where(F.col("__score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: that of smallest id (NULL last), then of smallest text hash."""
    return simhash.drop_near_copies(docs, shingle=3, radius=3).select(*docs.columns)


def black_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; each secret in a text becomes its kind in brackets."""
    return _recounted(secret_scan.with_secrets(docs, redact=True), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, cut at the budget; rows without words are not taken."""
    return _recounted(mixing.materialise(mixing.mix(docs)), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: its document, words (`size`), tokens (`n_tokens`), bin, place in the
    bin and the bin's length. Bins are filled by tokens: `start`, `offset` and `length` count them."""
    return packing.pack_tokens(docs).withColumnsRenamed({"size": "n_tokens", "words": "size"})


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", black_out_secrets),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A trained classifier and best-fit packing are beyond SQL; tests/llm hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply :data:`STAGES` to `documents`; every result but the last is written to the
    shared folder as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{folder}/{k}-{name}")
            out = spark.read.parquet(f"{folder}/{k}-{name}")
        docs = out
    return docs
