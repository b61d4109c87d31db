"""The registered queries of the numbered operators: thin digests of their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.llm import (
    ann, embed_dedup, hard_negatives, mixing, packing, repeats, secret_scan, sharding, simhash, token_counts, token_output, toxicity, whitening,
)
from roadwatch.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.with_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.array(*[F.lit(r.kind) for r in secret_scan.BASE_RULES])
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: F.array_contains(base, s["kind"]))), 256).alias("base_sha256"),
        joined("spans").alias("spans"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_files(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.training_rows(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents")).drop("name")


#: The shards of op10: fixed names, equal weights.
SHARDS = [f"shard-{i:03d}" for i in range(256)]


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The operator's exact deviation is a decimal; beyond a long it is NULL here.
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]))
    return repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_ann": op2_ann,
    "op3_simhash": op3_simhash,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_token_output": op5_token_output,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_sharding": op10_sharding,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_substring_dedup": op13_substring_dedup,
}
