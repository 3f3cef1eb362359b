"""Registered queries, one per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import (
    alignment,
    centroids,
    chat,
    fingerprints,
    jaccard,
    licenses,
    line_dedup,
    neighbours,
    packing,
    quality_rules,
    sentencepieces,
    sharding,
    toxicity,
)
from trolley.llm.common import table

#: A conversation whose texts look like marks.
TRICKY = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(turns.unionByName(own)))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.digests(table(spark, sf_dir, "documents"), model, ["doc_id"])


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The documents lie in directories by source, language and hundreds of ids; the first of each is its
#: licence file.
FOLDER = 100


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.col("doc_id")
    name = F.when(doc_id % FOLDER == 0, "LICENSE").otherwise(F.concat(doc_id.cast("string"), F.lit(".txt")))
    where = [F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.floor(doc_id / FOLDER).cast("string"), name]
    files = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", *where).alias("path"))
    return licenses.scan(files, key="doc_id", order="doc_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows = toxicity.scored(docs, model)
    return rows.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.clustered(table(spark, sf_dir, "embeddings")))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judged(quality_rules.measured(table(spark, sf_dir, "documents"), ["doc_id"]))
    return rows.drop("n_covered_words", "longest_repeat")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_jaccard,
        op3_sentencepiece,
        op4_sharding,
        op5_fingerprints,
        op6_neighbours,
        op7_line_dedup,
        op8_licenses,
        op9_packing,
        op10_toxicity,
        op11_centroids,
        op12_quality_rules,
        op13_alignment,
    )
}
