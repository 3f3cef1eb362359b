"""A corpus made ready for training: four stages, each written and read again by the next.

A row is a document of its own: doc_ids may be NULL or repeat, and any column may be NULL. Line dedup
takes rows of one doc_id as one document and rows without one as the last; the other stages go by the
row. Columns besides those of ``DOCUMENTS`` are dropped. Without documents nothing comes out.

Whole texts go to the Python workers and back in every stage, so the bytes of a batch are bounded, not
only its rows. A session that has set ``BATCH_SETTING`` itself keeps its own bound.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import jaccard, line_dedup, packing, toxicity
from trolley.llm.common import stored, table

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    """``stage`` with batches of about ``BATCH_BYTES``. The setting stays, since what a stage returns is run
    by whoever reads it."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones, does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where("predicted = 0").select(*DOCUMENTS)


@small_batches
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; one that is left with no text stays, as an
    empty document."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENTS)


@small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: of those with the smallest doc_id (rows without one come
    last) the one with the smallest hash of its text. Rows without words are in no group and stay; of
    rows that are equal in doc_id and text one is as good as the other, and one stays."""
    found = stored(jaccard.near_duplicates(docs, keys=True), "found")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min(row).alias("first"))
    rows = found.join(first, "component").groupBy("doc_id", "text_key")
    rows = stored(rows.agg(F.first(row == F.col("first")).alias("stays"), (F.count(F.lit(1)) > 1).alias("many")), "rows")
    own = docs.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("text_key"))
    named = rows.withColumnRenamed("doc_id", "_id")
    single = own.join(named.where("many OR NOT stays"), same, "left_anti")
    repeated = own.join(named.where("many AND stays"), same, "left_semi").dropDuplicates(["doc_id", "_key"])
    return single.unionByName(repeated).select(*DOCUMENTS)


@small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("packing", pack),
]
#: Scores of a fitted model, and tokens, are beyond SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENTS)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
