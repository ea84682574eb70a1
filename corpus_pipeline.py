"""The corpus pipeline: quality, near duplicates, personal data, packing.

Each stage takes what the one before kept, written as Parquet and read again. All but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import ngram_join, packing, pii, quality
from wakeline.llm.common import settle, split_by_ids, table
from wakeline.llm.queries import QUALITY_CUT, held_out
from wakeline.session import checkpoint_dir, cut_lineage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It is fitted on the labels that are not held out; without
    labels of both kinds nothing is rejected for lack of evidence unless the base rate itself is below the cut."""
    settle(spark)
    model = quality.fit_labelled(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), "quality", ~held_out(F.col("id")))
    return docs.where(quality.score(F.col("text"), model) >= QUALITY_CUT)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five words, similarity 0.8 or more) the document with the smallest id.
    Documents without an id, and those without words, are in no group and stay."""
    groups = ngram_join.ngram_join(docs, words=5, part=(4, 5))
    gone = groups.where("component_id < doc_id").select("doc_id").distinct()
    gone = cut_lineage(gone)
    maybe, kept = split_by_ids(docs, "doc_id", gone)  # the text of most documents need not move
    return kept.unionByName(maybe.join(gone, "doc_id", "left_anti").select(*docs.columns))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by kind; n_chars is that of the new text."""
    settle(spark)
    return pii.mask(docs, pii.fit(docs)).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("bigint")).otherwise(F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each), ("personal_data", mask_personal_data), ("packing", pack_sequences)]

#: Hashing, the classifier and the field have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written to the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{name}")
            docs = spark.read.parquet(f"{base}/{name}")
    return docs
