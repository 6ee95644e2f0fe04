"""The corpus pipeline: toxicity, quality, near-duplicates, packing; part of the llm package."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.llm.common import scratch, table, written
from terraloom.llm.packing import pack
from terraloom.llm.quality_model import fit_quality
from terraloom.llm.simhash import simhash_groups
from terraloom.llm.toxicity import fit_toxicity, keep_unflagged

#: The stages fit models, hash with XXH64 and encode by a vocabulary, which SQL can't express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the span tagger scores below 0.3."""
    return keep_unflagged(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), 0.3, flagged_high=True)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality model scores 0.3 or more."""
    return keep_unflagged(docs, fit_quality(docs, table(spark, sf_dir, "labels")), 0.3, flagged_high=False)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Of several rows with one id, that whose columns, the text first, come first in order is kept
    (null texts last); rows without an id are kept.
    """
    groups = simhash_groups(docs).filter(F.col("doc_id") == F.col("component_id"))
    # joined by a shuffle at every size: the ids grow with the documents
    kept = written(groups.groupBy("doc_id").agg(F.count("*").alias("rows")), "kept-ids").hint("merge")
    once = docs.join(kept.filter("rows = 1"), "doc_id", "left_semi").select(docs.columns)
    first = F.struct(F.col("text").isNull(), "text", *(c for c in docs.columns if c not in ("doc_id", "text")))
    more = docs.join(kept.filter("rows > 1"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(first).alias("first"))
    chosen = more.select("doc_id", "first.*").select(docs.columns)
    return once.unionByName(chosen).unionByName(docs.filter(F.col("doc_id").isNull()))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("quality_classifier", drop_poor), ("simhash_dedup", drop_copies), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
