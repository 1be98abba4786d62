"""Corpus pipeline: quality rules, language ID, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage but
the last returns the columns of its input. The result of a stage is written as
Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.llm import langid, packing, quality, simhash
from clickspark.session import scratch_path
from clickspark.sources import read_table

#: A document whose best language holds less of its trigrams is rejected.
MIN_SCORE = 0.3

#: Tokenizing and trigram models have no SQL form: tested against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, lines judged alike at every host
    size. Rejected rows are named by id, host and text hash, so repeated ids are
    judged row by row."""
    rejected = (quality.quality_rules(docs, min_docs=quality.MIN_DOCS).where(~F.col("kept"))
                .select(F.col("doc_id").alias("r_id"), F.col("source").alias("r_source"), "text_hash").distinct())
    same = (F.col("doc_id").eqNullSafe(F.col("r_id")) & F.col("source").eqNullSafe(F.col("r_source"))
            & (quality.text_hash(F.col("text")) == F.col("text_hash")))
    return docs.join(rejected, same, "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows. It learns from the labelled
    rows of the stage's own input, held-out rows excepted."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    named = langid.annotate(docs, model, prediction="_lang_pred", score="_lang_score")
    return (named.where((F.col("_lang_pred") != langid.UNKNOWN) & (F.col("_lang_score") >= MIN_SCORE))
            .select(*docs.columns))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    standing = (simhash.simhash_groups(docs).where("stands")
                .select(F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash")))
    same = F.col("doc_id").eqNullSafe(F.col("s_id")) & (quality.text_hash(F.col("text")) == F.col("s_hash"))
    once = standing.distinct()
    kept = docs.join(once, same, "left_semi")
    if standing.count() > once.count():         # identical rows: one of them stays
        kept = (kept.withColumn("_hash", quality.text_hash(F.col("text")))
                .dropDuplicates(["doc_id", "_hash"]))
    return kept.select(*docs.columns)


def cost_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("language_id", language_id),
          ("simhash_dedup", simhash_dedup), ("cost_packing", cost_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the pieces of the packed sequences."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
