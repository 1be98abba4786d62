"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.llm import align, ann, bpe, chat, counts, langid, licenses, packing, quality, repair, search, simhash, urls
from clickspark.llm.oracles import ORACLE_SQL
from clickspark.sources import read_table

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *quality.BASE, "line_total", "line_removed", "base_failed", "kept")


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    asked = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search.search(docs, asked)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out_of = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~out_of & F.col("doc_id").isNotNull()))
    return langid.predict(docs, model).select("doc_id", out_of.alias("held_out"), "lang_pred", "score")


def op7_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the URLs of pages whose id is labelled toxic."""
    pages = read_table(spark, sf_dir, "pages")
    toxic = read_table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id"))
    listed = pages.join(toxic, "page_id", "left_semi").select("url")
    return urls.judge_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict", "listed")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.conversation_digests(rows)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN).documents


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(repair.damage(read_table(spark, sf_dir, "conversations")))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_quality_rules, op3_simhash_groups, op4_topk_search, op5_byte_bpe,
                            op6_language_id, op7_cost_packing, op8_url_filter, op9_token_counts, op10_chat_format,
                            op11_token_alignment, op12_structure_repair, op13_nearest_neighbours)}
