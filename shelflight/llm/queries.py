"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight.llm import (bpe_automaton, decontaminate, filter_audit, hamming_search, language_id, main_text, packing, parity_join, shards, sql,
                            suffix_dedup, token_blocks, url_filter, vector_codes)
from shelflight.llm.common import new_path, table

Query = Callable[[SparkSession, str], DataFrame]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-blocks")
    token_blocks.write_blocks(table(spark, sf_dir, "documents"), folder)
    return token_blocks.read_blocks(spark, folder, digest=True).withColumnRenamed("key", "doc_id")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = language_id.held_out(F.col("doc_id"))
    profiles = language_id.learn(docs, ~kept)
    return (language_id.identify(docs.select("doc_id", "text"), profiles)
            .select("doc_id", kept.alias("held_out"), "lang_pred", "score"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.search(rows, rows.where("id % 20 = 0")).withColumnRenamed("id", "vec_id")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
            .select("page_id", "host", "path", "rule", "verdict", "mined"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.digests(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similar_groups(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), new_path(spark, "shards")
    shards.write_shards(docs, folder)
    return shards.read_shards(docs, folder).select("doc_id", "shard", "n_bytes", "shard_bytes", "shard_rows")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), digest=True)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_token_blocks": op1,
    "op2_suffix_dedup": op2,
    "op3_language_id": op3,
    "op4_main_text": op4,
    "op5_hamming_search": op5,
    "op6_url_filter": op6,
    "op7_bpe_automaton": op7,
    "op8_parity_join": op8,
    "op9_decontaminate": op9,
    "op10_shards": op10,
    "op11_vector_codes": op11,
    "op12_packing": op12,
    "op13_filter_audit": op13,
}

SQL: dict[str, str] = {
    "op2_suffix_dedup": sql.SUFFIX_DEDUP,
    "op5_hamming_search": sql.HAMMING_SEARCH,
    "op8_parity_join": sql.PARITY_JOIN,
    "op9_decontaminate": sql.DECONTAMINATE,
    "op11_vector_codes": sql.VECTOR_CODES,
    "op13_filter_audit": sql.FILTER_AUDIT,
}
