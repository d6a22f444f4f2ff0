"""A corpus pipeline over ``documents``: five stages, each one of the text operators.

Every stage takes all that the stage before kept and returns it with its decisions applied; what a stage keeps is
written as Parquet and read again.  All stages but the last return the columns of ``documents``, with ``n_chars``
following the text.  Rows that hold no decision against them pass, whatever their other columns contain: null texts
leave at language identification, which rejects texts without a language; null and repeated keys pass the join of
similar documents, and of rows with one key that stay there the one with the least text hash is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflight.llm import bpe_automaton, decontaminate, language_id, parity_join, suffix_dedup
from shelflight.llm.common import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled rows that are not held out."""
    profiles = language_id.learn(docs, ~language_id.held_out(F.col("doc_id")))
    return language_id.identify(docs, profiles).where(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least key of each group of linked documents."""
    groups = parity_join.join(docs)[1]
    later = groups.where("node <> component").select(F.col("node").alias("__node"))
    kept = docs.join(later, F.col("doc_id").cast("bigint") == later["__node"], "left_anti")
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    again = repeated.withColumnRenamed("doc_id", "__again")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    ours = kept.join(again, kept["doc_id"] == again["__again"], "left_semi").withColumn("__place", F.row_number().over(order))
    once = ours.where("__place = 1").select(*docs.columns)
    return kept.join(again, kept["doc_id"] == again["__again"], "left_anti").select(*docs.columns).unionByName(once)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; one that is cut whole stays with an empty text."""
    left = suffix_dedup.cut(docs)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    marked = decontaminate.mark(docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c != "text"}),
                                table(spark, sf_dir, "benchmark"))
    return marked.where(~F.col("contaminated")).select(*(F.col("text") if c == "text" else F.col(f"`__own_{c}`").alias(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and token ids of every document."""
    ids = bpe_automaton.encode(docs)
    return ids.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids")


STAGES = [
    ("language", identify_language),
    ("similar", drop_similar),
    ("repeats", cut_repeats),
    ("benchmark", decontaminate_documents),
    ("tokens", encode),
]

#: Language profiles, suffix spans and merges cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
