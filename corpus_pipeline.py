"""Corpus pipeline: quality rules, near-dedup, substring dedup, source mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``docs``. What a stage has written aside for itself is removed
when the next stage starts.

Defined cases: those of the operators. Rows with null ids pass the dedup
stages; rows that repeat an id are one document there, and one of them stays;
extra columns are carried along, whatever their names.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.bpe_encode import encode_documents
from demandspark.llm.common import noting_stashes, remove, stash, table
from demandspark.llm.mixing import mix_sources, mixed_documents
from demandspark.llm.near_dedup import near_duplicates
from demandspark.llm.quality import judged
from demandspark.llm.substring_dedup import cleaned_documents
from demandspark.llm.vocabularies import BYTE_BPE


_aside: dict[str, list[str]] = {}


def stage(function):
    """Removes what the application's last stage wrote aside, and notes what this one does."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        remove(spark, _aside.pop(application, ()))
        with noting_stashes() as noted:
            result = function(spark, docs, sf_dir)
        _aside[application] = noted
        return result

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and aren't outliers of their language and source."""
    kept = judged(docs, carry=tuple(docs.columns)).where("kept")
    return kept.select(*(F.col(f"carried_{c}").alias(c) for c in docs.columns))


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").cast("long").alias("_gone")).distinct()
    left = docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_again"))
    again = stash(again, "repeated-ids")
    if not again.head(1):
        return left
    same = F.col("doc_id") == F.col("_again")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), *docs.columns))
    once = left.join(again, same, "left_semi").withColumn("_n", first).where("_n = 1").drop("_n")
    return left.join(again, same, "left_anti").unionByName(once)


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; documents left without words go."""
    clean = cleaned_documents(docs)
    clean = clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean
    return clean.where(F.rlike(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]"))).select(*docs.columns)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: per round through a source, each document with the words that the round takes."""
    mixed = mixed_documents(docs, mix_sources(docs))
    return mixed.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else mixed


@stage
def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each text's ids and of the text decoded from them."""
    return encode_documents(docs, BYTE_BPE, remember=100_000)  # workers have served the other stages before


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("source mix", source_mix),
    ("bpe encoding", bpe_encoding),
]

#: SQL can state neither the outlier estimates nor the draws of the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stash(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
