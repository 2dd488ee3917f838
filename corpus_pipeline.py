"""The corpus pipeline: each stage takes (spark, docs, folder) and gives what it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm import decontaminate, linededup, mixture, neardup, toxicity
from tallyrill.llm.base import staged

ORACLE_SQL = None  # toxicity and packing are beyond SQL


def toxic_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score under 0.7; nothing is learnt from the held-out third of the labels."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    return toxicity.under(docs, model, 0.7)


def lines_once(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each line at its first place; documents without any line of their own go."""
    once = linededup.without_copies(docs)
    return once.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))


def copies_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, Jaccard similarity of 0.8 or more."""
    return neardup.one_of_each(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of full sequences in the corpus' proportions of sources."""
    return mixture.pack(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", lines_once),
    ("near_dedup", copies_out),
    ("decontamination", benchmark_out),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
