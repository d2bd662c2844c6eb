"""The training-data pipeline: documents to token ids in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.  Nulls, empty and repeated rows, extra
columns: as the operators' modules say.

``ORACLE_SQL`` is None: learned trees, Hamming components and tokenizers are
not expressible in SQL.  The tests hold every stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import qgram_leaks, repeated_windows, sentencepiece_prefix, simhash_blocks, toxicity_trees
from tallyhouse.llm.common import drop_table, read_input, write_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    model = toxicity_trees.fit(docs, read_input(spark, sf_dir, "labels"))
    return toxicity_trees.reject_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest id."""
    return simhash_blocks.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows are cut out of the texts, and ``n_chars`` follows."""
    cut = repeated_windows.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cut.columns else cut


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return qgram_leaks.clean_documents(docs, read_input(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to."""
    return sentencepiece_prefix.encode_documents(docs, digest=True).drop("text")


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; tables between stages lie in the shared folder."""
    docs, before = read_input(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = write_table(out, f"pipeline-{name}")
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            drop_table(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
