"""Corpus pipeline over ``documents``: quality rules, near-dedup, secrets, mixture, packing.

Each stage works on all that the stage before kept and is written before the
next one reads it.  The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import minhash, mixing, packing, quality, secrets
from tripmart.llm.common import read_table, stage
from tripmart.llm.queries import TOKENIZER


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced; ``n_chars`` follows the new text."""
    clean = secrets.redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
    return clean.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mixture."""
    return mixing.in_mixed_order(docs, mixing.mix(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and place; sequences follow the order of the files
    that ``docs`` is read from, which is that of the mixture."""
    return packing.pack(docs, TOKENIZER, with_ids=False, place=mixing.file_place())


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The tokeniser cannot be expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
