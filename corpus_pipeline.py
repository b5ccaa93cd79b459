"""The corpus pipeline: quality rules, line duplicates, near-duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabulon.llm import line_dedup, mixing, packing, quality, simhash
from tabulon.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality.keep_good(docs)


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that (nearly) equal a line of an earlier document."""
    return line_dedup.drop_duplicate_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences."""
    return packing.pack(docs, packing.tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources", mixture),
    ("best-fit packing", packed),
]

#: Hash fingerprints, MinHash, quantile sketches and tokenizers have no SQL twin; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
