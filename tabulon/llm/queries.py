"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tabulon.llm import alignment, language, licences, line_dedup, middle, mixing, packing, quality, recompression, simhash, suffixes, token_counts, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


@query("op1_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(_documents(spark, sf_dir)))


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), packing.tokenizer_file("piece_bpe_32k.model"))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), packing.tokenizer_file("word_bpe_49k.json"))


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(_documents(spark, sf_dir)))


@query("op6_vectors", vectors.ORACLE_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_documents(spark, sf_dir))


@query("op8_suffixes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(_documents(spark, sf_dir)))


@query("op9_licences", licences.ORACLE_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_documents(spark, sf_dir))


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(_documents(spark, sf_dir))


@query("op11_recompression")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.digest(recompression.remove_passages(_documents(spark, sf_dir)))


@query("op12_middle", middle.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digest(middle.fill_in_middle(_documents(spark, sf_dir)))


@query("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(alignment.align(_documents(spark, sf_dir), packing.tokenizer_file("byte_bpe_50k.json"), packing.tokenizer_file("piece_bpe_32k.model")))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
