"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provatab.llm import bpe, decontamination, line_dedup, neighbours, periodic, quality, repeats, simhash, token_counts, token_files, toxicity, warc, whitening
from provatab.llm.common import importable
from provatab.llm.tokenizer_files import default_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op3_token_counts")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf, "documents"), default_path("byte_bpe_50k.json"), limit=1024)


@query("op8_bpe_automaton")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf, "documents"), default_path("word_bpe_49k.json"))


@query("op10_token_files")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf, "documents"), default_path("word_bpe_49k.json"))


@query("op5_line_dedup", line_dedup.SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf, "documents"), min_docs=10, min_chars=1)


@query("op6_simhash_components")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.component_rows(table(spark, sf, "documents"), width=4, distance=4)


@query("op7_benchmark_leaks", decontamination.SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"), width=5, threshold=0.8)


@query("op4_warc_archives", warc.SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"), min_bytes=0)


@query("op9_nearest_vectors")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"), every=20, k=20)


@query("op2_quality_scores")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"), folds=3, fold=1)


@query("op1_toxicity_scores")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"), folds=5, fold=0)


@query("op11_whitened_embeddings")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.component_rows(table(spark, sf, "embeddings"), components=8)


@query("op12_periodic_runs", periodic.SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.run_digests(table(spark, sf, "documents"))


@query("op13_repeated_strings")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf, "documents"), length=200)
