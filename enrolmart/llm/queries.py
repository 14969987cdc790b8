"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from enrolmart.llm import (
    chat,
    collocations,
    decontam,
    divergence,
    exact_dedup,
    line_dedup,
    packing,
    secrets,
    simhash,
    suffix_tree,
    toxicity,
    url_filter,
    winnow,
)
from enrolmart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op9(table(spark, sf_dir, "documents"))


QUERIES["op9_simhash_near_dedup"] = op9_simhash_near_dedup


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op3(table(spark, sf_dir, "documents"))


QUERIES["op3_packing"] = op3_packing


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


QUERIES["op6_lm_scoring"] = op6_lm_scoring


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op1(table(spark, sf_dir, "documents"))


QUERIES["op1_line_dedup"] = op1_line_dedup
ORACLE["op1_line_dedup"] = line_dedup.SQL


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op4(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op4_benchmark_decontamination"] = op4_benchmark_decontamination
ORACLE["op4_benchmark_decontamination"] = decontam.SQL


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.op10(table(spark, sf_dir, "documents"))


QUERIES["op10_document_fingerprints"] = op10_document_fingerprints


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op5_toxicity"] = op5_toxicity


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.op8(table(spark, sf_dir, "pages"))


QUERIES["op8_url_filters"] = op8_url_filters
ORACLE["op8_url_filters"] = url_filter.SQL


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op2(table(spark, sf_dir, "documents"))


QUERIES["op2_secret_scans"] = op2_secret_scans
ORACLE["op2_secret_scans"] = secrets.SQL


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op7(table(spark, sf_dir, "conversations"))


QUERIES["op7_chat_formatting"] = op7_chat_formatting
ORACLE["op7_chat_formatting"] = chat.SQL


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.op11(table(spark, sf_dir, "documents"))


QUERIES["op11_exact_dedup"] = op11_exact_dedup
ORACLE["op11_exact_dedup"] = exact_dedup.SQL


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.op12(table(spark, sf_dir, "documents"))


QUERIES["op12_phrase_collocations"] = op12_phrase_collocations
ORACLE["op12_phrase_collocations"] = collocations.SQL


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.op13(table(spark, sf_dir, "documents"))


QUERIES["op13_source_divergence"] = op13_source_divergence
ORACLE["op13_source_divergence"] = divergence.SQL


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
