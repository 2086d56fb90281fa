"""Registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import (byte_bpe, chat, language_id, learned_ann, lexical, line_dedup, merkle, packing, quality_rules,
                            quality_sql, secrets, simhash, suffix_dedup, training_order)
from marketlens.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.report(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN)


def op3_learned_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_ann.search(table(spark, sf_dir, "embeddings"), every=20)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.report(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_byte_bpe, op3_learned_ann, op4_simhash, op5_suffix_dedup,
                                   op6_training_order, op7_quality_rules,
                                   op8_language_id, op9_chat, op10_line_dedup, op11_secret_scan,
                                   op12_lexical_search, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op7_quality_rules": quality_sql.report_sql(),
            "op9_chat": chat.render_sql(),
            "op10_line_dedup": line_dedup.report_sql(),
            "op12_lexical_search": lexical.search_sql(),
            "op13_merkle_manifest": merkle.manifest_sql()}
