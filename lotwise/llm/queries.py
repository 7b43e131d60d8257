"""One registered query per operator: it applies the operator to its whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import (
    bpe,
    chat_format,
    exact_dedup,
    license_scan,
    merkle,
    mixing,
    near_dedup,
    oracle,
    quality_rules,
    rule_ensemble,
    substring_dedup,
    token_files,
    toxicity,
    turn_repair,
)
from lotwise.llm.tables import table

#: Weights of sources in the mix; all others weigh DEFAULT_WEIGHT.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 2.0, "src3": 0.5}
DEFAULT_WEIGHT = 1.0
SEED = 17
TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_quality_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = rule_ensemble.learn_quality_rules(docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.score_quality(docs, rules)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, DEFAULT_WEIGHT, seed=SEED)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digests(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_rules.learn_quality_trees(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_quality_rules(docs, forest)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_conversations(turn_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), token_files.new_folder(spark)
    token_files.write_token_files(docs, public_tokenizers.path(BYTE_TOKENIZER), folder)
    return token_files.digest_token_files(spark, folder)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.verify_documents(table(spark, sf_dir, "documents"), tampered)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline  # it imports this module

    return {
        "pipeline": corpus_pipeline.run,
        "op1_exact_dedup": op1_exact_dedup,
        "op2_license_scan": op2_license_scan,
        "op3_quality_rule_ensemble": op3_quality_rule_ensemble,
        "op4_source_mixing": op4_source_mixing,
        "op5_chat_format": op5_chat_format,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_bpe": op8_bpe,
        "op9_minhash_near_dedup": op9_minhash_near_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_turn_repair": op11_turn_repair,
        "op12_token_files": op12_token_files,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": oracle.OP1,
        "op2_license_scan": oracle.op2(),
        "op4_source_mixing": oracle.op4(WEIGHTS, DEFAULT_WEIGHT, SEED),
        "op11_turn_repair": oracle.OP11,
        "op13_merkle_manifest": oracle.OP13,
    }
