"""From raw documents to an encoded training mix: toxicity, exact and near dedup, source mixing, BPE.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written and read again as the next one's docs. All
but the last give the columns of ``documents``. Null texts count as empty; empty tables stay empty; rows with equal ids
are handled by their texts; other columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from lotwise.llm.queries import DEFAULT_WEIGHT, SEED, TOKENIZER, WEIGHTS
from lotwise.llm.tables import checkpoint_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit of toxicity; learned from the labelled ones among ``docs``."""
    return toxicity.drop_toxic(docs, toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group with equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of near copies."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for, shuffled."""
    mixed = mixing.mix_sources(docs, WEIGHTS, DEFAULT_WEIGHT, seed=SEED)
    return mixed.select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the tokens and the text decoded from them: doc_id, n_tokens, ids, decoded."""
    return bpe.encode_texts(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("bpe", encode),
]

#: Two stages fit or verify what SQL can't express. No test compares the rows of the whole pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
