"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.statistics import held_out

#: Rows that a classifier is fitted on, at most: those with the smallest hash of their id.
MOST_LABELLED = 10_000
#: Tasks that share the work on a sample.
TASKS = 16


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED
) -> DataFrame:
    """(learn_id, learn_text, learn_label) of at most ``most`` labelled rows outside the held-out fold.

    Labels other than 0 and 1 and null ids are left out. An id that is labelled twice takes part once, with its larger
    label; of documents that share an id, that with the smallest hash of its text. The texts are spread over TASKS tasks.
    """
    known = labels.select(F.col(id_col).alias("learn_id"), F.col(label).alias("learn_label"))
    known = known.filter(F.col("learn_label").isin(0, 1) & F.col("learn_id").isNotNull() & ~held_out("learn_id"))
    chosen = known.groupBy("learn_id").agg(F.max("learn_label").alias("learn_label"))
    chosen = chosen.orderBy(F.xxhash64("learn_id"), "learn_id").limit(most)
    texts = docs.select(F.col(id_col).alias("learn_id"), F.col(text_col).alias("learn_text"))
    found = texts.join(F.broadcast(chosen), "learn_id").groupBy("learn_id", "learn_label")
    one = found.agg(F.min_by("learn_text", F.struct(F.xxhash64("learn_text"), F.col("learn_text"))).alias("learn_text"))
    return one.select("learn_id", "learn_text", "learn_label").repartition(TASKS, "learn_id")
