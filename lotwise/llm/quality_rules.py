"""Quality rules: exact base rules and boosted trees with monotonic constraints over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import boosting
from lotwise.llm.labelled import MOST_LABELLED, labelled_sample
from lotwise.llm.statistics import COUNTS, RATES, with_statistics

#: A text with fewer words fails.
LEAST_WORDS = 20
#: A text with a larger percentage of repeated words fails.
MOST_REPEATED = 30
#: The more of these, the lower the score.
FALLING = ["symbol_rate", "repeat_rate", "dup_line_rate", "bang_rate", "bar_rate", "echo_rate", "top_word_rate"]
#: The more of these, the higher the score.
RISING = ["distinct_rate"]
#: Score from which on a document is kept.
ENOUGH = 0.5


def fit_quality(x: np.ndarray, y: np.ndarray) -> boosting.Forest:
    constraints = {RATES.index(c): -1 for c in FALLING} | {RATES.index(c): 1 for c in RISING}
    return boosting.fit(x, y, constraints)


def learn_quality_trees(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    most: int = MOST_LABELLED,
) -> boosting.Forest:
    """Trees fitted on at most ``most`` labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, id_col, text_col, most)
    known = with_statistics(sample, {"learn_label": "learn_label"}, "learn_text").select("learn_label", *RATES).toPandas()
    return fit_quality(known[RATES].to_numpy(float), known["learn_label"].to_numpy(float))


def apply_quality_rules(docs: DataFrame, forest: boosting.Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, the COUNTS, base_failed, score, kept.

    base_failed: fewer than LEAST_WORDS words, or more than MOST_REPEATED % of them in repeated windows. kept: not
    base_failed, and the trees' score is ENOUGH at least. Null and empty texts have no words and fail. Rows with equal ids
    are judged each for itself. An empty table gives an empty result. Other columns are neither read nor returned.
    """
    measured = with_statistics(docs, {"judged_id": f"`{id_col}`"}, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy() for c in RATES], 1) if batch.num_rows else np.zeros((0, len(RATES)))
            columns = [batch.column(c) for c in ("judged_id", *COUNTS)] + [pa.array(forest.score(x))]
            yield pa.RecordBatch.from_arrays(columns, ["judged_id", *COUNTS, "score"])

    kinds = [f"judged_id {measured.schema['judged_id'].dataType.simpleString()}", *[f"{c} long" for c in COUNTS], "score double"]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scored = measured.mapInArrow(run, ", ".join(kinds)).withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("score") >= ENOUGH)
    return scored.select(F.col("judged_id").alias(id_col), *COUNTS, "base_failed", "score", kept.alias("kept"))
