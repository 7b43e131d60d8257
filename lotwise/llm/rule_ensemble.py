"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm import boosting
from lotwise.llm.labelled import MOST_LABELLED, labelled_sample
from lotwise.llm.statistics import RATES, held_out, with_statistics

#: Trees that the rules come from, and their depth.
TREES, DEPTH = 40, 3
#: Weight of the sum of absolute rule weights against the mean log-loss.
PENALTY = 0.002
STEPS = 300


@dataclass
class Rules:
    """score = sigmoid(start + sum of the weights of the rules that hold). A rule: (feature, at most?, threshold), ..."""

    start: float
    weighted: list[tuple[tuple[tuple[str, bool, float], ...], float]]

    def column(self) -> Column:
        """The score as one expression over the statistics' columns."""

        def holds(rule) -> Column:
            parts = [F.col(f) <= t if at_most else F.col(f) > t for f, at_most, t in rule]
            return reduce(lambda a, b: a & b, parts)

        terms = [F.when(holds(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.weighted]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.start))))


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> Rules:
    """Paths of boosted trees as rules; logistic regression with a lasso penalty chooses and weighs them."""
    forest = boosting.fit(x, y, trees=TREES, depth=DEPTH)
    rules = sorted({_simplest(way) for way in forest.paths()})
    if not rules:
        return Rules(forest.start, [])
    hits = np.stack([_hits(x, rule) for rule in rules], 1).astype(np.float64)
    start, weights = _lasso(hits, y.astype(np.float64))
    named = lambda rule: tuple((names[f], at_most, t) for f, at_most, t in rule)
    return Rules(start, [(named(r), float(w)) for r, w in zip(rules, weights, strict=True) if w != 0])


def _simplest(way) -> tuple[tuple[int, bool, float], ...]:
    """One condition per feature and side, the narrower one."""
    narrow: dict[tuple[int, bool], float] = {}
    for f, at_most, t in way:
        known = narrow.get((f, at_most), t)
        narrow[f, at_most] = min(known, t) if at_most else max(known, t)
    return tuple(sorted((f, at_most, t) for (f, at_most), t in narrow.items()))


def _hits(x: np.ndarray, rule) -> np.ndarray:
    held = np.ones(len(x), bool)
    for f, at_most, t in rule:
        held &= (x[:, f] <= t) if at_most else (x[:, f] > t)
    return held


def _lasso(hits: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient steps; the start value isn't penalised."""
    n, m = hits.shape
    step = 4 * n / (np.linalg.norm(hits, 2) ** 2 + n)
    w, v, a, t = np.zeros(m), np.zeros(m), np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)), 1.0
    b = a
    for _ in range(STEPS):
        error = boosting.sigmoid(hits @ v + b) - y
        w_new = v - step * (hits.T @ error) / n
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * PENALTY, 0)
        a_new = b - step * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, b = w_new + (t - 1) / t_new * (w_new - w), a_new + (t - 1) / t_new * (a_new - a)
        w, a, t = w_new, a_new, t_new
    return float(a), w


def learn_quality_rules(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    most: int = MOST_LABELLED,
) -> Rules:
    """Rules fitted on at most ``most`` labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, id_col, text_col, most)
    known = with_statistics(sample, {"learn_label": "learn_label"}, "learn_text").select("learn_label", *RATES).toPandas()
    return fit_rules(known[RATES].to_numpy(float), known["learn_label"].to_numpy(float), RATES)


def score_quality(docs: DataFrame, rules: Rules, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts have statistics of 0 and get the score that the rules give them. Rows with equal ids are
    scored each for itself; a null id isn't held out. An empty table gives an empty result, one without labels a constant
    score of 0.5. Other columns are neither read nor returned.
    """
    measured = with_statistics(docs, {"scored_id": f"`{id_col}`"}, text_col)
    scored = measured.select("scored_id", held_out("scored_id").alias("held_out"), rules.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumnRenamed("scored_id", id_col)
