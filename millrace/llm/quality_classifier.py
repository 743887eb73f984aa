"""Quality classifier: a sparse rule ensemble over text statistics.

Small boosted trees propose rules, the conjunctions along their paths. A
logistic regression with an L1 penalty keeps few of them, and the kept ones
become one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import trees
from millrace.llm.common import bounded_sample, crc_remainder, per_batch, texts, written
from millrace.llm.quality_rules import COUNTS, measure_text

#: Statistics of a text that rules may use.
STATISTICS = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share",
              "words_a_line", "upper_share", "digit_share", "mark_share", "distinct_share",
              "common_word_share", "long_word_share")


def statistics(text: str) -> tuple[float, ...]:
    """The values of ``STATISTICS``; all zero for an empty text."""
    counts = dict(zip(COUNTS, measure_text(text)))
    words = text.encode().split()
    n, chars, lines = len(words), counts["word_chars"], counts["n_lines"]
    if not n:
        return (0.0,) * len(STATISTICS)
    data = text.encode()
    digits = len(data) - len(data.translate(None, b"0123456789"))
    marks = len(data) - len(data.translate(None, b"!?.,;:"))
    often: dict[bytes, int] = {}
    for w in words:
        often[w] = often.get(w, 0) + 1
    return (
        float(n), chars / n, counts["n_symbols"] / chars, counts["n_dup_lines"] / lines,
        counts["n_repeat_words"] / n, n / lines, counts["n_upper"] / chars, digits / chars,
        marks / chars, len(often) / n, max(often.values()) / n,
        sum(len(w) > 12 for w in words) / n,
    )


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of its whole text."""
    def make():
        def step(batch):
            values = list(zip(*map(statistics, texts(batch)))) or [()] * len(STATISTICS)
            return {"doc_id": batch.column("doc_id"),
                    **{name: list(v) for name, v in zip(STATISTICS, values)}}
        return step

    return per_batch(docs.select("doc_id", "text"),
                     "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS), make)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules. Without rules every score is that of ``intercept``."""

    intercept: float
    rules: tuple[tuple[trees.Rule, float], ...] = ()

    def score(self, columns: dict[str, Column] | None = None) -> Column:
        features = {j: (columns or {}).get(name, F.col(name))
                    for j, name in enumerate(STATISTICS)}
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            margin = margin + F.when(rule.column(features), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _lasso_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float,
                    rounds: int = 250) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept is not penalised."""
    centre = x.mean(0)
    spread = np.maximum(x.std(0), 0.05)
    z = np.hstack([np.ones((len(x), 1)), (x - centre) / spread])
    weight = weight / weight.sum()
    step = 4 / np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2
    beta = momentum = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(rounds):
        gradient = z.T @ (weight * (_sigmoid(z @ momentum) - y))
        new = momentum - step * gradient
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        momentum = new + (last - 1) / t * (new - beta)
        beta = new
    weights = beta[1:] / spread
    return float(beta[0] - weights @ centre), weights


def fit_rules(values: np.ndarray, labels: np.ndarray, count: int = 25, depth: int = 3,
              penalty: float = 0.002, seed: int = 5) -> RuleEnsemble:
    """A rule ensemble from a table of statistics and 0/1 labels, both weighing the same."""
    if not len(labels):
        return RuleEnsemble(0.0)
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    if labels.min() == labels.max():
        return RuleEnsemble(float(np.log(share / (1 - share))))
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    draw = np.random.default_rng(seed)
    cuts, margin, found = trees.cut_points(values), np.zeros(len(labels)), {}
    least = max(2, len(labels) // 400)
    for _ in range(count):
        rest = labels - _sigmoid(margin)
        rows = draw.random(len(labels)) < 0.7
        tree = trees.grow(values[rows], rest[rows], weight[rows], cuts, depth, least, draw,
                          min(values.shape[1], 6))
        margin = margin + 0.8 * trees.predict(tree, values)
        for rule in trees.rules(tree):
            holds = rule.holds(values)
            # Rules that hold for the same rows are one rule: the shortest.
            key = min(holds.tobytes(), (~holds).tobytes())
            if key not in found or len(rule.conditions) < len(found[key].conditions):
                found[key] = rule
    chosen = list(found.values())
    if not chosen:
        return RuleEnsemble(0.0)
    x = np.stack([r.holds(values) for r in chosen], 1).astype(float)
    intercept, weights = _lasso_logistic(x, labels.astype(float), weight, penalty)
    return RuleEnsemble(intercept, tuple(
        (r, float(w)) for r, w in zip(chosen, weights) if abs(w) > 1e-6))


def fit(features: DataFrame, labels: DataFrame, most_rows: int = 10_000) -> RuleEnsemble:
    """Learn ``labels.quality`` from rows whose crc32 of ``doc_id`` modulo 4 is not 2.

    Takes at most ``most_rows`` labelled rows, chosen by a hash of id and statistics. Labels that are NULL, and rows without id, are not used.
    """
    usable = labels.where("quality IN (0, 1)").select("doc_id", "quality").where(
        crc_remainder("doc_id", 4) != 2)
    labelled = written(features.join(usable, "doc_id"), "quality-labelled")
    sample = bounded_sample(labelled, most_rows, "doc_id", *STATISTICS, "quality").collect()
    values = np.array([[r[s] for s in STATISTICS] for r in sample], float).reshape(
        -1, len(STATISTICS))
    return fit_rules(values, np.array([r["quality"] for r in sample], int))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document.

    NULL and empty texts have statistics of zero and are scored. Each row gives
    one row; a row without id is not held out and teaches nothing. Without
    labels every score is one half.
    """
    features = written(measured(docs), "quality-statistics")
    model = fit(features, labels)
    return features.withColumn("score", model.score()).select(
        "doc_id", F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
