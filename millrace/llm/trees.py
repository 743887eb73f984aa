"""Small decision trees over a bounded table of numbers, and their form as Spark columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Rows with ``feature <= at`` go to ``low``."""

    feature: int
    at: float
    low: Leaf | Split
    high: Leaf | Split


def cut_points(values: np.ndarray, most: int = 32) -> list[np.ndarray]:
    """Midpoints between neighbouring quantiles of each feature."""
    cuts = []
    for column in values.T:
        distinct = np.unique(column)
        if len(distinct) > most:
            distinct = np.unique(np.quantile(column, np.linspace(0, 1, most), method="nearest"))
        cuts.append((distinct[1:] + distinct[:-1]) / 2)
    return cuts


def grow(values: np.ndarray, goal: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray],
         depth: int, least_rows: int, draw: np.random.Generator, features: int) -> Leaf | Split:
    """A tree that predicts ``goal`` by weighted least squares.

    Each split looks at ``features`` drawn features. Of splits with equal gain
    the first feature and lowest cut wins.
    """
    total = weight.sum()
    mean = float((goal * weight).sum() / total) if total else 0.0
    if depth == 0 or len(goal) < 2 * least_rows or np.ptp(goal) == 0:
        return Leaf(mean)
    best = (1e-9, -1, 0.0)
    for j in np.sort(draw.choice(values.shape[1], features, replace=False)):
        if not len(cuts[j]):
            continue
        bins = np.searchsorted(cuts[j], values[:, j])
        size = len(cuts[j]) + 1
        w = np.cumsum(np.bincount(bins, weight, size))[:-1]
        g = np.cumsum(np.bincount(bins, weight * goal, size))[:-1]
        rows = np.cumsum(np.bincount(bins, minlength=size))[:-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = g ** 2 / w + (mean * total - g) ** 2 / (total - w) - mean ** 2 * total
        gain[(rows < least_rows) | (len(goal) - rows < least_rows)] = -1.0
        k = int(np.argmax(np.nan_to_num(gain, nan=-1.0)))
        if gain[k] > best[0]:
            best = (float(gain[k]), int(j), float(cuts[j][k]))
    if best[1] < 0:
        return Leaf(mean)
    low = values[:, best[1]] <= best[2]
    sides = [grow(values[side], goal[side], weight[side], cuts, depth - 1, least_rows, draw,
                  features) for side in (low, ~low)]
    return Split(best[1], best[2], *sides)


def predict(tree: Leaf | Split, values: np.ndarray) -> np.ndarray:
    if isinstance(tree, Leaf):
        return np.full(len(values), tree.value)
    low = values[:, tree.feature] <= tree.at
    out = np.empty(len(values))
    out[low], out[~low] = predict(tree.low, values[low]), predict(tree.high, values[~low])
    return out


def forest(values: np.ndarray, labels: np.ndarray, trees: int, depth: int, least_rows: int,
           seed: int) -> list[Leaf | Split]:
    """A random forest for 0/1 labels: each tree sees a bootstrap of the rows, each
    split the square root of the features; both labels weigh the same."""
    draw = np.random.default_rng(seed)
    cuts = cut_points(values)
    balance = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9),
                       0.5 / max(1 - labels.mean(), 1e-9))
    features = max(1, round(values.shape[1] ** 0.5))
    grown = []
    for _ in range(trees):
        rows = draw.integers(0, len(labels), len(labels))
        grown.append(grow(values[rows], labels[rows].astype(float), balance[rows], cuts, depth,
                          least_rows, draw, features))
    return grown


def as_column(tree: Leaf | Split, features: list[Column]) -> Column:
    """The tree as nested CASE expressions."""
    if isinstance(tree, Leaf):
        return F.lit(tree.value)
    return F.when(features[tree.feature] <= F.lit(tree.at), as_column(tree.low, features)
                  ).otherwise(as_column(tree.high, features))


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions: (feature, whether at most, at)."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for j, at_most, at in self.conditions:
            out &= (values[:, j] <= at) == at_most
        return out

    def column(self, features: Mapping[int, Column]) -> Column:
        out = F.lit(True)
        for j, at_most, at in self.conditions:
            out = out & ((features[j] <= F.lit(at)) if at_most else (features[j] > F.lit(at)))
        return out


def rules(tree: Leaf | Split, path: tuple = ()) -> list[Rule]:
    """Every path from the root to a node below it, as a rule."""
    if isinstance(tree, Leaf):
        return []
    found = []
    for at_most, below in ((True, tree.low), (False, tree.high)):
        here = (*path, (tree.feature, at_most, tree.at))
        found += [Rule(here), *rules(below, here)]
    return found
