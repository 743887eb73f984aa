"""Approximate nearest neighbours by collision counting.

Vectors are projected on random lines; each line keeps its projections in a
sorted array. A query opens a window around its own projection on every line
and widens all windows by virtual rehashing. A vector that falls into enough
windows collides and is verified by its exact inner product. A query stops
widening once a vector as near as its last found neighbour would almost surely have
collided.

The index is split into blocks by a hash of the vector's id; every block
answers all queries, and the best of all blocks are ranked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written


@dataclass(frozen=True)
class CollisionIndex:
    """``lines`` projections; a vector collides from ``share`` of them on. ``missed``
    bounds the probability that a vector within the found distance did not collide.
    ``widen`` is the factor of virtual rehashing."""

    lines: int = 64
    share: float = 0.55
    missed: float = 0.02
    widen: float = 1.35
    least_blocks: int = 32
    block_rows: int = 8192
    query_rows: int = 4096
    seed: int = 3


def _collision_share(lines: int, threshold: int, missed: float) -> float:
    """The chance per line from which fewer than ``threshold`` of ``lines``
    collisions have a probability of at most ``missed``."""
    low, high = 0.0, 1.0
    for _ in range(50):
        p = (low + high) / 2
        below = sum(math.comb(lines, i) * p ** i * (1 - p) ** (lines - i)
                    for i in range(threshold))
        low, high = (low, p) if below <= missed else (p, high)
    return high


def _half_width(p: float) -> float:
    """h with P(|N(0, 1)| <= h) = p."""
    low, high = 0.0, 10.0
    for _ in range(60):
        h = (low + high) / 2
        low, high = (low, h) if math.erf(h / math.sqrt(2)) >= p else (h, high)
    return high


class Block:
    """Sorted projections of some vectors, lifted so that the largest inner product
    is the least distance."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, conf: CollisionIndex):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.conf = ids[order], vectors[order], conf
        squares = (self.vectors ** 2).sum(1)
        self.reach = float(squares.max())
        lift = np.sqrt(np.maximum(self.reach - squares, 0))
        draw = np.random.default_rng(conf.seed)
        self.axes = draw.standard_normal((self.vectors.shape[1] + 1, conf.lines))
        projected = np.hstack([self.vectors, lift[:, None]]) @ self.axes
        self.order = np.ascontiguousarray(np.argsort(projected, axis=0, kind="stable").T)
        ordered = np.take_along_axis(projected.T, self.order, 1)
        # All lines in one ascending array: each line is shifted past the one before.
        self.shift = np.arange(conf.lines) * (4 * float(np.abs(ordered).max()) + 1)
        self.sorted = (ordered + self.shift[:, None]).ravel()
        self.begin = np.arange(conf.lines) * len(self.ids)
        self.threshold = max(1, math.ceil(conf.share * conf.lines))
        self.sure = _half_width(_collision_share(conf.lines, self.threshold, conf.missed))

    def _places(self, values: np.ndarray, side: str) -> list[int]:
        """Where a value for each line stands in that line's sorted array."""
        reach = self.shift[1] / 2 if len(self.shift) > 1 else np.inf
        found = np.searchsorted(self.sorted, np.clip(values, -reach, reach) + self.shift, side)
        return np.clip(found - self.begin, 0, len(self.ids)).tolist()

    def nearest(self, query: np.ndarray, k: int, own: int | None
                ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the ``k`` best vectors found, ``own`` left out."""
        n = len(self.ids)
        centre = query @ self.axes[:-1]
        length = float(query @ query)
        counts, scores = np.zeros(n, np.int64), np.full(n, -np.inf)
        low = self._places(centre, "left")
        high = low
        width = 0.35 * math.sqrt(length + self.reach)
        verified = np.zeros(n, bool)
        while True:
            to_low = self._places(centre - width, "left")
            to_high = self._places(centre + width, "right")
            grown = [self.order[i, a:b] for i, (a, b) in enumerate(zip(to_low, low)) if a < b]
            grown += [self.order[i, a:b] for i, (a, b) in enumerate(zip(high, to_high)) if a < b]
            if grown:
                counts += np.bincount(np.concatenate(grown), minlength=n)
            low, high = to_low, to_high
            new = np.flatnonzero((counts >= self.threshold) & ~verified)
            verified[new] = True
            scores[new] = (self.vectors[new] * query).sum(1)
            if own is not None:
                scores[new[self.ids[new] == own]] = -np.inf
            done = max(low) == 0 and min(high) == n
            found = np.isfinite(scores)
            if found.sum() >= k:
                last = np.partition(scores[found], -k)[-k]
                distance = math.sqrt(max(length + self.reach - 2 * last, 0.0))
                done = done or width >= self.sure * distance
            if done:
                break
            width *= self.conf.widen
        best = np.flatnonzero(found)
        best = best[np.lexsort((self.ids[best], -scores[best]))][:k]
        return self.ids[best], scores[best]


def _usable(column: str):
    """Not NULL or empty, no component NULL or not finite, not all zero."""
    big = F.lit(float("inf"))
    return (F.size(column) > 0) & F.forall(column, lambda x: F.coalesce(
        F.abs(x) < big, F.lit(False))) & F.exists(column, lambda x: x != 0)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20,
            conf: CollisionIndex = CollisionIndex()) -> DataFrame:
    """The ``k`` nearest vectors of each query by inner product, nearest first, ties to
    the smaller id: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Queries are the vectors whose id is divisible by ``every``. Vectors that are
    NULL, zero, or hold NULL or non-finite components take no part, nor do rows
    without id, nor vectors of another length than the query's. A query whose id
    repeats asks once, with the least of its vectors, and no row of its id answers it.
    """
    usable = vectors.where("vec_id IS NOT NULL").where(_usable("embedding")).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"),
        F.size("embedding").alias("dims"))
    usable = written(usable, "ann-vectors")
    sizes = usable.agg(F.count(F.lit(1)).alias("n")).first()
    rows = sizes["n"]
    queries = usable.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min("vector").alias("vector")).withColumn("dims", F.size("vector"))
    blocks = max(conf.least_blocks, -(-rows // conf.block_rows))
    query_blocks = -(-max(1, rows // every) // conf.query_rows)
    index = usable.withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ("block", "part", "dims")

    def search(held: pa.Table, asking: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if held.num_rows and asking.num_rows:
            block = Block(held.column("vec_id").to_numpy(), _matrix(held), conf)
            for own, query in zip(asking.column("vec_id").to_pylist(), _matrix(asking)):
                ids, scores = block.nearest(query, k, own)
                out["query_id"] += [own] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()),
                         "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    # A block is little data and much work: as many partitions as blocks, not by size.
    tasks = blocks * query_blocks
    index, asked = index.repartition(tasks, *keys), asked.repartition(tasks, *keys)
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
