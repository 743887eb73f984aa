"""Ranked lexical search with geometric blocks in every posting list.

Documents are read as counts of the terms that the items ask for. A task indexes them in shards of bounded
size: per term a posting list, clustered by similarity of the documents (nearest of some
documents of the list, in a random projection), and per cluster a block with a summary, the greatest impact of
each term over its documents. An item walks its terms from the most to the least that they can give. A
block is skipped only if the summary's bound is below the score that ranks last so far, and a walk ends only if
all terms to come cannot reach that score together; so ranks are exact.

A task keeps its best documents per item from shard to shard, and only those leave it.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import texts, written

#: Fixed: a term is a longest run of ASCII letters and digits and of characters beyond ASCII.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


#: An impact is at most a million.
IMPACT_BITS = 20


@dataclass(frozen=True)
class Search:
    """``top`` documents of an item. ``shard``: postings that are indexed at once. ``block``: documents of a
    block on average, half of the most. ``sketch``: dimensions in which documents are compared. ``asked``:
    code points of items that are searched together on average; more items take more rounds over the documents."""

    top: int = 50
    shard: int = 500_000
    block: int = 64
    sketch: int = 32
    asked: int = 2_000_000
    seed: int = 12


def terms_of(text: str | None) -> list[str]:
    # Lower-casing bytes changes A-Z only.
    return TERM.findall((text or "").encode().lower().decode())


@dataclass(frozen=True)
class Asked:
    """Items with the numbers of their terms, and the number of each term."""

    items: list[int | None]
    terms: list[np.ndarray]
    number: dict[str, int]


def item_groups(items: DataFrame, conf: Search) -> list[DataFrame]:
    """Items dealt by their ids into as many groups as their text needs."""
    size = items.agg(F.sum(F.length("text")).alias("size")).first()["size"] or 0
    groups = 1 + size // conf.asked
    home = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    return [items.where(home == g) for g in range(groups)]


def asked_of(items: DataFrame) -> Asked:
    """Rows of one group; those that repeat an id ask for the terms of all."""
    wanted: dict[int | None, set[str]] = defaultdict(set)
    for row in items.select("item_id", "text").collect():
        wanted[row["item_id"]].update(terms_of(row["text"]))
    number: dict[str, int] = {}
    names = sorted(wanted, key=lambda i: (i is None, i))
    terms = [np.array([number.setdefault(t, len(number)) for t in sorted(wanted[i])], np.int64)
             for i in names]
    return Asked(names, terms, number)


def counted_terms(docs: DataFrame, number: dict[str, int]) -> DataFrame:
    """Per document with a term: ``doc_id``, ``n`` (its terms, repeats too), and the asked ones
    as ``terms`` (numbers) with their ``times``."""
    held = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches):
        known = held.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 1_000):
                yield counted(batch.slice(begin, 1_000), known)

    def counted(batch, known):
        made = {"doc_id": [], "n": [], "terms": [], "times": []}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            found = terms_of(text)
            if not found:
                continue
            counts = Counter(map(known.get, found))
            counts.pop(None, None)
            made["doc_id"].append(doc_id)
            made["n"].append(len(found))
            made["terms"].append(list(counts))
            made["times"].append(list(counts.values()))
        return pa.RecordBatch.from_arrays(
            [pa.array(made["doc_id"], pa.int64()), pa.array(made["n"], pa.int64()),
             pa.array(made["terms"], pa.list_(pa.int32())),
             pa.array(made["times"], pa.list_(pa.int64()))], names=list(made))

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n bigint, terms array<int>, times array<bigint>")


@dataclass(frozen=True)
class Statistics:
    """N, L and the documents of each term."""

    documents: int
    length: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        return np.floor(1000 * np.log(
            (2 * self.documents + 2) / (2.0 * self.holding + 1))).astype(np.int64)

    def impacts(self, times: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 50 + 50 * n * self.documents // max(self.length, 1)
        return 1_000_000_000 * times // (1000 * times + 20 * m)


def statistics(counted: DataFrame, different: int) -> Statistics:
    total = counted.agg(F.count(F.lit(1)).alias("n"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    holding = np.zeros(different, np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row["term"]] = row["count"]
    return Statistics(total["n"], total["length"], holding)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of several spans, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class _Rows:
    """Sparse rows: numbers and values, row after row."""

    def __init__(self, lengths: np.ndarray, numbers: np.ndarray, values: np.ndarray):
        self.at = np.concatenate(([0], np.cumsum(lengths)))
        self.numbers, self.values = numbers, values

    def products(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The inner product of each of these rows with dense ``weights``, in integers."""
        lengths = self.at[rows + 1] - self.at[rows]
        places = _spans(self.at[rows], lengths)
        sums = np.concatenate(([0], np.cumsum(weights[self.numbers[places]] * self.values[places])))
        ends = np.cumsum(lengths)
        return sums[ends] - sums[ends - lengths]


@dataclass(frozen=True)
class Blocks:
    """One posting list: its documents block after block, where blocks begin, and a summary of each."""

    members: np.ndarray
    at: np.ndarray
    summaries: _Rows


class Shard:
    """Some documents and their posting lists; a list is cut into blocks when an item first
    walks to it."""

    def __init__(self, terms: list[np.ndarray], impacts: list[np.ndarray], different: int,
                 conf: Search):
        lengths = np.array([len(t) for t in terms], np.int64)
        numbers = np.concatenate(terms).astype(np.int64)
        self.docs = _Rows(lengths, numbers, np.concatenate(impacts).astype(np.int64))
        self.size, self.different, self.conf = len(terms), different, conf
        owner = np.repeat(np.arange(self.size), lengths)
        by_term = np.argsort(numbers, kind="stable")
        self.owner = owner[by_term]
        self.border = np.searchsorted(numbers[by_term], np.arange(different + 1))
        self.most = np.zeros(different, np.int64)
        np.maximum.at(self.most, numbers, self.docs.values)
        self.blocks: dict[int, Blocks] = {}

    @functools.cached_property
    def sketch(self) -> np.ndarray:
        """Directions of the documents in few dimensions, by a random projection."""
        draw = np.random.default_rng(self.conf.seed).standard_normal(
            (self.different, self.conf.sketch), np.float32)
        owner = np.repeat(np.arange(self.size), np.diff(self.docs.at))
        sums = np.stack([np.bincount(owner, draw[self.docs.numbers, j] * self.docs.values, self.size)
                         for j in range(self.conf.sketch)], 1).astype(np.float32)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        return sums / np.where(norm > 0, norm, 1)

    def list_of(self, term: int) -> Blocks:
        if term not in self.blocks:
            clusters = list(self._clusters(self.owner[self.border[term]:self.border[term + 1]]))
            members = np.concatenate(clusters) if clusters else np.empty(0, np.int64)
            at = np.concatenate(([0], np.cumsum([len(c) for c in clusters]))).astype(np.int64)
            self.blocks[term] = Blocks(members, at, self._summaries(members, at))
        return self.blocks[term]

    def _clusters(self, members: np.ndarray):
        """A posting list in blocks: each document with the nearest of some evenly spaced ones."""
        most = 2 * self.conf.block
        if len(members) <= most:
            if len(members):
                yield members
            return
        centres = self.sketch[members[::self.conf.block]]
        home = np.concatenate([
            np.argmax(self.sketch[members[i:i + 4096]] @ centres.T, 1)
            for i in range(0, len(members), 4096)])
        order = np.argsort(home, kind="stable")
        cuts = np.flatnonzero(np.diff(home[order])) + 1
        for cluster in np.split(members[order], cuts):
            for i in range(0, len(cluster), most):
                yield cluster[i:i + most]

    def _summaries(self, members: np.ndarray, at: np.ndarray) -> _Rows:
        """Per block the greatest impact of each term over its documents: the last of each
        (block, term) once both are sorted with the impacts behind them."""
        counts = self.docs.at[members + 1] - self.docs.at[members]
        places = _spans(self.docs.at[members], counts)
        block = np.repeat(np.arange(len(at) - 1) * self.different, np.diff(at))
        key = self.docs.numbers[places] + np.repeat(block, counts)
        both = np.sort(key << IMPACT_BITS | self.docs.values[places])
        key = both >> IMPACT_BITS
        last = np.flatnonzero(np.diff(key, append=-1))
        return _Rows(np.bincount(key[last] // self.different, minlength=len(at) - 1),
                     key[last] % self.different, both[last] & (1 << IMPACT_BITS) - 1)

    def search(self, terms: np.ndarray, weights: np.ndarray, floor: int, found) -> tuple[int, int]:
        """Walk the lists of ``terms``. ``found(docs, scores)`` takes documents that may rank and
        returns the score to reach from then on. Returns the blocks of the lists, and the skipped ones."""
        dense = np.zeros(self.different, np.int64)
        dense[terms] = weights[terms]
        gives = dense[terms] * self.most[terms]
        terms = terms[np.argsort(-gives, kind="stable")]
        gives = np.sort(gives)[::-1]
        reach = np.cumsum(gives[::-1])[::-1]
        seen = np.zeros(self.size, bool)
        blocks = skipped = 0
        for term, most in zip(terms.tolist(), reach.tolist()):
            # A document met in no list so far has only the terms from here on.
            if most < floor:
                break
            own = self.list_of(term)
            every = np.arange(len(own.at) - 1)
            alive = every[own.summaries.products(every, dense) >= floor]
            blocks += len(every)
            skipped += len(every) - len(alive)
            members = own.members[_spans(own.at[alive], own.at[alive + 1] - own.at[alive])]
            members = members[~seen[members]]
            if len(members):
                seen[members] = True
                floor = found(members, self.docs.products(members, dense))
        return blocks, skipped


class _Best:
    """The best documents of one item so far: greatest score first, then least id, NULL last."""

    def __init__(self, top: int):
        self.top = top
        self.score = np.empty(0, np.int64)
        self.doc_id = np.empty(0, np.int64)
        self.floor = 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> int:
        keep = scores >= self.floor
        score = np.concatenate((self.score, scores[keep]))
        doc_id = np.concatenate((self.doc_id, ids[keep]))
        order = np.lexsort((doc_id, -score))[:self.top]
        self.score, self.doc_id = score[order], doc_id[order]
        if len(order) == self.top:
            # An equal score may still rank by its id.
            self.floor = int(self.score[-1])
        return self.floor


#: Stands for a missing id: behind all others.
_NO_ID = np.iinfo(np.int64).max


def best_of_tasks(counted: DataFrame, asked: Asked, stats: Statistics, conf: Search) -> DataFrame:
    """``item`` (its place), ``doc_id``, ``score``: the best of each task, not ranked yet."""
    held = counted.sparkSession.sparkContext.broadcast(
        (asked.terms, stats, stats.weights()))

    def run(batches):
        terms, stats, weights = held.value
        best = [_Best(conf.top) for _ in terms]

        def search(rows):
            ids = np.array([_NO_ID if r[0] is None else r[0] for r in rows], np.int64)
            shard = Shard([r[1] for r in rows], [r[2] for r in rows], len(weights), conf)
            for wanted, mine in zip(terms, best):
                if len(wanted):
                    shard.search(wanted, weights, mine.floor,
                                 lambda docs, scores, mine=mine: mine.add(scores, ids[docs]))

        rows, postings = [], 0
        for batch in batches:
            columns = {c: batch.column(c) for c in ("doc_id", "n", "terms", "times")}
            at = columns["terms"].offsets.to_numpy()
            numbers = columns["terms"].values.to_numpy()
            impacts = stats.impacts(
                columns["times"].values.to_numpy()[at[0]:at[-1]],
                np.repeat(columns["n"].to_numpy(), np.diff(at)))
            for i, doc_id in enumerate(columns["doc_id"].to_pylist()):
                if at[i] == at[i + 1]:
                    continue
                rows.append((doc_id, numbers[at[i]:at[i + 1]],
                             impacts[at[i] - at[0]:at[i + 1] - at[0]]))
                postings += int(at[i + 1] - at[i])
                if postings >= conf.shard:
                    search(rows)
                    rows, postings = [], 0
        if rows:
            search(rows)
        made = [(i, b.doc_id, b.score) for i, b in enumerate(best) if len(b.score)]
        ids = np.concatenate([m[1] for m in made] or [np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([m[0] for m in made], [len(m[1]) for m in made]).astype(np.int64)),
             pa.array(ids, pa.int64(), mask=ids == _NO_ID),
             pa.array(np.concatenate([m[2] for m in made] or [np.empty(0, np.int64)]))],
            names=["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _search_group(docs: DataFrame, items: DataFrame, conf: Search) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    asked = asked_of(items)
    counted = written(counted_terms(docs, asked.number), "search-terms")
    stats = statistics(counted, len(asked.number))
    found = best_of_tasks(counted, asked, stats, conf)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame(list(enumerate(asked.items)), "item bigint, item_id bigint")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= conf.top).join(names, "item").select(
        "item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, conf: Search = Search()) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the best documents of each item.

    Each row of ``docs`` is a document, repeated and NULL ids included (a NULL id comes last among equal scores).
    NULL and empty texts have no terms: such documents do not count, such items find
    nothing. Rows that repeat an ``item_id`` ask together. Other columns are left out.
    """
    made = [_search_group(docs, group, conf) for group in item_groups(items, conf)]
    return functools.reduce(DataFrame.unionByName, made)
