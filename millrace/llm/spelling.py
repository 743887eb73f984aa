"""Spelling variants: words that one inserted, deleted or replaced code point tells apart.

Words meet in buckets: a word is halved again and again, and all but one part of it
(with that part's place) is its bucket. Words one edit apart agree outside the part with the edit, so
they share that bucket; a bucket with many words is halved further, down to a part of one
code point, where an alphabet bounds it. Each pair is counted in the one bucket whose
part holds the first place where the two differ.

Within blocks of buckets the parts are indexed by bits: per (position, letter) a bitset over
the block's words. A query's letters move two sets along, all words of the block at once: those equal so
far, and those one error off, the latter with a set shifted by a position for insertions.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import texts, written


@dataclass(frozen=True)
class Spelling:
    """``least_length`` and ``least_count`` of a word. One occurrence in ``misspelt`` loses a code
    point (0: none do). A form has ``factor`` times the count. ``bucket`` words or ``cells`` code points
    make a bucket large enough to be halved."""

    least_length: int = 7
    least_count: int = 2
    misspelt: int = 31
    factor: int = 10
    bucket: int = 1024
    cells: int = 65_536


#: Words that a task counts before it passes the counts on.
_COUNTED = 400_000


def occurrences(text: str, doc_id: int | None, conf: Spelling) -> Counter:
    """Words of one text with their counts, misspelt ones as such."""
    # Lower-casing bytes changes A-Z only.
    runs = Counter(re.findall(rf"[A-Za-zÀ-ÿ]{{{conf.least_length},}}",
                              text.encode().lower().decode()))
    if not conf.misspelt:
        return runs
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, times in runs.items():
        h = zlib.crc32(run.encode(), begin)
        if h % conf.misspelt == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < conf.least_length:
                continue
        found[run] += times
    return found


def vocabulary(docs: DataFrame, conf: Spelling = Spelling()) -> DataFrame:
    """``word``, ``n`` of every word with enough occurrences; counted in each task first."""
    def rows(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
            names=["word", "n"])

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                seen.update(occurrences(text, doc_id, conf))
                if len(seen) > _COUNTED:
                    yield rows(seen)
                    seen = Counter()
        yield rows(seen)

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= conf.least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Each row in two buckets: of its open part, either half stays open."""
    half = F.floor(F.col("open") / 2).cast("int")
    split = F.array(
        F.struct(F.col("a"), (F.col("b") + F.col("open") - half).alias("b"), half.alias("open")),
        F.struct((F.col("a") + half).alias("a"), F.col("b"), (F.col("open") - half).alias("open")))
    return rows.withColumn("to", F.explode(split)).select(
        "word", "n", "m", "to.a", "to.b", "to.open").withColumn(
        "key", F.xxhash64("m", "a", "b", F.expr("substring(word, 1, a)"),
                          F.expr("right(word, b)")))


def _buckets(words: DataFrame, conf: Spelling) -> DataFrame:
    """Rows (word, n, m, a, b, open, key): a word in a bucket of words of ``m`` or ``m + 1`` code points
    that share the first ``a`` and the last ``b`` of them. Buckets without a pair are left out."""
    length = F.length("word")
    lengths = F.array_compact(F.array(
        length, F.when(length > conf.least_length, length - 1)))
    rows = words.withColumn("m", F.explode(lengths)).select(
        "word", "n", "m", F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("m").alias("open"))
    done = None
    while True:
        rows = written(_keyed(rows), "spelling-rows")
        sizes = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"),
            F.count_if(F.length("word") == F.col("m")).alias("shorter"),
            F.max("open").alias("widest"))
        large = (F.col("widest") > 1) & (
            (F.col("size") > conf.bucket) | (F.col("size") * F.col("widest") > conf.cells))
        level = written(
            rows.join(sizes.where("size > 1 AND shorter > 0")
                      .select("key", large.alias("large")), "key"), "spelling-level")
        ready = level.where("NOT large").drop("large")
        done = ready if done is None else done.unionByName(ready)
        # Of two words in one key by chance, one may have no part left to halve.
        rows = level.where("large").drop("large", "key")
        done = done.unionByName(level.where("large AND open < 2").drop("large"))
        rows = rows.where("open >= 2")
        if rows.isEmpty():
            return done


class _Block:
    """The bit-sliced index of some whole buckets, and what its words find in it."""

    def __init__(self, rows: list[tuple]):
        # word, n, m, a, b
        self.words = [r[0] for r in rows]
        self.counts = np.array([r[1] for r in rows], np.int64)
        parts = [w[a:len(w) - b] for w, _, _, a, b in rows]
        names: dict[tuple, int] = {}
        bucket = [names.setdefault((m, a, b, w[:a], w[len(w) - b:]), len(names))
                  for w, _, m, a, b in rows]
        n, width = len(rows), max(map(len, parts)) + 1
        self.padded = -(-n // 64) * 64
        flat = "".join(p.ljust(width, "\0") for p in parts)
        codes = np.zeros((self.padded, width), np.uint32)
        codes[:n] = np.frombuffer(flat.encode("utf-32-le"), np.uint32).reshape(n, width)
        letters, coded = np.unique(codes, return_inverse=True)
        self.coded = coded.reshape(codes.shape)
        self.at = np.stack([
            self._bits(self.coded[:, i] == np.arange(len(letters))[:, None]) for i in range(width)])
        self.bucket = np.full(self.padded, -1)
        self.bucket[:n] = bucket
        self.of_bucket = self._bits(self.bucket == np.arange(len(names))[:, None])
        self.open = np.array([m - a - b for _, _, m, a, b in rows])
        lengths = np.array([len(p) for p in parts])
        self.is_last = np.array([b == 0 for _, _, _, _, b in rows])
        self.shorter = lengths == self.open
        flags = np.zeros((2, self.padded), bool)
        flags[:, :n] = self.shorter, ~self.shorter
        self.equal_length, self.longer = self._bits(flags)

    def _bits(self, flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) of one open length whose words are one error apart; a
        query finds words as long as itself or longer by one."""
        same = self.of_bucket[self.bucket[queries]]
        inserted, replaced = same.copy(), np.zeros_like(same)
        for i in range(int(self.open[queries[0]])):
            letter = self.coded[queries, i]
            here, shifted = self.at[i][letter], self.at[i + 1][letter]
            replaced = (replaced & here) | (same & ~here)
            same &= here
            inserted = (inserted & shifted) | same
        # Equal up to the end of an inner part: the pair differs in a later one, and counts there.
        later = np.where(self.is_last[queries, None], np.uint64(0), same)
        found = (replaced & self.equal_length) | (inserted & self.longer & ~later)
        hits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")
        query, word = np.nonzero(hits)
        return queries[query], word

    def near(self) -> pa.RecordBatch:
        """Of each word with near ones: how many, and the one of largest count (ties: least word)."""
        pairs = [self.search(np.flatnonzero(self.shorter & (self.open == width)))
                 for width in np.unique(self.open[self.shorter])]
        one = np.concatenate([p[0] for p in pairs] or [np.empty(0, np.int64)])
        other = np.concatenate([p[1] for p in pairs] or [np.empty(0, np.int64)])
        # Equally long pairs are found from both sides, others from the shorter word only.
        back = ~self.shorter[other]
        one, other = np.concatenate((one, other[back])), np.concatenate((other, one[back]))
        n = len(self.words)
        order = sorted(range(n), key=lambda i: (-self.counts[i], self.words[i]))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        best = np.full(n, n)
        np.minimum.at(best, one, rank[other])
        count = np.bincount(one, minlength=n)
        rows = np.flatnonzero(count).tolist()
        forms = [order[best[i]] for i in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.words[i] for i in rows], pa.string()),
             pa.array(count[rows], pa.int64()),
             pa.array(self.counts[forms] if forms else [], pa.int64()),
             pa.array([self.words[i] for i in forms], pa.string())],
            names=["word", "n_near", "near_n", "near"])


def _whole_buckets(batches):
    """Rows of one bucket after the other; rows come sorted by key."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "word", "n", "m", "a", "b")]
        for k, *row in zip(*columns):
            if k != key and rows:
                yield rows
                rows = []
            key = k
            rows.append(tuple(row))
    if rows:
        yield rows


def near_words(words: DataFrame, conf: Spelling = Spelling()) -> DataFrame:
    """``word``, ``n_near``, ``near_n`` and ``near`` (the near word of largest count) of each word
    of (word, n) that has a near one. Every word has ``least_length`` code points at least."""
    def run(batches):
        block, widest = [], 0
        for rows in _whole_buckets(batches):
            width = max(m - a - b for _, _, m, a, b in rows) + 1
            size = len(block) + len(rows)
            if block and (size > conf.bucket or size * max(width, widest) > 2 * conf.cells):
                yield _Block(block).near()
                block, widest = [], 0
            block += rows
            widest = max(widest, width)
        if block:
            yield _Block(block).near()

    rows = _buckets(words, conf).repartition("key").sortWithinPartitions("open", "key")
    found = rows.select("key", "word", "n", "m", "a", "b").mapInArrow(
        run, "word string, n_near bigint, near_n bigint, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.minus")).alias("near_n"),
        F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of (word, form): forms followed to the last, in steps that double.

    A form counts ``factor`` times its word, so chains are short and have no circles.
    """
    current = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(current.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "spelling-roots")
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return current


def variants(docs: DataFrame, conf: Spelling = Spelling()) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of each word of ``docs``.

    NULL and empty texts have no words. A row without ``doc_id`` counts with an empty id; a repeated row
    counts again. Columns other than ``doc_id`` and ``text`` do not matter. Without documents there are no rows.
    """
    words = written(vocabulary(docs, conf), "spelling-words")
    near = written(near_words(words, conf), "spelling-near")
    large = F.col("near_n") >= conf.factor * F.col("n")
    judged = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(large, F.col("near")).alias("form"),
        F.when(large, F.col("near_n")).alias("form_n")), "spelling-forms")
    found = roots(judged.where("form IS NOT NULL"))
    return judged.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
