"""MinHash near-dedup.

Documents with equal shingle sets are one node. A node's universal hash minima
are banded; nodes that share a band are candidates. In every bucket the node
that shares most bands with others is the centre, and each member is held
against it: the signatures first, then the full sets. Stars give components by
alternating large-star and small-star.

Links that no centre shows are found in the buckets that still hold several
components, without comparing all their members. A member's partner shares
most of its shingles, so it shares one of the few rarest: those are joined. Only nodes that
consist of frequent shingles almost wholly escape that join; they are held against
nodes of other components in their buckets, each pair once.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import per_batch, texts, written


@dataclass(frozen=True)
class MinHash:
    """Words per shingle, similarity in percent, and the shape of the bands.

    With 32 bands of 5 rows a pair at similarity 0.80 shares no band with
    probability 3e-6, one at 0.85 with 7e-9. ``verify`` is the share of equal minima
    from which a pair is held against its full sets; a pair at 0.8 falls below a half
    with a probability under 1e-15. ``frequent``: how many unresolved nodes
    make a shingle frequent.
    """

    words: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 5
    verify: float = 0.5
    frequent: int = 32
    seed: int = 7


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PRIME, _PRIME_BASE = 2**31 - 1, 1_103_515_245
_ORDER = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _prime_powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_powers`, modulo a prime."""
    made = []
    for base in (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME)):
        found = np.ones(1 << bits, np.uint64)
        for i in range(bits):
            half = 1 << i
            found[half:2 * half] = found[:half] * np.uint64(pow(base, half, _PRIME)) % np.uint64(_PRIME)
        made.append(found)
    return made[0], made[1]


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for texts of 2^bits bytes."""
    up, down = np.full((2, 1 << bits), 1, np.uint64)
    up[1:], down[1:] = _BASE, pow(_BASE, -1, 1 << 64)
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles, A-Z lower-cased.

    A word's hash mixes two polynomials of its bytes, modulo 2^64 and modulo a prime (the
    former alone is blind to some words made of two letters), taken from running sums;
    a text of fewer words is one shingle; one without words has none.
    """
    data = np.frombuffer(text.encode().lower(), np.uint8)
    blank = np.concatenate(([True], _BLANK[data], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(max(17, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    up, back = _prime_powers(max(17, int(len(data)).bit_length()))
    rests = np.zeros(len(data) + 1, np.uint64)
    prime = np.uint64(_PRIME)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)] % prime, out=rests[1:])
    other = (rests[ends] - rests[starts]) % prime * back[starts] % prime
    hashes = _mix((sums[ends] - sums[starts]) * down[starts] + _mix(other))
    words = min(words, len(hashes))
    count = len(hashes) - words + 1
    found = np.zeros(count, np.uint64)
    for i in range(words):
        found = _mix(found * _ORDER + hashes[i:i + count])
    return np.unique(found)


@functools.lru_cache(maxsize=4)
def _family(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    odd = draw.integers(0, 2**31, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd.astype(np.uint32), draw.integers(0, 2**32, size, dtype=np.uint64).astype(np.uint32)


def signature(found: np.ndarray, conf: MinHash) -> np.ndarray:
    """The least value of each universal hash ``a * x + b`` modulo 2^32 over a set."""
    a, b = _family(conf.bands * conf.rows, conf.seed)
    folded = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(folded), 128):
        np.minimum(least, (folded[i:i + 128, None] * a + b).min(0), out=least)
    return least


def _bands(minima: np.ndarray, conf: MinHash) -> np.ndarray:
    keys = np.arange(1, conf.bands + 1, dtype=np.uint64)
    for column in minima.reshape(conf.bands, conf.rows).T:
        keys = _mix(keys * _ORDER + column.astype(np.uint64))
    return keys.view(np.int64)


def fingerprints(docs: DataFrame, conf: MinHash) -> DataFrame:
    """``doc_id``, ``n_shingles``, and for a text with words the digest of its set,
    its signature and its bands."""
    def make():
        def step(batch):
            sets = [shingles(t, conf.words) for t in texts(batch)]
            minima = [signature(s, conf) if len(s) else None for s in sets]
            return {
                "doc_id": batch.column("doc_id"),
                "n_shingles": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None
                           for s in sets],
                "minima": [None if m is None else m.tobytes() for m in minima],
                "bands": pa.array([None if m is None else _bands(m, conf) for m in minima],
                                  pa.list_(pa.int64())),
            }
        return step

    return per_batch(
        docs.select("doc_id", "text"),
        "doc_id bigint, n_shingles bigint, digest string, minima binary, bands array<bigint>",
        make)


def _similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, conf: MinHash) -> DataFrame:
    """The pairs ``a, b`` whose signatures and then whose full sets are alike. ``docs``
    has the texts of the nodes (node, text)."""
    def sides(table: DataFrame, *columns: str) -> list[DataFrame]:
        return [table.select(F.col("node").alias(side),
                             *(F.col(c).alias(f"{c}_{side}") for c in columns))
                for side in "ab"]

    left, right = sides(nodes, "minima")
    signed = per_batch(
        pairs.join(left, "a").join(right, "b").select("a", "b", "minima_a", "minima_b"),
        "a bigint, b bigint", lambda: functools.partial(_alike_signatures, least=conf.verify))
    left, right = sides(docs, "text")
    return per_batch(
        signed.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"),
        "a bigint, b bigint", lambda: functools.partial(_alike_sets, conf=conf)).distinct()


def _alike_signatures(batch: pa.RecordBatch, least: float) -> dict:
    left, right = (np.frombuffer(b"".join(batch.column(f"minima_{s}").to_pylist()), np.uint32)
                   .reshape(batch.num_rows, -1) for s in "ab")
    keep = pa.array((left == right).mean(1) >= least) if batch.num_rows else pa.array([], pa.bool_())
    return {side: batch.column(side).filter(keep) for side in "ab"}


def _alike_sets(batch: pa.RecordBatch, conf: MinHash) -> dict:
    keep = []
    for a, b in zip(texts(batch, "text_a"), texts(batch, "text_b")):
        left, right = shingles(a, conf.words), shingles(b, conf.words)
        common = len(np.intersect1d(left, right, assume_unique=True))
        union = len(left) + len(right) - common
        keep.append(common > 0 and 100 * common >= conf.percent * union)
    return {side: batch.column(side).filter(pa.array(keep, pa.bool_())) for side in "ab"}


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node of ``edges`` (a, b).

    Alternates large-star (a node's greater neighbours go to its least one) and
    small-star (its lesser neighbours and itself do) until neither changes an edge.
    Edges go to the shared folder after each round.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                     .first())

    current = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), "minhash-edges")
    before = state(current)
    while before[0]:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("of"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("of")).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("of"), "m")
        small = large.join(lowest, F.col("a") == F.col("of")).select(
            F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m")))
            .alias("e")).select(F.col("e.b").alias("a"), F.col("e.m").alias("b")
                                ).where("a <> b").distinct()
        current = written(small, "minhash-edges")
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn(
        "label", F.coalesce("component", "node")).drop("component")


def _sizes_fit(small: Column, large: Column, conf: MinHash) -> Column:
    return (F.least(small, large) * 100 >= F.greatest(small, large) * conf.percent)


def _hub_pairs(members: DataFrame, conf: MinHash) -> DataFrame:
    """Each member of a bucket with its bucket's centre. ``members``: key, node, size, fellows."""
    degree = members.groupBy("node").agg(F.sum("fellows").alias("degree"))
    ranked = members.join(degree, "node")
    centres = ranked.groupBy("key").agg(
        F.max(F.struct("degree", (-F.col("node")).alias("minus"), "size")).alias("c")
    ).select("key", (-F.col("c.minus")).alias("centre"), F.col("c.size").alias("centre_size"))
    return (
        members.join(centres, "key").where(F.col("node") != F.col("centre"))
        .where(_sizes_fit(F.col("size"), F.col("centre_size"), conf))
        .select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"))
        .distinct()
    )


def _rare_pairs(open_sets: DataFrame, conf: MinHash) -> DataFrame:
    """Pairs across components that share one of the rarest shingles of the smaller set.

    ``open_sets``: node, label, size, shingle, n (unresolved nodes with the shingle).
    If two sets are similar, they share at least ``need`` shingles of the
    smaller, hence one of any ``size - need + 1`` of them.
    """
    need = F.ceil(
        F.col("size") * 2 * conf.percent / (100 + conf.percent) - 1e-9)
    rare = open_sets.where(F.col("n") <= conf.frequent)
    probes = rare.withColumn("place", F.row_number().over(
        Window.partitionBy("node").orderBy("n", "shingle"))
    ).where(F.col("place") <= F.col("size") - need + 1).select(
        "shingle", F.col("node").alias("a"), F.col("label").alias("label_a"),
        F.col("size").alias("size_a"))
    index = rare.select("shingle", F.col("node").alias("b"), F.col("label").alias("label_b"),
                        F.col("size").alias("size_b"))
    return probes.join(index, "shingle").where(
        (F.col("label_a") != F.col("label_b")) & (F.col("size_a") <= F.col("size_b"))
        & _sizes_fit(F.col("size_a"), F.col("size_b"), conf)
    ).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _frequent_pairs(open_sets: DataFrame, members: DataFrame, nodes: DataFrame,
                    conf: MinHash) -> DataFrame:
    """Pairs across components of a bucket where both sets consist of frequent
    shingles so far that they may be similar without sharing a rare one."""
    need = conf.percent / 100
    heavy = open_sets.groupBy("node", "label", "size").agg(
        F.count_if(F.col("n") > conf.frequent).alias("hot")
    ).where(F.col("hot") >= F.col("size") * need)
    counts = heavy.groupBy("label").agg(F.count(F.lit(1)).alias("in_label"))
    rows = (
        members.select("key", "node").join(heavy, "node").join(counts, "label")
        .join(nodes.select("node", "bands"), "node")
    )
    left = rows.select(*(F.col(c).alias(f"{c}_a") for c in rows.columns))
    right = rows.select(*(F.col(c).alias(f"{c}_b") for c in rows.columns))
    # The first band that the two share is the one where the pair is made.
    shared = F.coalesce(*(
        F.when(F.col("bands_a")[i] == F.col("bands_b")[i], F.col("bands_a")[i])
        for i in range(conf.bands)))
    bound = (F.col("size_a") + F.col("size_b")) * (conf.percent / (100 + conf.percent))
    return left.join(right, F.col("key_a") == F.col("key_b")).where(
        (F.col("label_a") != F.col("label_b"))
        # The component with fewer such nodes looks for partners in the other.
        & ((F.col("in_label_a") < F.col("in_label_b"))
           | ((F.col("in_label_a") == F.col("in_label_b"))
              & (F.col("label_a") < F.col("label_b"))))
        & _sizes_fit(F.col("size_a"), F.col("size_b"), conf)
        & (F.col("hot_a") + 1e-6 >= bound) & (F.col("hot_b") + 1e-6 >= bound)
        & (shared == F.col("key_a"))
    ).select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b"))


def near_duplicates(docs: DataFrame, conf: MinHash = MinHash()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each document.

    Sets of equal shingles are linked, and sets with at least ``percent`` of
    their union in common. A NULL or empty text, or one without words, has no
    shingles and is alone. Each row gives one row. Rows that repeat a
    ``doc_id`` are in one component; a row without ``doc_id`` is in none
    (``component_id`` NULL) and kept.
    """
    prints = written(fingerprints(docs, conf), "minhash-prints")
    groups = written(
        prints.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.max("n_shingles").alias("size"),
            F.min("minima").alias("minima"), F.min("bands").alias("bands")),
        "minhash-nodes")
    rows = groups.select("node", "size", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("fellows")).where("fellows > 1")
    members = written(rows.join(buckets, "key"), "minhash-members")
    nodes = written(groups.select("node", "minima", "bands").join(
        members.select("node").distinct(), "node", "left_semi"), "minhash-signatures")
    # The one shuffle that carries texts of all documents; from here on only those of members.
    whole = written(
        docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "text")
        .join(members.select("node").distinct(), "node", "left_semi"), "minhash-texts")
    stars = written(_similar(_hub_pairs(members, conf), nodes, whole, conf), "minhash-stars")
    labels = written(components(stars), "minhash-labels")

    labelled = _labelled(members, labels)
    mixed = labelled.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    unresolved = written(labelled.join(mixed, "key", "left_semi"), "minhash-unresolved")
    open_nodes = unresolved.select("node", "label", "size").distinct()
    hashes = written(per_batch(
        whole.join(open_nodes.select("node").distinct(), "node", "left_semi"),
        "node bigint, shingle bigint", lambda: functools.partial(_shingle_rows, words=conf.words)),
        "minhash-hashes")
    counts = hashes.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    open_sets = written(
        hashes.join(counts, "shingle").join(open_nodes, "node"), "minhash-open")
    more = _rare_pairs(open_sets, conf).union(
        _frequent_pairs(open_sets, unresolved, nodes, conf))
    late = _similar(more, nodes, whole, conf)
    # A document that repeats under one id with other words ties its sets together.
    own = prints.join(groups.select("digest", "node"), "digest").where(
        "doc_id IS NOT NULL").select("doc_id", "node").distinct()
    several = own.groupBy("doc_id").agg(
        F.min("node").alias("b"), F.max("node").alias("high")).where("b < high")
    repeated = own.join(several, "doc_id").select(F.col("node").alias("a"), "b")
    final = components(stars.union(late).union(repeated))
    return (
        prints.join(groups.select("digest", "node"), "digest", "left")
        .withColumn("node", F.coalesce("node", "doc_id"))
        .join(final, "node", "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
            .alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _shingle_rows(batch: pa.RecordBatch, words: int):
    for node, text in zip(batch.column("node").to_pylist(), texts(batch)):
        found = shingles(text, words)
        yield {"node": pa.array(np.full(len(found), node, np.int64)),
               "shingle": pa.array(found.view(np.int64))}


def one_of_each(docs: DataFrame, conf: MinHash = MinHash(words=5, percent=80)) -> DataFrame:
    """``docs`` with one document of each group of near duplicates.

    The one with the least ``doc_id`` stays, of rows that repeat an id the first by text,
    then by the other columns; rows without ``doc_id`` all stay.
    """
    ids = near_duplicates(docs, conf)
    gone = ids.where("NOT kept").select("doc_id").distinct()
    often = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    often = often.select("doc_id")
    stay = docs.join(written(gone, "minhash-gone"), "doc_id", "left_anti")
    first = Window.partitionBy("doc_id").orderBy("text", *(
        name for name, kind in docs.dtypes if name != "text" and "map<" not in kind))
    one = stay.join(often, "doc_id", "left_semi").withColumn(
        "_minhash_row", F.row_number().over(first)).where("_minhash_row = 1")
    return stay.join(often, "doc_id", "left_anti").select(docs.columns).union(
        one.select(docs.columns))
