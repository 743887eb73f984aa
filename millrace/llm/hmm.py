"""LM scoring with a hidden Markov model.

Latent states emit word classes. A frequent word is a class of its own; the
others share classes by their last bytes and are told apart within the class
by their counts. Baum-Welch adds up expected counts per task and over tasks, and
the scaled forward recursion gives the exact likelihood of a text.

What is kept of the vocabulary in one place is bounded by ``frequent``; counts
of all other words stay in a table and meet the texts by a join.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import crc_remainder, per_batch, slices, written

#: The end of a text. No word is empty.
END = b""


@dataclass(frozen=True)
class HmmConf:
    """``frequent``: at most so many words have a class of their own. ``shapes``: classes of the others.
    ``passes``: the most passes, all of them over all training texts; they end when
    one gains less than ``settled`` nats a token. ``smoothing``:
    how many tokens of the corpus mean each state is given. ``kinds`` and ``profile``:
    texts are grouped by the one of so many frequent words that marks them most, and
    compared by so many sums of classes."""

    states: int = 6
    frequent: int = 49_152
    shapes: int = 2048
    passes: int = 14
    smoothing: float = 200.0
    seed: int = 1
    settled: float = 0.005
    kinds: int = 2048
    profile: int = 128


def words_of(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts in their order, and how many each text has."""
    low = pc.ascii_lower(pc.fill_null(column, ""))
    split = pc.ascii_split_whitespace(low)
    # Blanks at either end leave an empty word there.
    words, ends = split.flatten().cast(pa.binary()), split.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    return words.filter(full).dictionary_encode(), np.diff(before[ends])


def shape(word: bytes, conf: HmmConf) -> int:
    """The class of a word that is not frequent: a hash of its last three bytes."""
    return zlib.crc32(word[-3:]) % conf.shapes


@dataclass(frozen=True)
class Corpus:
    """Counts of the training texts: tokens, different tokens, the frequent words with
    their counts, and the mass (counts plus one, plus one for unknown words) of each shape."""

    tokens: int
    different: int
    frequent: dict[bytes, int]
    counts: np.ndarray
    shape_mass: np.ndarray


def count_words(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` over the training texts, ends included."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 32_000_000):
                words, _ = words_of(part.column("text"))
                n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([words.dictionary, pa.array([END], pa.binary())]),
                     pa.array(np.append(n, part.num_rows), pa.int64())], names=["word", "n"])

    counted = docs.where("NOT held_out").select("text").mapInArrow(run, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def corpus_of(counts: DataFrame, conf: HmmConf) -> Corpus:
    """What the tasks need of the counts. Bounded by ``frequent`` and ``shapes``."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       F.count(F.lit(1)).alias("v")).first()
    top = frequent_words(counts, conf.frequent)
    frequent = {bytes(r["word"]): i for i, r in enumerate(top)}
    # Words that are not frequent, by shape: all words less the frequent ones.
    shaped = counts.groupBy(
        F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(conf.shapes)).alias("shape")
    ).agg(F.sum(F.col("n") + 1).alias("mass")).collect()
    mass = np.ones(conf.shapes)
    for row in shaped:
        mass[row["shape"]] += row["mass"]
    for row in top:
        mass[shape(bytes(row["word"]), conf)] -= row["n"] + 1
    return Corpus(total["n"], total["v"], frequent,
                  np.array([r["n"] for r in top], np.int64), mass)


def frequent_words(counts: DataFrame, most: int) -> list:
    """The end, then words by falling count: of whole steps of counts as many as ``most`` holds.

    The steps (a sixty-fourth of an octave) are counted first, so that no more than ``most``
    rows leave the tasks in all.
    """
    step = F.floor(F.log2("n") * 64)
    words = counts.where(F.length("word") > 0)
    cut, held = None, 1
    for row in sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True):
        held += row["count"]
        if held > most:
            break
        cut = row["step"]
    kept = words.where(step >= cut if cut is not None else F.lit(False))
    rows = kept.union(counts.where(F.length("word") == 0)).collect()
    return sorted(rows, key=lambda r: (len(r["word"]) > 0, -r["n"], bytes(r["word"])))


def _from_zero(ends: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], ends)).astype(np.int32)


class _Coder:
    """Classes of different words."""

    def __init__(self, corpus: Corpus, conf: HmmConf):
        self.frequent = pa.array(list(corpus.frequent), pa.binary())
        self.conf, self.shapes = conf, {}

    def classes(self, words: pa.Array) -> np.ndarray:
        known = pc.index_in(words, value_set=self.frequent)
        classes = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int32)
        # The last three bytes make the shape: few differ.
        last = pc.binary_slice(words.filter(known.is_null()), -3).dictionary_encode()
        shapes = [shape(end, self.conf) for end in last.dictionary.to_pylist()]
        classes[classes < 0] = len(self.frequent) + np.array(shapes, np.int32)[last.indices.to_numpy()]
        return classes


def encode(docs: DataFrame, corpus: Corpus, conf: HmmConf) -> DataFrame:
    """Per document: a row number, its classes (int32, end included) and its rare words."""
    held = docs.sparkSession.sparkContext.broadcast(corpus)
    of_rare = [pa.field("word", pa.binary()), pa.field("times", pa.int64())]

    def run(batches):
        from pyspark import TaskContext

        known = held.value
        coder, first = _Coder(known, conf), len(known.frequent)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 4_000_000):
                words, n_words = words_of(part.column("text"))
                indices, different = words.indices.to_numpy(), len(words.dictionary)
                classes, n_docs = coder.classes(words.dictionary), part.num_rows
                text_of = np.repeat(np.arange(n_docs), n_words)
                codes = np.zeros(len(indices) + n_docs, np.int32)
                ends = np.cumsum(n_words + 1)
                # The end goes behind the words of each text.
                codes[np.arange(len(indices)) + text_of] = classes[indices]
                codes[ends - 1] = known.frequent.get(END, first + shape(END, conf))
                scarce = np.flatnonzero(classes[indices] >= first)
                rare, times = np.unique(
                    text_of[scarce] * different + indices[scarce], return_counts=True)
                of_text, rare = np.divmod(rare, max(different, 1))
                rare_ends = np.searchsorted(of_text, np.arange(n_docs), "right")
                counted = pa.StructArray.from_arrays(
                    [words.dictionary.take(pa.array(rare)), pa.array(times, pa.int64())],
                    fields=of_rare)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"),
                     pa.array(row + np.arange(n_docs), pa.int64()),
                     pa.array(n_words + 1, pa.int64()),
                     pa.Array.from_buffers(pa.binary(), n_docs, [
                         None, pa.py_buffer(_from_zero(4 * ends)), pa.py_buffer(codes)]),
                     pa.ListArray.from_arrays(pa.array(_from_zero(rare_ends)), counted)],
                    names=["doc_id", "held_out", "row", "n_tokens", "codes", "rare"])
                row += n_docs

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, row bigint, n_tokens bigint, codes binary, "
             "rare array<struct<word: binary, times: bigint>>")


@dataclass(frozen=True)
class Hmm:
    """Start (K), transitions (K x K) and emissions (classes x K)."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


@dataclass
class Expected:
    """Expected counts and the log likelihood, which add up over documents and tasks."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray
    likelihood: float = 0.0


class _TimeMajor:
    """Documents side by side, longest first: step ``t`` holds the ``t``-th token of
    every document that has one, so that the running ones are a prefix."""

    def __init__(self, docs: list[np.ndarray]):
        lengths = np.array([len(d) for d in docs])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        steps = int(lengths[0]) if len(lengths) else 0
        self.active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps), "right")
        self.at = np.concatenate(([0], np.cumsum(self.active)))
        place = np.concatenate([np.arange(n) for n in lengths]) if len(lengths) else []
        column = np.repeat(np.arange(len(lengths)), lengths)
        self.codes = np.empty(int(lengths.sum()), np.int32)
        if len(docs):
            self.codes[self.at[place] + column] = np.concatenate([docs[i] for i in self.order])


def forward(
    model: Hmm, packed: _TimeMajor
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Emissions and scaled forward variables (states x positions), scales by position, and the
    natural log likelihood of each document, in packed order. Works in the model's precision."""
    emits = np.take(model.emits.T, packed.codes, axis=1)
    alpha, scale = np.empty_like(emits), np.empty(emits.shape[1], emits.dtype)
    into = np.ascontiguousarray(model.moves.T)
    at, before = packed.at.tolist(), 0
    for t, n in enumerate(packed.active.tolist()):
        a = at[t]
        now, total = alpha[:, a:a + n], scale[a:a + n]
        if t:
            np.matmul(into, alpha[:, before:before + n], out=now)
            now *= emits[:, a:a + n]
        else:
            np.multiply(model.start[:, None], emits[:, :n], out=now)
        np.add.reduce(now, axis=0, out=total)
        now /= total
        before = a
    logs, likelihood = np.log(scale.astype(np.float64)), np.zeros(len(packed.order))
    for a, n in zip(at, packed.active.tolist()):
        likelihood[:n] += logs[a:a + n]
    return emits, alpha, scale, likelihood


def expect(model: Hmm, packed: _TimeMajor, into: Expected) -> None:
    """Add the expected counts of some documents: one forward and one backward pass."""
    if not len(packed.codes):
        return
    emits, alpha, scale, likelihood = forward(model, packed)
    into.likelihood += float(likelihood.sum())
    # What a position contributes to the one before it: emission over scale, times backward.
    emits /= scale
    ahead, back = np.empty_like(emits), np.ones_like(emits)
    at, active = packed.at.tolist(), packed.active.tolist()
    for t in range(len(active) - 1, 0, -1):
        a, c, m = at[t - 1], at[t], active[t]
        np.multiply(emits[:, c:c + m], back[:, c:c + m], out=ahead[:, c:c + m])
        np.matmul(model.moves, ahead[:, c:c + m], out=back[:, a:a + m])
    first = active[0]
    # The position before each one: documents keep their column from step to step.
    earlier = np.arange(first, len(packed.codes)) - np.repeat(
        packed.active[:-1], packed.active[1:])
    into.moves += model.moves * (np.take(alpha, earlier, axis=1) @ ahead[:, first:].T)
    back *= alpha
    into.start += back[:, :first].sum(1)
    for k, share in enumerate(back):
        into.emits[:, k] += np.bincount(packed.codes, share, len(into.emits))


def _nothing(conf: HmmConf, classes: int) -> Expected:
    k = conf.states
    return Expected(np.zeros(k), np.zeros((k, k)), np.zeros((k, classes)).T)


def _maximise(found: Expected, mean: np.ndarray, conf: HmmConf) -> Hmm:
    """The next model; every state leans on the corpus mean of the classes a little."""
    start = found.start + 1.0
    moves = found.moves + 1.0
    emits = found.emits + conf.smoothing * mean[:, None]
    return Hmm(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def _groups(docs: list[np.ndarray], most_tokens: int = 800_000):
    """Documents of similar length, in runs of bounded size."""
    run, tokens = [], 0
    for i in np.argsort([-len(d) for d in docs], kind="stable"):
        run.append(int(i))
        tokens += len(docs[i])
        if tokens >= most_tokens:
            yield run
            run, tokens = [], 0
    if run:
        yield run


def _codes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(c, np.int32) for c in batch.column("codes").to_pylist()]


def _profiles(docs: list[np.ndarray], conf: HmmConf) -> np.ndarray:
    """Sums of classes of each document."""
    out = np.zeros((len(docs), conf.profile))
    for i, d in enumerate(docs):
        out[i] = np.bincount(d % conf.profile, minlength=conf.profile)
    return out


def _directions(profiles: np.ndarray) -> np.ndarray:
    roots = np.sqrt(profiles)
    return roots / np.maximum(np.linalg.norm(roots, axis=1, keepdims=True), 1e-9)


def kind_of(codes: np.ndarray, mean: np.ndarray, most: int) -> int:
    """The frequent word that a document has more of than the corpus by the most
    information; -1 if it has none. The end (class 0) marks nothing."""
    n = np.bincount(codes[(codes > 0) & (codes < most)])
    own = np.flatnonzero(n)
    n = n[own]
    gain = n * np.log(n / (len(codes) * mean[own]))
    return int(own[np.argmax(gain)]) if len(own) and gain.max() > 0 else -1


def seeds(encoded: DataFrame, mean: np.ndarray, first: int, conf: HmmConf) -> np.ndarray:
    """Profiles of kinds of text far apart, one per state, of all training texts.

    What comes to the driver is a sum per kind and part of the profile. Kinds of fewer
    tokens than each state is given anyway are left to the passes.
    """
    most = min(conf.kinds, first)
    held = encoded.sparkSession.sparkContext.broadcast(mean[:most])

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            docs = _codes(batch)
            for d, profile in zip(docs, _profiles(docs, conf)):
                kind = kind_of(d, held.value, most)
                sums[kind] = sums[kind] + profile if kind in sums else profile
        for kind, profile in sums.items():
            parts = np.flatnonzero(profile)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(parts), kind, np.int64)), pa.array(parts.astype(np.int64)),
                 pa.array(profile[parts])], names=["kind", "part", "n"])

    summed = encoded.where("NOT held_out").select("codes").mapInArrow(
        run, "kind bigint, part bigint, n double").groupBy("kind", "part").agg(
        F.sum("n").alias("n")).collect()
    held.unpersist()
    place = {kind: i for i, kind in enumerate(sorted({r["kind"] for r in summed}))}
    profiles = np.zeros((len(place), conf.profile))
    for row in summed:
        profiles[place[row["kind"]], row["part"]] = row["n"]
    tokens = profiles.sum(1)
    if (tokens >= conf.smoothing).any():
        profiles, tokens = (x[tokens >= conf.smoothing] for x in (profiles, tokens))
    ways, chosen = _directions(profiles), []
    nearest = np.zeros(len(ways))
    for _ in range(min(conf.states, len(ways))):
        chosen.append(int(np.argmin(nearest)) if chosen else int(np.argmax(tokens)))
        nearest = np.maximum(nearest, ways @ ways[chosen[-1]])
    return ways[chosen]


def _summed(encoded: DataFrame, add, conf: HmmConf, classes: int) -> Expected:
    """What ``add(docs, found)`` adds up over all training texts: in each task, then by class."""
    k = conf.states

    def run(batches):
        found = _nothing(conf, classes)
        for batch in batches:
            add(_codes(batch), found)
        used = np.flatnonzero(found.emits.any(1))
        # Classes first, then the start (-1), the transitions (-2 and below) and the likelihood.
        keys = np.concatenate((used, [-1], -2 - np.arange(k + 1)))
        rows = np.vstack((found.emits[used], found.start, found.moves,
                          np.full(k, found.likelihood)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), *(pa.array(rows[:, j]) for j in range(k))],
            names=["key", *(f"s{j}" for j in range(k))])

    parts = encoded.where("NOT held_out").select("codes").mapInArrow(
        run, "key bigint, " + ", ".join(f"s{j} double" for j in range(k)))
    summed = parts.groupBy("key").agg(
        *(F.sum(f"s{j}").alias(f"s{j}") for j in range(k))).toArrow()
    found = _nothing(conf, classes)
    keys = summed.column("key").to_numpy()
    values = np.column_stack([summed.column(f"s{j}").to_numpy() for j in range(k)])
    found.emits[keys[keys >= 0]] = values[keys >= 0]
    for key, row in zip(keys[keys < 0].tolist(), values[keys < 0]):
        if key == -1:
            found.start = row
        elif key == -2 - k:
            found.likelihood = float(row[0])
        else:
            found.moves[-2 - key] = row
    return found


def one_pass(encoded: DataFrame, model: Hmm, conf: HmmConf) -> Expected:
    """Expected counts over all training texts. Passes work in single precision and add up in
    double; a text's own likelihood is in double throughout."""
    held = encoded.sparkSession.sparkContext.broadcast(Hmm(*(
        part.astype(np.float32) for part in (model.start, model.moves, model.emits))))

    def add(docs, found):
        for group in _groups(docs):
            expect(held.value, _TimeMajor([docs[i] for i in group]), found)

    found = _summed(encoded, add, conf, len(model.emits))
    held.unpersist()
    return found


def start_of(encoded: DataFrame, mean: np.ndarray, first: int, conf: HmmConf) -> Hmm:
    """A start from all training texts: each goes to the state of the nearest seed."""
    ways = seeds(encoded, mean, first, conf)

    def add(docs, found):
        if not len(docs) or not len(ways):
            return
        homes = np.argmax(_directions(_profiles(docs, conf)) @ ways.T, 1)
        for home in np.unique(homes):
            codes = np.concatenate([d for d, h in zip(docs, homes) if h == home])
            found.emits[:, home] += np.bincount(codes, minlength=len(mean))

    begin = _summed(encoded, add, conf, len(mean))
    begin.moves += np.eye(conf.states) * 50
    noise = np.random.default_rng(conf.seed).random((len(mean), conf.states))
    begin.emits += noise * mean[:, None] * 10
    return _maximise(begin, mean, conf)


def fit(encoded: DataFrame, corpus: Corpus, conf: HmmConf) -> Hmm:
    """Baum-Welch over all training texts, until the likelihood settles."""
    mean = np.concatenate((corpus.counts + 1.0, corpus.shape_mass))
    mean /= mean.sum()
    model = start_of(encoded, mean, len(corpus.frequent), conf)
    before = -math.inf
    for _ in range(conf.passes):
        found = one_pass(encoded, model, conf)
        model = _maximise(found, mean, conf)
        if found.likelihood - before < conf.settled * max(corpus.tokens, 1):
            break
        before = found.likelihood
    return model


def score(docs: DataFrame, conf: HmmConf = HmmConf()) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` of each document.

    Texts whose crc32 of ``doc_id`` modulo 7 is not 2 teach the model; a row
    without ``doc_id`` teaches and is not held out. NULL and empty texts are
    one token, the end. Each row gives one row. If nothing teaches, every word is
    unknown and both scores are finite.
    """
    spark: SparkSession = docs.sparkSession
    marked = docs.select("doc_id", "text", F.coalesce(
        crc_remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"))
    counts = written(count_words(marked), "hmm-counts")
    corpus = corpus_of(counts, conf)
    encoded = written(encode(marked, corpus, conf), "hmm-encoded")
    model = fit(encoded, corpus, conf)
    first = len(corpus.frequent)
    logs = np.zeros(first + conf.shapes)
    logs[:first] = np.log10(corpus.counts + 1.0)
    # log10 of a class: what a word's own share of it is divided by.
    share = np.concatenate((np.zeros(first), np.log10(corpus.shape_mass)))
    normal = math.log10(corpus.tokens + corpus.different + 1)
    held = spark.sparkContext.broadcast((model, logs, share))

    def make():
        model, logs, share = held.value

        def step(batch):
            docs = _codes(batch)
            likelihood = np.zeros(len(docs))
            for group in _groups(docs):
                packed = _TimeMajor([docs[i] for i in group])
                *_, found = forward(model, packed)
                likelihood[np.array(group)[packed.order]] = found
            return {
                "row": batch.column("row"),
                "likelihood": pa.array(likelihood / math.log(10)),
                "frequent_log": [float(logs[d].sum()) for d in docs],
                "class_log": [float(share[d].sum()) for d in docs],
                "frequent_known": [int((d < first).sum()) for d in docs],
            }
        return step

    columns = ("row bigint, likelihood double, frequent_log double, class_log double, "
               "frequent_known bigint")
    scored = per_batch(encoded.select("row", "codes"), columns, make)
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    known = rare.join(counts, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log"),
        F.sum("times").alias("rare_known"))
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    log_counts = F.col("frequent_log") + rare_log
    return (
        encoded.select("row", "doc_id", "held_out", "n_tokens")
        .join(scored, "row").join(known, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("frequent_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(corpus.tokens).cast("bigint").alias("train_tokens"),
            (log_counts - F.col("n_tokens") * normal).alias("base_score"),
            (rare_log - F.col("class_log") + F.col("likelihood")).alias("score"))
    )
