"""Quality rules whose thresholds follow the data.

Each document is measured once. Per language and source, a quantile sketch of
every ratio gives an upper fence; a document above a fence of its group is
rejected. The sketch is a histogram over log-linear buckets (five leading
bits, so 3 % relative error): it merges by adding counts, its size has a fixed
bound, and it does not depend on the order of rows or on retries.

A fence hangs on the lower half of its group only, so that junk in less than half of
it does not lift the fence. A group's sketch is blended with that of its language, which counts
as ``prior`` documents, and a language's with that of all: small groups follow their language
without a step. And no fence is over twice the one of the wider group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import per_batch, texts, written

#: Counted per document, all over its whole text.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper")
#: Ratios in thousandths that are fenced: name, numerator, denominator, least fence.
RATIOS = (
    ("symbol_ratio", "n_symbols", "word_chars", 50),
    ("upper_ratio", "n_upper", "word_chars", 250),
    ("dup_line_ratio", "n_dup_lines", "n_lines", 300),
    ("repeat_ratio", "n_repeat_words", "n_words", 150),
)
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_SYMBOL_BYTES = SYMBOLS.encode()
_UPPER_BYTES = bytes(range(ord("A"), ord("Z") + 1))
_BLANK_BYTES = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, first occurrences included.

    Windows get exact ids by doubling: ids of pairs, of fours, of eights.
    ``window`` is a power of two.
    """
    if len(words) <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    span = 1
    while span < window:
        pairs = ids[:-span] * (ids.max() + 1) + ids[span:]
        values, ids = np.unique(pairs, return_inverse=True)
        if len(values) == len(pairs):
            return 0
        span *= 2
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def measure_text(text: str) -> tuple[int, ...]:
    """The values of ``COUNTS``; all zero for an empty text."""
    data = text.encode()
    words = data.split()
    blanks = len(data) - len(data.translate(None, _BLANK_BYTES))
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    return (
        len(words), len(text) - blanks,
        len(data) - len(data.translate(None, _SYMBOL_BYTES)),
        len(lines) - len(set(lines)), repeated_words(words), len(lines),
        len(data) - len(data.translate(None, _UPPER_BYTES)),
    )


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``COUNTS``; columns of these names are replaced."""
    kept = [c for c in docs.columns if c not in COUNTS]
    schema = docs.select(kept).schema
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields),
                     *(f"{name} bigint" for name in COUNTS)])

    def make():
        def step(batch):
            counts = list(zip(*map(measure_text, texts(batch)))) or [()] * len(COUNTS)
            return {**{c: batch.column(c) for c in kept},
                    **{name: list(column) for name, column in zip(COUNTS, counts)}}
        return step

    return per_batch(docs.select(kept), ddl, make)


def _ratio(numerator: str, denominator: str) -> Column:
    return F.expr(f"coalesce(1000 * {numerator} div nullif({denominator}, 0), 0)")


def _bucket(ratio: Column | str) -> Column:
    """The lower end of a value's bucket: its five leading bits."""
    value = F.col(ratio) if isinstance(ratio, str) else ratio
    spare = F.greatest(F.lit(0), F.length(F.bin(value)) - 5)
    return value - value % F.pow(F.lit(2), spare).cast("bigint")


def sketches(counts: DataFrame) -> DataFrame:
    """Counts per group, ratio and bucket, for three widths of group: language and
    source, language, all. A wider sketch is the sum of the narrower ones."""
    narrow = counts.select(
        "lang", "source",
        F.explode(F.array(*(
            F.struct(F.lit(name).alias("ratio"), _bucket(_ratio(a, b)).alias("bucket"))
            for name, a, b, _ in RATIOS))).alias("m"),
    ).groupBy("lang", "source", "m.ratio", "m.bucket").agg(F.count(F.lit(1)).alias("n"))
    wide = [
        narrow.withColumn("width", F.lit(width))
        .withColumn("lang", F.col("lang") if width < 2 else F.lit(None).cast("string"))
        .withColumn("source", F.col("source") if width < 1 else F.lit(None).cast("string"))
        for width in range(3)
    ]
    return (wide[0].union(wide[1]).union(wide[2])
            .groupBy("width", "lang", "source", "ratio", "bucket").agg(F.sum("n").alias("n")))


#: A document in units of weight, so that shares of it are whole numbers.
UNIT = 1_000_000
REACH, MOST = 7, 2


def blended(sketch: DataFrame, width: int, keys: list[str], wider: DataFrame | None,
            wider_keys: list[str], prior: int) -> DataFrame:
    """Weights per bucket of the groups of one width: their own documents, and ``prior``
    documents spread as in the wider group."""
    own = sketch.where(F.col("width") == width).select(
        *keys, "ratio", "bucket", (F.col("n") * UNIT).alias("weight"))
    if wider is None:
        return own
    shares = wider.withColumn("share", F.floor(
        F.lit(float(UNIT)) * F.col("weight") / F.sum("weight").over(
            Window.partitionBy(*wider_keys, "ratio")))).select(
        *(F.col(k).alias(f"_{k}") for k in wider_keys), F.col("ratio").alias("_ratio"),
        "bucket", (prior * F.col("share")).cast("bigint").alias("weight"))
    groups = own.select(*keys, "ratio").distinct()
    same = F.col("ratio") == F.col("_ratio")
    for key in wider_keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return own.unionByName(groups.join(shares, same).select(*keys, "ratio", "bucket", "weight")
                           ).groupBy(*keys, "ratio", "bucket").agg(F.sum("weight").alias("weight"))


def upper_fences(weights: DataFrame, keys: list[str]) -> DataFrame:
    """Fence of each group and ratio: the median plus seven times its distance from the first
    quartile, and never less than the ratio's least fence above the median."""
    group = Window.partitionBy(*keys, "ratio")
    running = weights.withColumn("seen", F.sum("weight").over(group.orderBy("bucket"))).withColumn(
        "whole", F.sum("weight").over(group))
    least = F.expr("CASE ratio " + " ".join(
        f"WHEN '{name}' THEN {floor}" for name, _, _, floor in RATIOS) + " END")
    quartiles = running.groupBy(*keys, "ratio").agg(
        F.min(F.when(F.col("seen") * 4 >= F.col("whole"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("seen") * 2 >= F.col("whole"), F.col("bucket"))).alias("q2"))
    return quartiles.select(*keys, "ratio", F.greatest(
        F.col("q2") + REACH * (F.col("q2") - F.col("q1")), F.col("q2") + least).alias("fence"))


def _bounded(fences: DataFrame, wider: DataFrame, wider_keys: list[str]) -> DataFrame:
    bound = wider.select(*(F.col(k).alias(f"_{k}") for k in wider_keys),
                         F.col("ratio").alias("_ratio"), F.col("fence").alias("_most"))
    same = F.col("ratio") == F.col("_ratio")
    for key in wider_keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return fences.join(bound, same).withColumn(
        "fence", F.least("fence", MOST * F.col("_most"))).select(fences.columns)


def fences(sketch: DataFrame, prior: int) -> DataFrame:
    """One row per language and source (``_lang``, ``_source``) with its fences as a struct. NULL
    languages and sources are groups of their own. Works on sketches, a bounded number of rows per group."""
    narrow, middle = ["lang", "source"], ["lang"]
    every = blended(sketch, 2, [], None, [], prior)
    languages = blended(sketch, 1, middle, every, [], prior)
    groups = blended(sketch, 0, narrow, languages, middle, prior)
    widest = upper_fences(every, [])
    of_language = _bounded(upper_fences(languages, middle), widest, [])
    of_group = _bounded(upper_fences(groups, narrow), of_language, middle)
    fence = F.struct(*(F.max(F.when(F.col("ratio") == name, F.col("fence"))).alias(f"{name}_fence")
                       for name, *_ in RATIOS))
    return of_group.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(
        fence.alias("_fences"))


def judged(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``counts`` with ``base_failed`` and ``kept``."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    within = F.lit(True)
    for name, a, b, _ in RATIOS:
        within = within & (_bucket(_ratio(a, b)) <= F.col(f"_fences.{name}_fence"))
    return (
        counts.join(groups, F.col("lang").eqNullSafe(F.col("_lang"))
                    & F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & within)
        .drop("_lang", "_source", "_fences")
    )


def adaptive_quality(docs: DataFrame, prior: int = 200) -> DataFrame:
    """Counts and verdict of each document: ``doc_id``, ``COUNTS``, ``base_failed``, ``kept``.

    NULL and empty texts have no words and fail the base rule. Each row gives
    one row, repeated and NULL ids included.
    """
    counts = written(measured(docs.select("doc_id", "text", "lang", "source"))
                     .drop("text"), "quality-counts")
    groups = written(fences(written(sketches(counts), "quality-sketches"), prior),
                     "quality-fences")
    return judged(counts, groups).drop("lang", "source")


def quality_filter(docs: DataFrame, prior: int = 200) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns.

    Texts are measured twice, once for the thresholds and once beside the
    verdict, which is cheaper than sending every text through a join.
    """
    counts = measured(docs.select("text", "lang", "source")).drop("text")
    groups = written(fences(written(sketches(counts), "quality-sketches"), prior),
                     "quality-fences")
    verdicts = judged(measured(docs), groups)
    return verdicts.where("kept").select(docs.columns)
