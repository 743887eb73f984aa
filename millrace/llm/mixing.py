"""Mixing sources to target weights.

The words of a source form one stream, cut into blocks of fixed length. A
source's target gives its number of slots. Each slot draws its output shard, so that
a source's counts over the shards are one multinomial draw whose total is the
target; within a shard the sources mix as a multinomial draw with the target
shares would. Slots run through a pseudorandom permutation of the source's
block numbers, pass after pass, and take their block by a join on the number.

DataFrame functions only. Running totals go through two levels, buckets of a
digest and totals of buckets, so that no source has to fit one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, written

#: Weights of the sources in code point order, NULL last, repeating.
WEIGHTS = (5, 2, 1)


@dataclass(frozen=True)
class Mix:
    """What to mix. ``share`` is the size of the mix against all words, in percent."""

    weights: tuple[int, ...] = WEIGHTS
    share: int = 150
    most_passes: int = 2
    block_words: int = 512
    shard_slots: int = 1024
    seed: int = 17


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))


def _running_total(df: DataFrame, group: str, digest: str, order: list[str], value: Column,
                   name: str) -> DataFrame:
    """``df`` with the total of ``value`` over the rows of its group that come before,
    in the order of ``digest`` (then ``order``)."""
    bucketed = df.withColumn("_value", value).withColumn(
        "_bucket", F.substring(digest, 1, 3))
    inside = Window.partitionBy(group, "_bucket").orderBy(digest, *order)
    across = Window.partitionBy("_group").orderBy("_from")
    totals = (
        bucketed.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_from"))
        .agg(F.sum("_value").alias("_total"))
        .select("_group", "_from",
                (F.sum("_total").over(across) - F.col("_total")).alias("_before"))
    )
    return (
        bucketed.withColumn(
            "_inside", F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("_value"))
        .join(totals, F.col(group).eqNullSafe(F.col("_group"))
              & (F.col("_bucket") == F.col("_from")))
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_value", "_bucket", "_inside", "_group", "_from", "_before")
    )


def sized(docs: DataFrame, mix: Mix) -> DataFrame:
    """One narrow row per document: id, source, size in words, and a digest of its text."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("text").alias("text_hash"),
    ).withColumn("digest", _digest(F.lit(mix.seed), F.col("source"), F.col("doc_id")))


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Target of each source.

    All sources rise with one level, each at the speed of its weight; a source
    stops when it is full. That is the fixed point of sharing the excess again
    and again. Windows run over one row per source.
    """
    everything = Window.partitionBy()
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*map(F.lit, mix.weights))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    filled = Window.orderBy("_full_at", "_place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sources.withColumn("_place", place)
        .withColumn("weight", F.element_at(weights, F.col("_place") % len(mix.weights) + 1))
        .withColumn("_most", mix.most_passes * F.col("source_size"))
        .withColumn("_full_at", F.col("_most") / F.col("weight"))
        # 100 times the words that are left when those that fill up earlier are full.
        .withColumn("_left", mix.share * F.sum("source_size").over(everything)
                    - 100 * F.coalesce(F.sum("_most").over(filled), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(everything)
                    - F.coalesce(F.sum("weight").over(filled), F.lit(0)))
        .withColumn("_full", F.col("_most").cast("double") * 100 * F.col("_weights")
                    <= F.col("_left").cast("double") * F.col("weight"))
        .withColumn("_level", F.min(F.when(~F.col("_full"), F.struct("_full_at", "_place", (
            F.col("_left") / (100 * F.col("_weights"))).alias("level")))).over(everything))
        .select("source", "source_size", F.when(
            F.col("_full"), F.col("_most").cast("double"))
            .otherwise(F.col("_level.level") * F.col("weight")).alias("target"))
    )


def spans(sizes: DataFrame, goals: DataFrame, mix: Mix) -> DataFrame:
    """The mix: which words of which document each slot of each shard takes.

    Columns: ``shard``, ``draw`` (order within the shard), ``source``,
    ``doc_id``, ``size``, ``text_hash``, ``copy`` (of repeated rows),
    ``word_from`` and ``word_to`` (from 0, end excluded).
    """
    length = mix.block_words
    alike = Window.partitionBy("source", "doc_id", "size").orderBy("text_hash")
    placed = _running_total(
        sizes.where("size > 0").withColumn("copy", F.row_number().over(alike)),
        "source", "digest", ["size", "text_hash", "copy"], F.col("size"), "start")
    pieces = (
        placed.withColumn("block", F.explode(F.expr(
            f"sequence(start div {length}, (start + size - 1) div {length})")))
        .withColumn("piece_from", F.greatest("start", F.col("block") * length))
        .withColumn("piece_to", F.least(F.col("start") + F.col("size"),
                                        (F.col("block") + 1) * length))
    )
    goal = (
        goals.where("source_size > 0")
        .withColumn("blocks", F.expr(f"(source_size + {length - 1}) div {length}"))
        .withColumn("words", F.round("target").cast("bigint"))
        .withColumn("slots", F.expr(
            f"words div source_size * blocks + (words % source_size) div {length} + 2"))
        .withColumn("shards", F.ceil(
            F.sum("words").over(Window.partitionBy()) / (length * mix.shard_slots)))
    )
    # Numbers in two steps: a large source becomes many rows before it becomes slots.
    run = 4096

    def numbered(count: str) -> DataFrame:
        return (
            goal.withColumn("_run", F.explode(F.expr(f"sequence(0, ({count} - 1) div {run})")))
            .repartition("source", "_run")
            .withColumn("number", F.explode(F.expr(
                f"sequence(_run * {run}, least({count}, (_run + 1) * {run}) - 1)")))
            .drop("_run")
        )

    blocks = _running_total(
        numbered("blocks").select("source", "blocks", F.col("number").alias("block"))
        .withColumn("digest", _digest(F.lit(mix.seed), F.col("source"), F.col("block"))),
        "source", "digest", ["block"], F.lit(1).cast("bigint"), "position")
    last = blocks.where("block = blocks - 1").select(
        F.col("source").alias("_source"), F.col("position").alias("short_at"))
    slots = (
        numbered("slots").join(last, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("position", F.col("number") % F.col("blocks"))
        # Words that this pass has taken before; only the last block may be short.
        .withColumn("before", F.expr(
            f"number div blocks * source_size + position * {length} "
            f"- IF(position > short_at, blocks * {length} - source_size, 0)"))
        .withColumn("take", F.expr(f"least({length}, words - before)"))
        .where("take > 0")
        .select(F.col("source").alias("slot_source"), "number", "words", "take",
                F.col("position").alias("slot_position"), "shards")
    )
    drawn = slots.withColumn(
        # The draw, as digits of a digest: SQL can repeat it.
        "shard", F.conv(F.substring(_digest(
            F.lit(mix.seed), F.col("slot_source"), F.lit("slot"), F.col("number")), 1, 8), 16, 10)
        .cast("bigint") % F.col("shards")
    ).withColumn("draw", F.xxhash64(F.lit(mix.seed + 1), "slot_source", "number"))
    chosen = drawn.join(
        blocks.select("source", "block", "position"),
        F.col("slot_source").eqNullSafe(F.col("source"))
        & (F.col("slot_position") == F.col("position"))
    ).select("shard", "draw", "slot_source", F.col("block").alias("slot_block"), "take")
    return chosen.join(
        pieces, F.col("slot_source").eqNullSafe(F.col("source"))
        & (F.col("slot_block") == F.col("block"))
    ).withColumn("piece_to", F.least("piece_to", F.col("block") * length + F.col("take"))
    ).where("piece_to > piece_from").select(
        "shard", "draw", "source", "doc_id", "size", "text_hash", "copy",
        (F.col("piece_from") - F.col("start")).alias("word_from"),
        (F.col("piece_to") - F.col("start")).alias("word_to"))


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """How much of each document the mix takes: ``doc_id``, ``size``,
    ``source_size``, ``target`` (of its source), ``taken``, and ``n_shards``, the
    number of output shards that its words were drawn for.

    Each row of ``docs`` gives one row. NULL sources are one source; NULL and
    empty texts have no words, none of which are taken; rows with the same
    source, id and size are told apart by their texts, and equal rows by number.
    """
    sizes = written(sized(docs, mix), "mix-sizes")
    goals = written(targets(sizes, mix), "mix-targets")
    taken = spans(sizes, goals, mix).groupBy("source", "doc_id", "size", "copy").agg(
        F.sum(F.col("word_to") - F.col("word_from")).alias("taken"),
        F.size(F.collect_set("shard")).alias("n_shards"))
    alike = Window.partitionBy("source", "doc_id", "size").orderBy("text_hash")
    numbered = sizes.withColumn("copy", F.row_number().over(alike)).alias("d")
    same = " AND ".join(f"d.{c} <=> t.{c}" for c in ("source", "doc_id", "size", "copy"))
    return (
        numbered.join(taken.alias("t"), F.expr(same), "left")
        .join(goals.alias("g"), F.expr("d.source <=> g.source"))
        .select("d.doc_id", "d.size", "g.source_size", "g.target",
                F.coalesce("t.taken", F.lit(0)).cast("bigint").alias("taken"),
                F.coalesce("t.n_shards", F.lit(0)).cast("bigint").alias("n_shards"))
    )


def mixed_texts(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: one row per span, with the span's words as its text,
    the blanks between them kept, and ``n_chars`` of that text. The columns are
    those of ``documents``, others are left out. NULL and empty texts have no spans; NULL
    ids and sources stay NULL. Rows equal in source, id and text but for ``lang`` all carry
    the least, NULL before others."""
    sizes = written(sized(docs, mix), "mix-sizes")
    goals = written(targets(sizes, mix), "mix-targets")
    cuts = spans(sizes, goals, mix).groupBy("source", "doc_id", "text_hash").agg(
        F.collect_list(F.struct("word_from", "word_to")).alias("cuts")).alias("c")
    # Rows that are equal in source, id and text share one row with all their spans.
    whole = docs.groupBy("source", "doc_id", F.xxhash64("text").alias("text_hash")).agg(
        F.min(F.struct("text", "lang")).alias("doc")).alias("d")
    same = " AND ".join(f"d.{c} <=> c.{c}" for c in ("source", "doc_id", "text_hash"))
    worded = whole.join(cuts, F.expr(same)).select(
        "d.doc_id", "d.source", "d.doc.lang", "c.cuts",
        F.regexp_extract_all("d.doc.text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
        .alias("words"))
    cut = worded.select(
        "doc_id", "lang", "source",
        F.explode(F.expr("transform(cuts, c -> array_join(slice(words, int(c.word_from) + 1, "
                         "int(c.word_to - c.word_from)), ''))")).alias("text"))
    return cut.select("doc_id", "text", "lang", "source",
                      F.length("text").cast("bigint").alias("n_chars"))
