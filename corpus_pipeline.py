"""Documents to training tokens: quality rules, one of each near duplicate, secrets
removed, sources mixed, texts encoded.

Each stage takes the documents that its predecessor kept, as a written table,
and returns documents; the last returns the encoded mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import byte_bpe, minhash, mixing, quality_rules, secret_scan
from millrace.llm.common import table, written
from millrace.llm.queries import ENCODING_RANKS

#: Pieces that an encoding worker keeps; it shares its memory with what earlier stages left.
REMEMBERED = 300_000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the thresholds of their language and source."""
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with four fifths of its five-word shingles in common."""
    return minhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    found = written(secret_scan.find(docs), "secret-candidates")
    return secret_scan.redact(found, secret_scan.fit(docs, found))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of documents, as many words of each source as its target."""
    return mixing.mixed_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each span, and the digest of the bytes they decode to."""
    import public_tokenizers

    return byte_bpe.encode_decode(
        docs, public_tokenizers.path(ENCODING_RANKS), public_tokenizers.PATTERN,
        ("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"), REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]

#: A forest and byte-pair merges are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
