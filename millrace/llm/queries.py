"""Each operator as a query over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    ann,
    byte_bpe,
    hmm,
    lexical_search,
    minhash,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    spelling,
    token_count,
    url_filter,
)
from millrace.llm.common import table, written

#: Where the public tokenizer files lie: the package that describes them has ``path(name)``.
COUNTING_VOCABULARY = "byte_bpe_50k.json"
ENCODING_RANKS = "byte_bpe_multi_50k.tiktoken"
PACKING_TOKENIZER = "word_bpe_49k.json"


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge_urls(pages).drop("url")


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return quality_rules.adaptive_quality(docs)


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = written(secret_scan.find(docs).drop("text"), "secret-candidates")
    return secret_scan.scan(found, secret_scan.fit(docs, found))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    public_tokenizers.path(COUNTING_VOCABULARY))


def byte_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"),
                            public_tokenizers.path(ENCODING_RANKS), public_tokenizers.PATTERN)


def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                        public_tokenizers.path(PACKING_TOKENIZER))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mix_sources,
    "op2_url_filters": url_filters,
    "op3_lm_scoring": lm_scoring,
    "op4_adaptive_quality": adaptive_quality,
    "op5_nearest_neighbours": nearest_neighbours,
    "op6_secret_scans": secret_scans,
    "op7_token_counts": token_counts,
    "op8_byte_bpe": byte_bpe_coding,
    "op9_quality_classifier": classify_quality,
    "op10_near_duplicates": near_duplicates,
    "op11_spelling_variants": spelling_variants,
    "op12_lexical_search": ranked_search,
    "op13_packing": pack_sequences,
}
