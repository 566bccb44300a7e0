"""The registered queries of this subpackage, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recoda.llm import (
    decontaminate,
    language,
    line_dedup,
    packing,
    prefix_trie,
    quality,
    ranked_search,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)
from recoda.llm.common import table

SHARDS, SEED = 40, 20240501
SEQUENCE, END_ID, TOKEN_LIMIT = 1024, 2, 2048
WINDOW = 10
SHINGLE, MAX_BITS = 4, 4
BEST = 10
# The URL rules (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), limit=TOKEN_LIMIT
    )


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS, SEED)
    return placed.drop("row_no")


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), SEQUENCE, END_ID
    )


def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=END_ID
    )


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), WINDOW
    )
    return found.drop("spans", "items")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)


def q_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(table(spark, sf_dir, "documents"))


def q_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def q_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), BEST)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": q_line_dedup,
    "op2_token_counts": q_token_counts,
    "op3_sharding": q_sharding,
    "op4_packing": q_packing,
    "op5_token_files": q_token_files,
    "op6_quality": q_quality,
    "op7_decontamination": q_decontamination,
    "op8_toxicity": q_toxicity,
    "op9_simhash": q_simhash,
    "op10_url_filter": q_url_filter,
    "op11_language": q_language,
    "op12_prefix_trie": q_prefix_trie,
    "op13_ranked_search": q_ranked_search,
}
