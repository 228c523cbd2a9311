"""One query for each numbered operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import byte_bpe, fingerprints, html_text, language_id, line_dedup, mixing, near_dedup, neighbours, piece_counts, prefix_trie, ranked_search, sharding, url_filter
from orderflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PIECE_MODEL = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"
RULES = [
    url_filter.Rule.of("block", "net/"),
    url_filter.Rule.of("allow", "example.net/en/"),
    url_filter.Rule.of("block", "example.com/de/"),
    url_filter.Rule.of("allow", "org/fr/"),
]
SHARDS = 8
ASKED_EVERY = 20


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_counts.with_token_counts(docs, public_tokenizers.path(PIECE_MODEL)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = language_id.with_language(docs.select("doc_id", "text"), language_id.fit(docs))
    return judged.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.with_main_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_near_counts(fingerprints.fingerprint_documents(table(spark, sf_dir, "documents")))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_probabilities(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", "probability", "sampled")


@query
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % ASKED_EVERY == 0))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.with_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.without_repeated_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
