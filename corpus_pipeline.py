"""Corpus preparation from documents to token ids: each stage is written as Parquet and read again as the next one's documents.

All but the last stage return the columns of documents. Defined results: a stage keeps every row that its operator doesn't
decide against, repeated rows and null columns included; see the operators for nulls, empty texts, ties and empty tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import byte_bpe, language_id, mixing, near_dedup
from orderflow.llm.queries import RANKS
from orderflow.session import ensure_checkpoint_dir



def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from the documents that are not held out."""
    judged = language_id.with_language(docs, language_id.fit(docs))
    return judged.where(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: fingerprints of three-word shingles, linked at three or fewer
    differing bits, as in op6."""
    return near_dedup.one_of_each(docs, words=near_dedup.WORDS, radius=near_dedup.RADIUS).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens by source, language and topic meet the target shares."""
    return mixing.with_probabilities(docs).where("sampled").select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids, n_tokens, and whether the ids decode to the text again, of every document."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = byte_bpe.with_ids(docs, path, pattern)
    return coded.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("token_ids", token_ids),
]
#: Parsing, fingerprints and raking can't be put in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
