"""The stages against plain versions of what they decide, on the smallest table and on messy rows."""

import base64
import random
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from orderflow.llm import mixing, near_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(1, "the cat sat on the mat by the door", "en", "a", 1), (1, "the cat sat on the mat by the door", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "b", 0), (4, "12 %", "en", "b", 1)]


def test_stages_decide_as_plain_versions_do(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "mixture", "token_ids"]
    first = corpus_pipeline.language(spark, docs, tiny)
    assert first.columns == names
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}
    second = corpus_pipeline.near_duplicates(spark, first, tiny)
    assert second.columns == names
    rows = {r.doc_id: r for r in near_dedup.near_duplicates(first).collect()}
    kept = sorted(r.doc_id for r in second.collect())
    assert kept == sorted({r.component_id for r in rows.values()})
    third = corpus_pipeline.mixture(spark, second, tiny)
    assert third.columns == names
    chances = mixing.with_probabilities(second)
    assert sorted(r.doc_id for r in third.collect()) == sorted(r.doc_id for r in chances.where("sampled").collect())
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in corpus_pipeline.token_ids(spark, third, tiny).collect():
        assert r.round_trip and r.ids == encoder.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids)


def test_run(spark, tiny):
    out = corpus_pipeline.run(spark, tiny)
    assert 0 < out.count() < 200 and out.where(~F.col("round_trip")).count() == 0


def test_messy_and_empty_rows(spark, tiny):
    for docs, counts in ((spark.createDataFrame(ROWS, SCHEMA), [2, 1, 1, 1]), (spark.createDataFrame([], SCHEMA), [0, 0, 0, 0])):
        for (_, stage), n in zip(corpus_pipeline.STAGES, counts, strict=True):
            docs = stage(spark, docs, tiny)
            assert docs.count() == n


def test_near_duplicates_equal_brute_force_simhash(spark, tiny):
    """Texts edited in many places: kept is the smallest id of each set of fingerprints linked at three bits."""
    rng, rows = random.Random(3), []
    for r in spark.read.parquet(f"{tiny}/documents.parquet").where("doc_id < 60").orderBy("doc_id").collect():
        words = r.text.split()[:400]
        rows.append((r.doc_id, " ".join(words)))
        for k, share in enumerate((0.002, 0.004, 0.012, 0.04)):
            rows.append((1000 * (k + 1) + r.doc_id, " ".join(f"w{rng.random()}" if rng.random() < share else w for w in words)))
    prints = {i: near_dedup.simhash(t) & (1 << 64) - 1 for i, t in rows}
    ids, root, linked = sorted(prints), {i: i for i in prints}, 0
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((root[a], root[b]))
                root, linked = {i: low if r == high else r for i, r in root.items()}, linked + 1
    assert linked > 50
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, tiny).collect()}
    assert kept == set(root.values())
