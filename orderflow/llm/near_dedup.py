"""Near-duplicate documents: 64-bit SimHash of word shingles, linked at few differing bits by pivot distances.

Every distinct fingerprint gets a row of Hamming distances to reference fingerprints, the pivots: zero and,
for each block of two bits, the fingerprint with just that block set. By the triangle inequality the distances of
two fingerprints to any pivot differ by no more than the fingerprints do. Distances to zero and to a block
together say how many bits of the block are set, its coordinate. Few differing bits change few coordinates, so of GROUPS
groups of blocks at least GROUPS - RADIUS agree: fingerprints are brought together by the coordinates of each choice
of so many groups. Pairs that meet are discarded by their largest coordinate difference over all pivots and
verified by their bits.

Keys with at most FEW fingerprints are joined. Larger ones are cut into blocks of about BLOCK fingerprints, and each
pair of blocks is one task's work in numpy, of which only links that join something new there come out: never all pairs
of a group, and no group whole in one task. Links then make connected components.

Defined results: words are split at ASCII white space of the text with A-Z lower-cased; fewer words than ``words`` are one
shingle; null and wordless texts have fingerprint zero and are linked like any other. A null doc_id is kept; it counts as
a component's smallest only where there is no other. Repeated rows are kept, with equal results. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderflow.llm.common import or_empty, pieces
from orderflow.llm.components import components
from orderflow.session import pin

WORDS, SEED, RADIUS = 3, 42, 3
BLOCK_BITS, GROUPS = 2, 6
FEW, BLOCK = 16, 1024
SHINGLES_AT_ONCE = 100_000


def shingle_hashes(text: str, words: int = WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """The hashes of all shingles, at most SHINGLES_AT_ONCE together."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not parts:
        return
    whole = b" ".join(parts)
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(length + 1) - 1
    start = end - length
    if len(parts) > words:
        start, end = start[: 1 - words or None], end[words - 1 :]
    else:
        start, end = start[:1], end[-1:]
    spans = zip(start.tolist(), end.tolist(), strict=True)
    while some := [xxh64_intdigest(whole[a:b], seed) for a, b in islice(spans, SHINGLES_AT_ONCE)]:
        yield np.array(some, "<u8")


def majority(hashes: Iterable[np.ndarray]) -> int:
    votes, n = np.zeros(64, np.int64), 0
    for some in hashes:
        bits = np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
        n += len(some)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def simhash(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint: the bits set in over half the shingle hashes."""
    return majority(shingle_hashes(text, words, seed))


def fingerprint(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([simhash(t, words, seed) for t in batch], dtype="int64")

    return hashed(text)


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


#: The block pivots; the pivot zero comes before them.
PIVOTS = [signed(((1 << BLOCK_BITS) - 1) << at) for at in range(0, 64, BLOCK_BITS)]


def distances(fp: Column) -> Column:
    """Hamming distances to zero and to each block pivot."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("tinyint") for p in [0, *PIVOTS]])


def distance_table(fp: np.ndarray) -> np.ndarray:
    """The same for an array of fingerprints, one row each."""
    pivots = np.array([0, *PIVOTS], np.int64)
    # Counted unsigned: of a negative number numpy counts the bits of its absolute value.
    return np.bitwise_count((fp[:, None] ^ pivots[None, :]).view(np.uint64)).astype(np.int8)


def coordinate_keys(table: np.ndarray, radius: int = RADIUS, groups: int = GROUPS) -> np.ndarray:
    """One key for each choice of groups that must agree, from a distance table: the choice's number and
    the coordinates of its groups."""
    # Set bits of block b: (distance to zero - distance to its pivot + bits of the block) / 2.
    set_bits = (table[:, :1].astype(np.int64) - table[:, 1:] + BLOCK_BITS) // 2
    parts = []
    for blocks in np.array_split(np.arange(len(PIVOTS)), groups):
        parts.append(set_bits[:, blocks] @ (BLOCK_BITS + 1) ** np.arange(len(blocks)))
    size = (BLOCK_BITS + 1) ** -(-len(PIVOTS) // groups)
    keys = []
    for n, chosen in enumerate(combinations(range(groups), groups - radius)):
        key = np.full(len(table), n, np.int64)
        for g in chosen:
            key = key * size + parts[g]
        keys.append(key)
    return np.stack(keys, axis=1)


def keys_of(fp: Column, radius: int = RADIUS) -> Column:
    @F.pandas_udf("array<long>")
    def keyed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(coordinate_keys(distance_table(batch.to_numpy(np.int64)), radius)), dtype=object)

    return keyed(fp)


def block_links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links within ``left``, or between ``left`` and ``right``, that join something new."""
    every = left if right is None else np.concatenate((left, right))
    root = list(range(len(every)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ours, theirs = distance_table(left), distance_table(left if right is None else right)
    other, shift, out = (left, 0, []) if right is None else (right, len(left), [])
    for i in range(len(left)):
        near = np.flatnonzero(np.abs(theirs[:, 0] - ours[i, 0]) <= radius)
        if right is None:
            near = near[near > i]
        near = near[np.abs(theirs[near] - ours[i]).max(axis=1, initial=0) <= radius]
        near = near[np.bitwise_count((other[near] ^ left[i]).view(np.uint64)) <= radius]
        for j in near.tolist():
            a, b = find(i), find(j + shift)
            if a != b:
                root[a] = b
                out.append((int(left[i]), int(other[j])))
    return out


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) of ``prints`` (distinct fp): links enough to connect all that differ in at most ``radius`` bits."""
    keyed = prints.select("fp", F.explode(keys_of(F.col("fp"), radius)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = pin(keyed.join(sizes, "key"))

    a, b = (met.where(F.col("n") <= FEW).select("key", F.col("fp").alias(x), distances(F.col("fp")).alias(f"d_{x}")) for x in "uv")
    pairs = a.join(b, "key").where("u < v")
    apart = F.greatest(*[F.abs(F.col("d_u")[k] - F.col("d_v")[k]) for k in range(len(PIVOTS) + 1)])
    small = pairs.where(apart <= radius).where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius).select("u", "v")

    def linked(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        i, j = key[1], key[2]
        fp, block = group["fp"].to_numpy(np.int64), group["block"].to_numpy()
        found = block_links(fp, None, radius) if i == j else block_links(fp[block == i], fp[block == j], radius)
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    large = met.where(F.col("n") > FEW).select("key", "fp", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"), blocks.alias("blocks"))
    large = large.select("key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    large = large.select("key", "fp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return small.unionByName(large.groupBy("key", "i", "j").applyInPandas(linked, "u long, v long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id, text_hash (xxhash64 of the text) and label (the component's least
    fingerprint, which tells components apart also where they have the same smallest doc_id or none) for every row."""
    rows = pin(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(or_empty(text), words).alias("fp"), F.xxhash64(or_empty(text)).alias("text_hash")))
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    joined = components(links(prints.select("fp"), radius))
    labelled = prints.join(joined, prints.fp == joined.node, "left").select(
        "fp", "first", F.coalesce("least", "fp").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    known = labelled.join(least, "label").select("fp", "component_id", "label")
    return rows.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash", "label"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component: the smallest doc_id, nulls last, and of its texts that of the least hash."""
    found = near_duplicates(docs, doc_id, text, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    kept = found.groupBy("label").agg(first.alias("first")).select("first._id", "first._hash")
    hashed = docs.withColumn("_text_hash", F.xxhash64(or_empty(text)))
    rows = hashed.join(kept, hashed[doc_id].eqNullSafe(kept["_id"]) & (hashed["_text_hash"] == kept["_hash"]), "left_semi")
    return rows.dropDuplicates([doc_id, "_text_hash"]).drop("_text_hash")
