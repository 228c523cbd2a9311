"""Lines that many documents share, found by probing a sharded minimal perfect hash instead of joining lines.

One pass turns each line into two 64-bit hashes of its key; Spark counts documents and the largest doc_id by key. Keys of
enough documents are dealt to shards of about SHARD_KEYS by their first hash, and each shard is one task's minimal perfect
hash: levels of bits in which a key that is alone at its place takes it, the others going on to the next level. The rank of
its bit is the key's place in three plain arrays: fingerprint (the second hash), count and largest doc_id. A second pass
hashes the lines of each document again and looks them up; a line not in the index fails the fingerprint.

Arrays of at most ``broadcast_bytes`` (counted first) go to the executors once. Beyond that lines travel to the shards as
hashes, cut into groups of at most PROBES by the counted lines of each shard, so that a line held by a third of all
documents is spread over many tasks; only places of dropped lines come back and are joined to their documents.

Defined results: a line's key is the line without ASCII white space at both ends, A-Z lower-cased. A document is a doc_id;
rows with one doc_id count once and keep or lose a line together, and rows without an id are one document below all others. Null and
empty texts are one empty line. Only the text is changed; repeated rows stay. Empty table: no rows. All columns are
kept, of equal names the made one stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keep_names, or_empty, pieces
from orderflow.session import pin

LEAST_CHARS, LEAST_DOCS = 20, 3
SHARD_KEYS, BROADCAST_BYTES, PROBES = 1 << 16, 64 << 20, 1 << 20
#: Bits of a level for each key still without a place.
GAMMA = 2
SPACE = " \t\n\x0b\x0c\r"
LINES_AT_ONCE = 200_000
SHARD = "shard int, n long, sizes array<long>, bits binary, prints binary, counts binary, owned binary, owners binary"
#: Bytes of a key in the index: fingerprint, count, flag and largest doc_id, and its bits.
KEY_BYTES = 8 + 4 + 1 + 8 + 1


def key_hashes(line: str, least: int = LEAST_CHARS) -> int | None:
    """128 bits of the line's key; None for keys that are too short."""
    key = line.strip(SPACE)
    return xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass").lower()) if len(key) >= least else None


def halves(hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(h.to_bytes(16, "little") for h in hashes), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Another hash of 64-bit hashes for each level."""
    x = keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


@dataclass
class PerfectHash:
    """Places 0 .. n - 1 of n distinct 64-bit hashes; other hashes get any place or none (-1)."""

    sizes: list[int]
    bits: np.ndarray  # bool, all levels one after the other
    ranks: np.ndarray

    @classmethod
    def stored(cls, sizes: list[int], bits: np.ndarray) -> "PerfectHash":
        return cls(sizes, bits, np.concatenate(([0], np.cumsum(bits))))

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, levels = [], []
        while len(keys):
            size = GAMMA * len(keys) + 1
            at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls.stored(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def places(self, keys: np.ndarray) -> np.ndarray:
        out, open_, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = self.ranks[at[hit]]
            open_, start = open_[~hit], start + size
        return out


@dataclass
class Shard:
    """The arrays of one shard."""

    index: PerfectHash
    prints: np.ndarray
    counts: np.ndarray
    owned: np.ndarray  # whether a document with an id holds the line
    owners: np.ndarray

    @classmethod
    def read(cls, row) -> "Shard":
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sum(row["sizes"]))).astype(bool)
        arrays = (np.frombuffer(row[c], t) for c, t in (("prints", "<u8"), ("counts", "<u4"), ("owned", np.uint8), ("owners", "<i8")))
        return cls(PerfectHash.stored([int(s) for s in row["sizes"]], bits), *arrays)

    def drops(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Whether the lines with these hashes go from the documents with these ids (where known)."""
        at = self.index.places(first)
        hit = at >= 0
        hit[hit] = self.prints[at[hit]] == second[hit]
        place = at[hit]
        owned = self.owned[place] == 1
        hit[hit] = np.where(known[hit], ~owned | (self.owners[place] != ids[hit]), owned)
        return hit


def shard_row(group: pd.DataFrame) -> dict:
    first = group["h1"].to_numpy(np.int64).view(np.uint64)
    index = PerfectHash.of(first)
    order = np.argsort(index.places(first))
    return {
        "shard": int(group["shard"].iloc[0]),
        "n": len(group),
        "sizes": index.sizes,
        "bits": np.packbits(index.bits).tobytes(),
        "prints": group["h2"].to_numpy(np.int64)[order].astype("<i8").tobytes(),
        "counts": np.minimum(group["n"].to_numpy(np.int64)[order], (1 << 32) - 1).astype("<u4").tobytes(),
        "owned": group["owned"].to_numpy(bool)[order].astype(np.uint8).tobytes(),
        "owners": group["owner"].to_numpy(np.int64)[order].astype("<i8").tobytes(),
    }


def lines_of(docs: DataFrame, least: int) -> DataFrame:
    """(h1, h2, id, known): the distinct keys of each row of (id, known, text)."""

    def framed(rows: list[tuple[int, bool]], hashes: list[int]) -> pd.DataFrame:
        first, second = halves(hashes)
        owners = pd.DataFrame(rows, columns=["id", "known"]).astype({"id": np.int64, "known": bool})
        return owners.assign(h1=first.view(np.int64), h2=second.view(np.int64))[["h1", "h2", "id", "known"]]

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, hashes = [], []
            for own, known, text in zip(batch["id"].tolist(), batch["known"].tolist(), batch["text"], strict=True):
                found = {h for line in text.split("\n") if (h := key_hashes(line, least)) is not None}
                hashes += found
                rows += [(own, known)] * len(found)
                if len(rows) > LINES_AT_ONCE:
                    yield framed(rows, hashes)
                    rows, hashes = [], []
            yield framed(rows, hashes)

    return docs.mapInPandas(hashed, "h1 long, h2 long, id long, known boolean")


def line_counts(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """(h1, h2, n, owned, owner) of the keys of (id, known, text) that at least ``least_docs`` documents hold: documents, whether
    one of them has an id, and the largest."""
    lines = lines_of(docs, least_chars)
    # Only where ids repeat can one document hold a key twice; otherwise keys are counted before they are shuffled.
    if not docs.groupBy("id", "known").count().where("count > 1").isEmpty():
        lines = lines.distinct()
    owner = F.coalesce(F.max(F.when(F.col("known"), F.col("id"))), F.lit(0)).alias("owner")
    counts = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("known").alias("owned"), owner)
    return counts.where(F.col("n") >= least_docs)


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row of arrays for each shard of keys. Two keys with one first hash can't both have a place: the one with the
    larger second hash would be lost, at 1e9 keys with a chance of 3 %; so that fails loudly."""
    dealt = counts.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(lambda group: pd.DataFrame([shard_row(checked(group))]), SHARD)


def checked(group: pd.DataFrame) -> pd.DataFrame:
    if group["h1"].duplicated().any():
        raise ValueError("two lines share a 64-bit hash")
    return group


def kept_lines(text: str, dropped: Iterable[int]) -> str:
    gone = set(dropped)
    return "\n".join(line for n, line in enumerate(text.split("\n")) if n not in gone)


def probes(ids: Iterable, texts: Iterable[str], least: int) -> pd.DataFrame:
    """row, at (place of the line), h1, h2, id and whether it is known, of all lines with long enough keys."""
    rows, places, hashes, owners = [], [], [], []
    for row, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
        for at, line in enumerate(text.split("\n")):
            h = key_hashes(line, least)
            if h is not None:
                rows.append(row)
                places.append(at)
                hashes.append(h)
                owners.append(doc_id)
    first, second = halves(hashes)
    known = np.array([o is not None for o in owners], bool)
    own = np.array([int(o) if o is not None else 0 for o in owners], np.int64)
    hashed = {"h1": first.view(np.int64), "h2": second.view(np.int64)}
    return pd.DataFrame({"row": np.array(rows, np.int64), "at": np.array(places, np.int64), **hashed, "id": own, "known": known})


def gone(lines: pd.DataFrame, shard: Shard) -> np.ndarray:
    first, second = (lines[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    return shard.drops(first, second, lines["id"].to_numpy(np.int64), lines["known"].to_numpy(bool))


def probe_here(docs: DataFrame, index: DataFrame, shards: int, least: int) -> DataFrame:
    """(every column, _dropped places) with the arrays of all shards on every executor."""
    sent = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in index.collect()])

    # Ids travel as text: integers with gaps would become floating-point numbers.
    @F.pandas_udf("array<long>")
    def dropped(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        arrays = {row["shard"]: Shard.read(row) for row in sent.value}
        for ids, texts in batches:
            out = []
            for some, part in zip(pieces(ids), pieces(texts), strict=True):
                lines = probes(some, part, least)
                found = [group[gone(group, arrays[s])] for s, group in lines.groupby(lines["h1"] % shards) if s in arrays]
                places = [[] for _ in range(len(part))]
                for row, at in (zip(*(pd.concat(found)[c].tolist() for c in ("row", "at")), strict=True) if found else ()):
                    places[row].append(at)
                out += places
            yield pd.Series(out, dtype=object)

    return docs.withColumn("_dropped", dropped(F.col("_id").cast("string"), F.col("_text")))


def probe_there(docs: DataFrame, index: DataFrame, shards: int, least: int) -> DataFrame:
    """The same with lines brought to the shards: groups of at most PROBES lines meet a copy of their shard's arrays."""
    names = ["doc_id", "h", "at", "h1", "h2", "id", "known"]

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (p for b in batches for p in pieces(b)):
            lines = probes(batch["doc_id"], batch["text"], least)
            lines[["doc_id", "h"]] = batch[["doc_id", "h"]].iloc[lines["row"]].to_numpy()
            yield lines[names]

    texts = docs.select(F.col("_id").cast("string").alias("doc_id"), F.md5("_text").alias("h"), F.col("_text").alias("text"))
    lines = texts.mapInPandas(asked, "doc_id string, h string, at long, h1 long, h2 long, id long, known boolean")
    lines = lines.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    parts = pin(lines.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(PROBES)).cast("int").alias("parts")))
    lines = lines.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("doc_id", "h", "at"), "parts").cast("int")).drop("parts")
    counted = parts.select(F.col("shard").alias("of"), F.col("parts").alias("copies"))
    copies = index.join(counted, F.col("shard") == F.col("of"))
    copies = copies.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("of", "copies")

    def answered(lines: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        kept = lines[gone(lines, Shard.read(arrays.iloc[0]))] if len(arrays) and len(lines) else lines[:0]
        return kept[["doc_id", "h", "at"]]

    met = lines.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part"))
    found = met.applyInPandas(answered, "doc_id string, h string, at long").distinct()
    dropped = found.groupBy(F.col("doc_id").alias("_gone"), F.col("h").alias("_hash")).agg(F.collect_list("at").alias("_places"))
    hashed = docs.withColumn("_md5", F.md5("_text"))
    same = hashed["_id"].cast("string").eqNullSafe(dropped["_gone"]) & (hashed["_md5"] == dropped["_hash"])
    joined = hashed.join(dropped, same, "left").withColumn("_dropped", F.coalesce("_places", F.array().cast("array<long>")))
    return joined.drop("_md5", "_gone", "_hash", "_places")


def without_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    shard_keys: int = SHARD_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every row with its text without lines that at least ``least_docs`` documents hold, but for the largest doc_id of them;
    adds n_lines (before) and n_dropped."""
    named = docs.withColumns({"_id": F.col(doc_id).cast("long"), "_text": or_empty(text)})
    known = F.col("_id").isNotNull().alias("known")
    owned = named.select(F.coalesce("_id", F.lit(0)).alias("id"), known, F.col("_text").alias("text"))
    counts = pin(line_counts(owned, least_chars, least_docs))
    keys = counts.count()
    shards = max(1, -(-keys // shard_keys))
    index = pin(build_index(counts, shards))
    probe: Callable = probe_here if keys * KEY_BYTES <= broadcast_bytes else probe_there
    probed = probe(named, index, shards, least_chars)

    @F.pandas_udf("string")
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, dropped in batches:
            yield pd.Series([kept_lines(t, d) if len(d) else t for t, d in zip(texts, dropped, strict=True)], dtype=object)

    made = (text, "n_lines", "n_dropped", "_id", "_text", "_dropped")
    return probed.select(
        *keep_names(docs, *made),
        kept("_text", "_dropped").alias(text),
        # One more than the line feeds.
        (F.octet_length("_text") - F.octet_length(F.translate("_text", "\n", "")) + 1).cast("long").alias("n_lines"),
        F.size("_dropped").cast("long").alias("n_dropped"),
    )
