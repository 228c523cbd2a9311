"""SimHash of documents and of edited versions of them, in DataFrame operations only.

Each word votes on the 64 bits of its hash with its length as weight, once for each time it occurs; a bit is
set if over half of a text's weight voted for it. Two bits are counted in one 64-bit sum (32 sums of 32-bit
halves), so the votes of a text are one small row however long it is.

The next document by doc_id is found in slices of neighbouring (id, text hash): ranges of ids are counted, a range with too much
text is counted again in finer ranges between the ids it really holds, one id with too much text in ranges of text hashes. Ranges
are gathered into slices of about SLICE_BYTES of text, and only within a slice are rows sorted. The first document of the next
slice is put behind each slice as a guest. The one shuffle by slice also serves the votes, which stay in it.

``within_radius`` finds close fingerprints in permuted block tables: of ``radius + kept`` blocks of bits at least ``kept`` agree, so for
each choice of ``kept`` blocks there is a table keyed by them; pairs that meet are verified once, in the first table that shows them.

Defined results: null and empty texts and texts without words have fingerprint zero. Ties of doc_id are ordered by text hash; a
null doc_id comes first; only rows equal in both share a slice whatever their number. The only document is its own next one. Repeated rows are documents of their own. Empty table: no rows.
Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import or_empty
from orderflow.session import pin

BUCKETS, SLICE_BYTES = 65_536, 2_000_000
RADIUS = 3
#: Bit i and bit i + 32 of a hash, as two halves of one sum.
HALVES = (1 << 32) + 1
SPACE = r"[\x20\x09-\x0D]+"
NO_ID = -(1 << 63)


def vote_sums(word: Column) -> list[Column]:
    """Aggregates: 32 sums of votes, two bits in each, and the sum of weights."""
    h, weight = F.xxhash64(word), F.char_length(word).cast("long")
    votes = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(HALVES)) * weight).alias(f"v{i}") for i in range(32)]
    return [*votes, F.sum(weight).alias("weight")]


def from_votes() -> Column:
    """Fingerprint of the columns of ``vote_sums``."""
    out = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"v{i}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(F.col(f"v{i}"), 32)
        for bit, votes in ((i, low), (i + 32, high)):
            mask = 1 << bit
            out = out.bitwiseOR(F.when(votes * 2 > F.col("weight"), F.lit(mask - (1 << 64) if bit == 63 else mask)).otherwise(F.lit(0)))
    return out


def words_of(text: Column) -> Column:
    return F.explode_outer(F.split(F.lower(text), SPACE))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class _Slices:
    """Cuts all rows, in the order of (id, text hash), into slices. ``keys`` has id, hash and bytes of every row and is read once a
    level. A level's ranges are at most about 5 * BUCKETS on the driver, whatever the table: each range that is cut again holds more
    than ``full`` bytes, and gets parts in proportion to them."""

    def __init__(self, keys: DataFrame):
        self.spark, self.levels = keys.sparkSession, []
        total = keys.agg(F.sum("bytes"), F.min("id"), F.max("id")).first()
        self.slice_bytes = max(SLICE_BYTES, (total[0] or 0) // BUCKETS)
        full, leaves, base = 4 * self.slice_bytes, [], 1
        cut = [] if total[0] is None else [(0, False, total[1], total[2], BUCKETS)]
        while cut:
            level, born = [], base
            for node, by_hash, low, high, parts in cut:
                width = -(-(high - low + 1) // parts)
                level.append((node, by_hash, low, width, base))
                base += (high - low) // width + 1
            self.levels.append(level)
            found = self._place(keys).where(F.col("node") >= born).groupBy("node").agg(
                F.sum("bytes").alias("bytes"), F.min(F.struct("id", "hash")).alias("first"), F.max("id").alias("last_id"),
                F.min("hash").alias("low_hash"), F.max("hash").alias("high_hash"),
            ).collect()
            cut = []
            for r in found:
                parts = 4 * -(-r["bytes"] // full)
                if r["bytes"] > full and r["first"]["id"] < r["last_id"]:
                    cut.append((r["node"], False, r["first"]["id"], r["last_id"], parts))
                elif r["bytes"] > full and r["low_hash"] < r["high_hash"]:
                    cut.append((r["node"], True, r["low_hash"], r["high_hash"], parts))
                else:
                    leaves.append((r["first"]["id"], r["first"]["hash"], r["node"], r["bytes"]))
        starts, filled, self.of_node = [], self.slice_bytes, []
        for doc, digest, node, size in sorted(leaves):
            if filled >= self.slice_bytes:
                starts.append((doc, digest))
                filled = 0
            filled += size
            self.of_node.append((node, len(starts) - 1))
        self.next_first = [(s, *starts[(s + 1) % len(starts)]) for s in range(len(starts))]

    def _place(self, rows: DataFrame) -> DataFrame:
        """Rows with the ``node`` that they reach."""
        if not self.levels:
            return rows.withColumn("node", F.lit(0).cast("long"))
        (_, _, low, width, base), = self.levels[0]  # all rows in one range: no table to join
        first = f"{base} + (CAST(id AS DECIMAL(20,0)) - CAST('{low}' AS DECIMAL(20,0))) DIV CAST({width} AS DECIMAL(20,0))"
        placed = rows.withColumn("node", F.expr(first).cast("long"))
        for level in self.levels[1:]:
            ranges = self.spark.createDataFrame(level, "node long, by_hash boolean, low long, width long, base long")
            offset = F.expr("(CAST(if(by_hash, hash, id) AS DECIMAL(20,0)) - CAST(low AS DECIMAL(20,0))) DIV CAST(width AS DECIMAL(20,0))")
            below = F.coalesce(F.col("base") + offset, F.col("node"))
            # Bounded as the class says.
            placed = placed.join(F.broadcast(ranges), "node", "left").withColumn("node", below).drop("by_hash", "low", "width", "base")
        return placed

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows (with id and hash) and their ``slice``."""
        slices = F.broadcast(self.spark.createDataFrame(self.of_node, "node long, slice int"))
        return self._place(rows).join(slices, "node").drop("node")

    def guests(self, rows: DataFrame) -> DataFrame:
        """(slice, id, hash, text): one row for each slice, the first of the next slice."""
        behind = F.broadcast(self.spark.createDataFrame(self.next_first, "slice int, id long, hash long"))
        return rows.join(behind, ["id", "hash"]).groupBy("slice", "id", "hash").agg(F.min("text").alias("text"))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    body = or_empty(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), body.alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    keys = pin(rows.select("id", "hash", F.octet_length("text").cast("long").alias("bytes")))
    slices = _Slices(keys)
    columns = ["slice", "doc_id", "id", "hash", "text"]
    placed = slices.placed(rows).select(*columns, F.lit(False).alias("guest"))
    guests = slices.guests(rows).withColumns({"doc_id": F.lit(None).cast(docs.schema[doc_id].dataType), "guest": F.lit(True)}).select(*columns, "guest")

    order = Window.partitionBy("slice").orderBy("guest", "id", "hash")
    numbered = placed.unionByName(guests).withColumns({"n": F.row_number().over(order), "next_text": F.lead("text").over(order)})
    edited = F.when(~F.col("guest"), _edited(F.col("text"), F.col("next_text")))
    row = ["slice", "n", "guest", "doc_id", "n_chars", "edited_sha256"]
    both = numbered.withColumn("edited", edited).select(
        "slice", "n", "guest", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("edit"), F.col("text").alias("t")), F.struct(F.lit(1).alias("edit"), F.col("edited").alias("t")))).alias("v"),
    )
    votes = both.select(*row, F.col("v.edit").alias("edit"), words_of(F.col("v.t")).alias("word")).groupBy(*row, "edit").agg(*vote_sums(F.col("word")))
    prints = votes.select(*row, "edit", from_votes().alias("fp"))
    found = prints.groupBy(*row).agg(*[F.max(F.when(F.col("edit") == k, F.col("fp"))).alias(name) for k, name in ((0, "fp"), (1, "edited_fp"))])
    after = F.lead("fp").over(Window.partitionBy("slice").orderBy("n"))
    return (
        found.withColumn("next_fp", after)
        .where(~F.col("guest"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            as_hex(F.col("fp")).alias("fingerprint"),
            as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
            likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
            likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        )
    )


def with_near_counts(printed: DataFrame, doc_id: str = "doc_id", every: int = 50, radius: int = RADIUS) -> DataFrame:
    """``near_count`` for the rows whose id is divisible by ``every``: how many other fingerprints of the table lie within ``radius``
    bits of the row's own, by the block tables; null for all other rows."""
    printed = pin(printed)
    fp = F.conv("fingerprint", 16, -10).cast("long")
    asked = F.col(doc_id) % every == 0
    near = within_radius(printed.where(asked).select(fp.alias("query")).distinct(), printed.select(fp.alias("fp")).distinct(), radius)
    counts = near.groupBy("query").agg((F.count(F.lit(1)) - 1).alias("near_count")).withColumn("of", as_hex(F.col("query")))
    found = printed.where(asked).join(counts.select(F.col("of").alias("fingerprint"), "near_count"), "fingerprint", "left")
    rest = printed.where(~F.coalesce(asked, F.lit(False))).withColumn("near_count", F.lit(None).cast("long"))
    return found.select(*printed.columns, "near_count").unionByName(rest)


def _edited(text: Column, after: Column) -> Column:
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(after, F.lit(1), half))


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, kept: int = 3) -> DataFrame:
    """(query, fp): all fingerprints of ``index`` (distinct fp) within ``radius`` bits of those of ``queries`` (distinct query)."""
    blocks = radius + kept
    edges = [64 * b // blocks for b in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    tables = []
    for chosen in combinations(range(blocks), kept):
        mask = sum(masks[b] for b in chosen)
        tables.append(mask - (1 << 64) if mask >> 63 else mask)

    def keyed(df: DataFrame, fp: str) -> DataFrame:
        keys = [F.struct(F.lit(n).alias("table"), F.col(fp).bitwiseAND(F.lit(m)).alias("bits")) for n, m in enumerate(tables)]
        return df.select(fp, F.explode(F.array(*keys)).alias("k")).select(fp, "k.table", "k.bits")

    met = keyed(queries, "query").join(keyed(index, "fp"), ["table", "bits"])
    apart = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.lit(0)
    for n, m in reversed(list(enumerate(tables))):
        first = F.when(apart.bitwiseAND(F.lit(m)) == 0, n).otherwise(first)
    return met.where(F.bit_count(apart) <= radius).where(first == F.col("table")).select("query", "fp")
