"""Documents into shards of nearly equal bytes, equal texts always together.

The texts, ordered by digest, are cut where the fullest shard is smallest: the smallest capacity with
which a greedy walk needs no more than the given shards. The walk only asks "which is the last text
that ends at or before x?". It is answered from a summary of the running byte counts in at most a
few thousand buckets; the search on the driver brackets the capacity with it, and only the buckets
that the cuts can fall into are then summed up again 256 times finer, until the answer is exact.

Rows of one text are counted in ``SALTS`` parts by doc_id, so a text held by a third of all rows is no
single group anywhere. The running sums are taken in slices by leading hex digits of the digest and
shifted by the at most 16 ** SLICE_DIGITS slice totals.

Defined results: a null text counts as the empty text, size 1 and in one group with it. Repeated rows
get a slot each. Fewer texts than shards leave the last shards empty. Empty table: no rows. Only
doc_id and text are read, so further columns and their names don't matter.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import or_empty
from orderflow.session import pin

SALTS, SLICE_DIGITS, FIRST_BITS, FINER_BITS = 64, 3, 12, 8


class Ends:
    """What is known of the places where texts end: sorted buckets (first, last end in it)."""

    def __init__(self, buckets: list[tuple[int, int]]):
        self.buckets = sorted(buckets)
        self.first = [b[0] for b in self.buckets]

    def last_before(self, x: int) -> tuple[int, int]:
        """The last end at or before ``x``: at least this, at most that."""
        i = bisect_right(self.first, x) - 1
        if i < 0:
            return 0, 0
        low, high = self.buckets[i]
        return (high, high) if high <= x else (low, x if low < x else low)

    def walk(self, capacity: int, shards: int, side: int) -> list[int]:
        cuts, at = [], 0
        for _ in range(shards):
            at = self.last_before(at + capacity)[side]
            cuts.append(at)
        return cuts

    def smallest(self, total: int, shards: int, side: int) -> int:
        low, high = -(-total // shards), total
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, side)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(ends: DataFrame, total: int, shards: int) -> list[int]:
    """Ends of all shards but the last, for ``ends`` (end: running sum at the end of each group)."""
    if not total:
        return [0] * (shards - 1)
    shift = max(0, total.bit_length() - FIRST_BITS)

    def summary(df: DataFrame, by: int) -> list[tuple[int, int]]:
        rows = df.groupBy(F.shiftright("end", by).alias("b")).agg(F.min("end"), F.max("end")).collect()
        return [(r[1], r[2]) for r in rows]

    known = Ends(summary(ends, shift))
    while True:
        low, high = (known.smallest(total, shards, side) for side in (1, 0))
        least, most = known.walk(low, shards, 0), known.walk(high, shards, 1)
        if low == high and least == most or not shift:
            return known.walk(high, shards, 0)[:-1]
        open_ = [
            (a, b) for a, b in known.buckets if a < b and any(a <= y and b >= x for x, y in zip(least, most, strict=True))
        ]
        if not open_:
            return known.walk(high, shards, 0)[:-1]
        finer = max(0, shift - FINER_BITS)
        again = ends.where(F.shiftright("end", shift).isin([a >> shift for a, _ in open_]))
        known = Ends([b for b in known.buckets if b not in set(open_)] + summary(again, finer))
        shift = finer


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    body = or_empty(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.sha2(body, 256).alias("digest"),
    ).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))

    parts = rows.groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    parts = parts.withColumn("slice", F.substring("digest", 1, SLICE_DIGITS))
    in_slice = Window.partitionBy("slice").orderBy("digest", "salt")
    group = Window.partitionBy("slice", "digest")
    earlier = in_slice.rowsBetween(Window.unboundedPreceding, -1)
    parts = pin(
        parts.withColumns({f"{m}_before": F.coalesce(F.sum(m).over(earlier), F.lit(0)) for m in ("n", "bytes")}).withColumns(
            {"group_before": F.min("bytes_before").over(group), "group_bytes": F.sum("bytes").over(group), "last": F.col("salt") == F.max("salt").over(group)}
        )
    )
    slices = parts.groupBy("slice").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    # At most 16 ** SLICE_DIGITS rows: one window and one broadcast of fixed size.
    over = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "slice",
        F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n_offset"),
        F.coalesce(F.sum("bytes").over(over), F.lit(0)).alias("bytes_offset"),
    )
    placed = parts.join(F.broadcast(offsets), "slice").select(
        "digest",
        "salt",
        "last",
        (F.col("n_before") + F.col("n_offset")).alias("n_before"),
        (F.col("group_before") + F.col("bytes_offset")).alias("start"),
        (F.col("group_before") + F.col("bytes_offset") + F.col("group_bytes")).alias("end"),
    )
    ends = placed.where("last").select("end")
    total = int(parts.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0])
    shard = sum((F.when(F.col("start") >= c, 1).otherwise(0) for c in minimax_cuts(ends, total, shards)), F.lit(0))
    placed = placed.withColumn("shard", shard)
    first = placed.groupBy("shard").agg(F.min("n_before").alias("first"))
    placed = placed.join(F.broadcast(first), "shard").select(
        "digest", "salt", "shard", (F.col("n_before") - F.col("first")).alias("base")
    )
    number = F.row_number().over(Window.partitionBy("digest", "salt").orderBy("doc_id")) - 1
    return (
        rows.withColumn("number", number)
        .join(placed, ["digest", "salt"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("base") + F.col("number")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
