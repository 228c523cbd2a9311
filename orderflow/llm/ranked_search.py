"""Ranked lexical search, term at a time with a limited number of accumulators.

The asked items and the terms they use are dealt to parts of about PART_BYTES; each part is sent to the executors, and two
passes over the documents follow. The first counts documents, terms and, by asked term, the documents holding it. In the second
each task inverts its documents, BLOCK at a time: only asked terms get postings. An item's terms are then taken rarest
first. A term's postings add to the accumulators of their documents and make new ones, until what the remaining terms can
add at most (each term's largest contribution in the block) is less than the k-th best partial score: no document without an
accumulator can come among the k best any more. From there on only the existing accumulators are updated, to exact scores. A task
carries its k best of each item from block to block, where the k-th raises the bar, and gives them out once; they are merged
in two steps, so no task reads more than k rows of each of MERGES parts of an item. No postings are shuffled.

Defined results: terms are the maximal runs of characters that are not ASCII marks or white space, A-Z lower-cased; null
has none. Each row is a document: repeated rows are ranked each. Equal scores go by doc_id, rows without one last. Items with
equal ids are asked as one text each, so an id that occurs twice has two lists. Items without
terms, or whose terms occur nowhere, have no rows; neither have empty tables. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import or_empty

TOP, BLOCK, PART_BYTES, MERGES = 20, 16_384, 4 << 20, 64
#: Terms of a block that are looked up together.
TERMS_AT_ONCE = 500_000
# Fixed values of the score.
SCALE, TF_WEIGHT, M_WEIGHT, FLAT, SLOPE = 1_000_000_000, 1000, 12, 75, 25
LAST = np.iinfo(np.int64).max

#: Bytes that end a term become spaces and A-Z is lower-cased; all bytes of other characters are above 127.
KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(KEPT).split()


@dataclass
class Asked:
    """Items as term numbers with how often each asks for a term; terms by number."""

    numbers: dict[bytes, int] = field(default_factory=dict)
    items: list[tuple[int, list[tuple[int, int]]]] = field(default_factory=list)

    def add(self, item: int, text: str) -> None:
        asked = Counter(terms_of(text))
        if asked:
            self.items.append((item, [(self.numbers.setdefault(t, len(self.numbers)), n) for t, n in asked.items()]))

    def blocks(self, batches: Iterator[pd.DataFrame]) -> Iterator["Block"]:
        """Inverted documents of (id, text), BLOCK rows at a time."""
        ids, lengths, found = [], [], []
        rows, terms = [], []

        def look_up() -> None:
            number = np.fromiter((self.numbers.get(t, -1) for t in terms), np.int64, len(terms))
            row = np.repeat(np.arange(len(ids) - len(rows), len(ids)), rows)
            found.append(np.stack((number[number >= 0], row[number >= 0])))
            rows.clear()
            terms.clear()

        for batch in batches:
            for own, text in zip(batch["id"].tolist(), batch["text"], strict=True):
                own_terms = terms_of(text)
                ids.append(own)
                lengths.append(len(own_terms))
                rows.append(len(own_terms))
                terms += own_terms
                if len(terms) >= TERMS_AT_ONCE:
                    look_up()
                if len(ids) == BLOCK:
                    look_up()
                    yield Block.of(ids, lengths, np.concatenate(found, axis=1), len(self.numbers))
                    ids, lengths, found = [], [], []
        if ids:
            look_up()
            yield Block.of(ids, lengths, np.concatenate(found, axis=1), len(self.numbers))


@dataclass
class Block:
    """Postings of a block, by term: documents ``rows[starts[t]:starts[t + 1]]``, ascending, and how often they hold it."""

    ids: np.ndarray
    lengths: list[int]
    starts: np.ndarray
    rows: np.ndarray
    tf: np.ndarray

    @classmethod
    def of(cls, ids: list, lengths: list[int], found: np.ndarray, terms: int) -> "Block":
        pairs, tf = np.unique(found[0] * len(ids) + found[1], return_counts=True)
        number, row = np.divmod(pairs, len(ids))
        starts = np.searchsorted(number, np.arange(terms + 1))
        return cls(np.array([LAST if i is None else int(i) for i in ids], np.int64), lengths, starts, row, tf.astype(np.int64))

    def contributions(self, weights: np.ndarray, docs: int, terms: int) -> np.ndarray:
        """What each posting adds to the score for each time its term is asked."""
        m = np.array([FLAT + SLOPE * n * docs // terms for n in self.lengths], np.int64)
        weight = np.repeat(weights, np.diff(self.starts))
        return weight * ((SCALE * self.tf) // (TF_WEIGHT * self.tf + M_WEIGHT * m[self.rows]))


@dataclass
class Best:
    """The k best documents so far of one item."""

    k: int
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @property
    def bar(self) -> int:
        """The k-th best score: what is below it can't come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate((self.ids, ids)), np.concatenate((self.scores, scores))
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def search_block(block: Block, gains: np.ndarray, most: np.ndarray, rarest: np.ndarray, asked: list[tuple[int, int]], best: Best, scores: np.ndarray) -> int:
    """Add the block's best documents for one item to ``best``; returns the number of accumulators. ``gains``: by posting;
    ``most``: the largest of each term; ``rarest``: order of terms; ``scores``: zeros, and zeros again afterwards."""
    here = sorted(((t, n) for t, n in asked if block.starts[t] < block.starts[t + 1]), key=lambda a: (rarest[a[0]], a[0]))
    remaining = sum(n * int(most[t]) for t, n in here)
    alive, grows = np.empty(0, np.int64), True
    for t, n in here:
        if grows and remaining < max(best.bar, kth(scores[alive], best.k, remaining)):
            grows = False
        rows, gain = (a[block.starts[t] : block.starts[t + 1]] for a in (block.rows, gains))
        if grows:
            # A posting that adds nothing makes no accumulator, so that those above 0 are exactly the ones made.
            alive = np.concatenate((alive, rows[(scores[rows] == 0) & (gain > 0)]))
            scores[rows] += n * gain
        elif len(alive):
            if len(alive) < len(rows) // 16:
                at = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
                same = rows[at] == alive
                scores[alive[same]] += n * gain[at[same]]
            else:
                old = scores[rows] > 0
                scores[rows[old]] += n * gain[old]
        remaining -= n * int(most[t])
    found = scores[alive]
    wanted = (found > 0) & (found >= max(best.bar, kth(found, best.k, LAST)))
    best.add(block.ids[alive[wanted]], found[wanted])
    scores[alive] = 0
    return len(alive)


def kth(scores: np.ndarray, k: int, above: int) -> int:
    """The k-th largest score, or 0 where there are fewer or it can't be above ``above`` unless the largest is."""
    if len(scores) < k or (above != LAST and scores.max() <= above):
        return 0
    return int(np.partition(scores, len(scores) - k)[len(scores) - k])


def weigh(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def statistics(docs: DataFrame, asked: Asked) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the documents holding each asked term."""
    sent = docs.sparkSession.sparkContext.broadcast(asked)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        holding, with_terms, total = np.zeros(len(own.numbers), np.int64), 0, 0
        for block in own.blocks(batches):
            holding += np.diff(block.starts)
            with_terms += sum(n > 0 for n in block.lengths)
            total += sum(block.lengths)
        held = np.flatnonzero(holding)
        yield pd.DataFrame({"term": [-1, -2, *held.tolist()], "n": [with_terms, total, *holding[held].tolist()]})

    sums = docs.mapInPandas(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in sums.collect()}  # at most one row for each asked term of the part
    holding = np.array([found.get(t, 0) for t in range(len(asked.numbers))], np.int64)
    return found.get(-1, 0), found.get(-2, 0), holding


def ranked(docs: DataFrame, asked: Asked, k: int) -> DataFrame:
    """(item, item_id, id, score): the k best of each task of docs (id, text)."""
    n_docs, n_terms, holding = statistics(docs, asked)
    weights = np.array([weigh(n_docs, int(h)) if h else 0 for h in holding], np.int64)
    sent = docs.sparkSession.sparkContext.broadcast((asked, weights, holding))

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, weight, rarest = sent.value
        best = [Best(k) for _ in own.items]
        for block in own.blocks(batches):
            gains, scores = block.contributions(weight, n_docs, n_terms), np.zeros(len(block.ids), np.int64)
            most = np.zeros(len(weight), np.int64)
            held = np.flatnonzero(np.diff(block.starts))
            if len(held):
                most[held] = np.maximum.reduceat(gains, block.starts[held])
            for (_, wanted), top in zip(own.items, best, strict=True):
                search_block(block, gains, most, rarest, wanted, top, scores)
        for n, ((item, _), top) in enumerate(zip(own.items, best, strict=True)):
            if len(top.ids):
                yield pd.DataFrame({"item": n, "item_id": item, "id": top.ids, "score": top.scores})

    return docs.mapInPandas(searched, "item int, item_id long, id long, score long")


def asked_parts(items: DataFrame, part_bytes: int) -> Iterator[Asked]:
    """The items (item_id, text) in parts of about ``part_bytes``, one after the other."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    for part in range(parts):
        asked = Asked()
        for r in dealt.where(F.col("part") == part).collect():
            asked.add(r["item_id"], r["text"])
        if asked.items:
            yield asked


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 of each item."""
    texts = docs.select(F.col(doc_id).cast("long").cast("string").alias("id"), or_empty(text).alias("text"))
    wanted = items.select(F.col(item_id).cast("long").alias("item_id"), or_empty(item_text).alias("text"))
    made = None
    for n, asked in enumerate(asked_parts(wanted, part_bytes)):
        found = ranked(texts, asked, k).withColumn("item", F.struct(F.lit(n).alias("part"), "item"))
        made = found if made is None else made.unionByName(found)
    if made is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = [F.desc("score"), F.asc("id")]
    salted = made.withColumn("salt", F.spark_partition_id() % MERGES)
    some = Window.partitionBy("item", "salt").orderBy(*best)
    merged = salted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    final = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= k)
    return final.select("item_id", "rank", F.when(F.col("id") < LAST, F.col("id")).alias("doc_id"), "score")
