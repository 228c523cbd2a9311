"""The trie of shared beginnings of conversations, built in adaptive radix trees.

A turn's id is the MD5 of its role and text, WIDTH bytes; a conversation is the string of its turns' ids, so that byte order
is the order of ids and the trie's nodes are the places at whole turns. Equal conversations are first counted as one sequence.

Prefixes that more than ``group`` sequences share are heavy; there are at most (turns / group) of them. A sequence belongs to the
group of its shortest prefix that isn't heavy, so a group has at most ``group`` sequences, however many begin with the same
turns. Each group is put into one adaptive radix tree: inner nodes of 4, 16, 48 or 256 children, paths without
branches compressed, and a walk from the leaves up gives counts, leaves and sums for each whole turn on the way, also those inside a
compressed path. What groups give to the heavy prefixes above them is summed up by prefix and then by its own prefixes.

The SHA-256 of the ids that end at a node needs them in order: they are range-partitioned by (node, id), joined to
strings of at most IDS_AT_ONCE ids, and only those strings meet, one after the other.

Defined results: turns are ordered by turn, null first, ties by their ids (MD5); null role or text is empty. Repeated rows are
turns of their own. Rows without conv_id belong to no conversation. Remainders are those of SQL, so a negative id has the base
nearer to zero. An id without turns is not known, and no conversations give no nodes. One conversation is handled whole, as ids.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import or_empty
from orderflow.session import pin

WIDTH, GROUP, IDS_AT_ONCE, ROWS_AT_ONCE = 16, 1024, 50_000, 10_000
BASE_EVERY, MOST_BORROWED = 20, 4
ROOT = bytes(WIDTH)
WORD = r"[^\x20\x09-\x0D]+"
NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, key binary, parent_key binary"
NAMES = [c.split()[0] for c in NODE.split(", ")]
EMPTY = hashlib.sha256(b"").hexdigest()


# --- adaptive radix tree


class Children:
    """Children by byte, in the smallest of four layouts: up to 4 or 16 sorted bytes, 48 places behind a table, or 256 places."""

    __slots__ = ("room", "keys", "nodes")

    def __init__(self):
        self.room, self.keys, self.nodes = 4, bytearray(), []

    def get(self, byte: int) -> "Node | None":
        if self.room <= 16:
            at = self.keys.find(byte)
            return self.nodes[at] if at >= 0 else None
        if self.room == 48:
            at = self.keys[byte]
            return self.nodes[at - 1] if at else None
        return self.nodes[byte]

    def put(self, byte: int, node: "Node") -> None:
        """Set or replace a child; a full layout grows first."""
        if self.room <= 16:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.nodes[at] = node
                return
            if len(self.keys) < self.room:
                self.keys.insert(at, byte)
                self.nodes.insert(at, node)
                return
            self._grow()
            return self.put(byte, node)
        if self.room == 48:
            if at := self.keys[byte]:
                self.nodes[at - 1] = node
            elif len(self.nodes) < 48:
                self.nodes.append(node)
                self.keys[byte] = len(self.nodes)
            else:
                self._grow()
                self.nodes[byte] = node
            return
        self.nodes[byte] = node

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            table = bytearray(256)
            for n, byte in enumerate(self.keys):
                table[byte] = n + 1
            self.room, self.keys = 48, table
        else:
            places: list = [None] * 256
            for byte, at in enumerate(self.keys):
                if at:
                    places[byte] = self.nodes[at - 1]
            self.room, self.keys, self.nodes = 256, bytearray(), places

    def each(self) -> Iterator["Node"]:
        return (node for node in self.nodes if node is not None)


class Node:
    """A place of the tree, reached by its parent's byte and then ``path``; ``row`` ends here (-1: none)."""

    __slots__ = ("path", "children", "row")

    def __init__(self, path: bytes, row: int = -1):
        self.path, self.row, self.children = path, row, Children()


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, row: int) -> None:
        above, node, at = None, self.root, 0
        while True:
            path = node.path
            rest = key[at : at + len(path)]
            if rest != path:
                same = next((n for n, (a, b) in enumerate(zip(rest, path, strict=False)) if a != b), len(rest))
                upper = Node(path[:same])
                upper.children.put(path[same], node)
                node.path = path[same + 1 :]
                above.children.put(key[at - 1], upper)
                node, path = upper, upper.path
            at += len(path)
            if at == len(key):
                node.row = row
                return
            below = node.children.get(key[at])
            if below is None:
                node.children.put(key[at], Node(key[at + 1 :], row))
                return
            above, node, at = node, below, at + 1


@dataclass
class Sequence:
    key: bytes
    path: bytes
    words: list[int]
    n: int
    conv: int


@dataclass
class Sums:
    """Of the part of the tree below a place: conversations, the smallest, leaves, saved tokens, and topmost nodes."""

    n: int = 0
    conv: int | None = None
    leaves: int = 0
    saved: int = 0
    tops: list[int] = field(default_factory=list)
    row: int = -1

    def add(self, n: int, conv: int, row: int) -> None:
        self.n, self.row = self.n + n, row
        self.conv = conv if self.conv is None else min(self.conv, conv)


def group_nodes(sequences: list[Sequence], depth: int, above: bytes | None) -> list[list]:
    """NODE rows of the prefixes of ``depth`` turns and more; ``above``: key of the prefix one turn shorter than all."""
    tree = RadixTree()
    for row, s in enumerate(sequences):
        tree.insert(s.path, row)
    order, waiting = [], [(tree.root, 0, -1)]
    while waiting:  # parents before children
        node, start, parent = waiting.pop()
        end = start + (node is not tree.root) + len(node.path)
        waiting += [(child, end, len(order)) for child in node.children.each()]
        order.append((node, start if node is not tree.root else -1, end, parent))
    sums, out = [Sums() for _ in order], []
    for at in range(len(order) - 1, -1, -1):
        node, start, end, parent = order[at]
        own = sums[at]
        if node.row >= 0:
            own.add(sequences[node.row].n, sequences[node.row].conv, node.row)
        for turns in range(end // WIDTH, max(start // WIDTH, depth - 1), -1):
            words = sequences[own.row].words[turns - 1] if turns else 0
            own.saved, own.leaves = own.saved + (own.n - 1) * words, own.leaves or 1
            ends = node.row >= 0 and turns * WIDTH == end
            for child in own.tops:
                out[child][2] = own.conv
            key = sequences[node.row].key if ends else None
            out.append([own.conv, turns, None, own.n, len(own.tops), own.leaves, own.saved, key, None])
            own.tops = [len(out) - 1]
        if parent >= 0:
            up = sums[parent]
            up.add(own.n, own.conv, own.row)
            up.leaves, up.saved = up.leaves + own.leaves, up.saved + own.saved
            up.tops = up.tops + own.tops if len(up.tops) < len(own.tops) else _longer(up.tops, own.tops)
        sums[at] = None
    for top in (n for n, r in enumerate(out) if r[1] == depth):
        out[top][8] = above
    return out


def _longer(many: list[int], few: list[int]) -> list[int]:
    many.extend(few)
    return many


# --- conversations as strings of turn ids


def sequences_of(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, ids, words): the turns of each conversation in order."""
    who, said = or_empty(role), or_empty(text)
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).isNotNull().alias("known"),
            F.col(turn).alias("turn"),
            F.unhex(F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said))).alias("id"),
            F.regexp_count(said, F.lit(WORD)).alias("words"),
        ).alias("t"),
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of every BASE_EVERY-th one before them."""
    base = own.where(F.col("conv_id") % BASE_EVERY == 0).select(
        F.col("conv_id").alias("_base"), *[F.slice(c, 1, MOST_BORROWED - 1).alias(f"_{c}") for c in ("ids", "words")]
    )
    borrowed = (F.crc32(F.col("conv_id").cast("string")) % MOST_BORROWED).cast("int")
    joined = own.join(base, F.col("conv_id") - F.col("conv_id") % BASE_EVERY == F.col("_base"), "left")

    def spliced(name: str, kind: str) -> Column:
        head = F.coalesce(F.slice(f"_{name}", F.lit(1), borrowed), F.array().cast(kind))
        return F.concat(head, F.slice(name, borrowed + 1, F.size(name))).alias(name)

    return joined.select("conv_id", spliced("ids", "array<binary>"), spliced("words", "array<int>"))


def keyed(conversations: DataFrame) -> DataFrame:
    """(conv_id, words, path, chain, key): the ids as one string, and a digest for each prefix, the last being the whole's."""

    @F.pandas_udf("path binary, chain binary, key binary")
    def chained(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ids in batch:
                chain = [ROOT]
                for i in ids:
                    chain.append(hashlib.md5(chain[-1] + i).digest())
                out.append((b"".join(ids), b"".join(chain), chain[-1]))
            yield pd.DataFrame(out, columns=["path", "chain", "key"])

    return conversations.select("conv_id", "words", chained("ids").alias("c")).select("conv_id", "words", "c.*")


def prefix_key(depth: Column) -> Column:
    return F.substring("chain", depth * WIDTH + 1, F.lit(WIDTH))


def turns_of() -> Column:
    return (F.octet_length("path") / F.lit(WIDTH)).cast("int")


def ends(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): the digest of the ids in order, joined by commas."""

    def strung(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, convs, made, at = batch["key"].tolist(), batch["conv_id"].tolist(), [], 0
            for end in range(1, len(keys) + 1):
                if end == len(keys) or keys[end] != keys[at] or end - at == IDS_AT_ONCE:
                    made.append((keys[at], convs[at], ",".join(map(str, convs[at:end]))))
                    at = end
            yield pd.DataFrame(made, columns=["key", "first", "ids"])

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch["key"], batch["ids"], strict=True):
                if key != now:
                    if now is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, sha.hexdigest())], columns=["key", "ends_sha256"])

    order = ["key", "conv_id"]
    parts = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    strings = parts.mapInPandas(strung, "key binary, first long, ids string")
    ordered = strings.repartition("key").sortWithinPartitions("key", "first")
    return ordered.mapInPandas(digested, "key binary, ends_sha256 string")


# --- the trie


def light_nodes(sequences: DataFrame) -> DataFrame:
    """NODE rows of the groups (group, depth, above) of ``sequences``, each in one tree."""

    def framed(rows: list[list]) -> pd.DataFrame:
        # The parent's id has gaps, which would make its column one of floating-point numbers.
        columns = zip(NAMES, zip(*rows, strict=True), strict=True)
        return pd.DataFrame({n: pd.Series(c, dtype="Int64" if n == "parent_conv_id" else None) for n, c in columns})

    def built(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, made = None, [], []
        for batch in batches:
            for r in batch.itertuples(index=False):
                if now is None or r.group != now[0]:
                    if held:
                        made += group_nodes(held, *now[1:])
                    if len(made) > ROWS_AT_ONCE:
                        yield framed(made)
                        made = []
                    now, held = (r.group, int(r.depth), r.above), []
                held.append(Sequence(r.key, r.path, r.words.tolist(), int(r.n), int(r.conv)))
        if held:
            made += group_nodes(held, *now[1:])
        if made:
            yield framed(made)

    columns = ["group", "depth", "above", "key", "path", "words", "n", "conv"]
    return sequences.select(*columns).repartition("group").sortWithinPartitions("group").mapInPandas(built, NODE)


def heavy_nodes(heavy: DataFrame, sequences: DataFrame, light: DataFrame) -> DataFrame:
    """NODE rows of the heavy prefixes (key, depth, n, conv)."""
    # The smallest conversation tells a sequence that begins with the prefix.
    shown = heavy.join(sequences.select("conv", "chain", "words"), "conv")
    own = F.when(F.col("depth") > 0, (F.col("n") - 1) * F.element_at("words", F.greatest("depth", F.lit(1)))).otherwise(0)
    named = shown.select(
        "key",
        "depth",
        "n",
        "conv",
        own.alias("own"),
        F.when(F.col("depth") > 0, prefix_key(F.col("depth") - 1)).alias("parent_key"),
        F.transform(F.sequence(F.lit(0), "depth"), lambda d: F.substring("chain", d * WIDTH + 1, F.lit(WIDTH))).alias("line"),
    )
    named = pin(named)
    below = light.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("roots"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    nothing = F.lit(0).cast("long")
    given = named.join(below, "key", "left").select(
        "key", "line", F.coalesce("leaves", nothing).alias("leaves"), (F.coalesce("saved", nothing) + F.col("own")).alias("saved"), F.coalesce("roots", nothing).alias("roots")
    )
    sums = given.select(F.explode("line").alias("key"), "leaves", "saved").groupBy("key").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    children = named.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("inner"))
    joined = named.join(given.select("key", "roots"), "key").join(children, "key", "left").join(sums, "key")
    return joined.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        (F.col("roots") + F.coalesce("inner", nothing)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        "key",
        "parent_key",
    )


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    group: int = GROUP,
    rebuild: bool = True,
) -> DataFrame:
    """conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of
    every node. With ``rebuild`` conversations first borrow their base's beginning, without they are taken as they are."""
    own = sequences_of(conversations, conv_id, turn, role, text)
    rows = pin(keyed(rebuilt(pin(own)) if rebuild else own))
    sequences = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"), *[F.first(c).alias(c) for c in ("path", "chain", "words")]
    )
    sequences = pin(sequences)
    places = sequences.select(F.col("key").alias("seq"), "chain", "n", "conv", F.explode(F.sequence(F.lit(0), turns_of())).alias("depth"))
    prefixes = places.select("seq", "n", "conv", "depth", prefix_key(F.col("depth")).alias("key"))
    counted = prefixes.groupBy("key", "depth").agg(F.count(F.lit(1)).alias("shared"), F.sum("n").alias("n"), F.min("conv").alias("conv"))
    heavy = pin(counted.where(F.col("shared") > group).drop("shared"))
    covered = prefixes.select("seq", "key").join(heavy.select("key", "depth"), "key").groupBy("seq").agg(F.max("depth").alias("covered"))
    placed = sequences.join(covered, sequences.key == covered.seq, "left").withColumn("depth", F.coalesce(F.col("covered") + 1, F.lit(0)))
    grouped = placed.where(turns_of() >= F.col("depth")).withColumns(
        {"group": prefix_key(F.col("depth")), "above": F.when(F.col("depth") > 0, prefix_key(F.col("depth") - 1))}
    )
    light = pin(light_nodes(grouped))
    every = light.unionByName(heavy_nodes(heavy, sequences, light))
    above = heavy.select(F.col("key").alias("parent_key"), F.col("conv").alias("_parent"))
    return (
        every.join(above, "parent_key", "left")
        .join(ends(rows), "key", "left")
        .select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )
