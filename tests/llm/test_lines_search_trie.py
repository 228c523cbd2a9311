"""Line dedup, ranked search and the conversation trie against plain versions, and on messy rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderflow.llm import line_dedup, prefix_trie, ranked_search

DOCS = "doc_id long, text string"
SHARED = "This line is in many of the documents"
MESSY = [
    (1, f"{SHARED}\nshort\nshort\n{SHARED}"),
    (2, f" \t{SHARED.upper()}\x0b\nown line of the second document"),
    (2, f" \t{SHARED.upper()}\x0b\nown line of the second document"),
    (2**53 + 1, f"{SHARED}\n\n"),
    (2**53, f"x\n{SHARED}\r"),
    (None, f"a row without any id holds this one\n{SHARED}"),
    (None, "a row without any id holds this one"),
    (3, "short\n\nshort"),
    (4, None),
    (5, ""),
    (6, "é" * 19 + "\n" + "é" * 20),
    (7, "é" * 20 + "\n" + "É" * 20),
    (8, "é" * 20),
    (9, "word " * 60_000 + "\n" + SHARED),
]


def plain_dedup(rows, least_chars=20, least_docs=3):
    space = " \t\n\x0b\x0c\r"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(space))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    owner = {k: max((i for i in h if i is not None), default=None) for k, h in holders.items() if len(h) >= least_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in owner or owner[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("broadcast_bytes", [line_dedup.BROADCAST_BYTES, 0])
def test_line_dedup(spark, tiny, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(line_dedup, "PROBES", 50)
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    for rows in (MESSY, table, [(2, "only ids that occur twice are here"), (2, None)], []):
        docs = spark.createDataFrame(rows, DOCS).withColumn("N_lines", F.lit("old")).withColumn("more", F.lit(1)).repartition(3)
        got = line_dedup.without_repeated_lines(docs, broadcast_bytes=broadcast_bytes, shard_keys=7)
        assert sorted(got.columns) == ["doc_id", "more", "n_dropped", "n_lines", "text"]
        assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == plain_dedup(rows)


def test_a_perfect_hash_is_minimal_and_strangers_fail_the_fingerprint():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys, strangers = np.split(np.unique(rng.integers(0, 2**64, 2 * n, dtype=np.uint64))[: 2 * n], [n])
        assert sorted(line_dedup.PerfectHash.of(keys).places(keys).tolist()) == list(range(n))
    frame = pd.DataFrame({"shard": 0, "h1": keys.view(np.int64), "h2": keys.view(np.int64) + 1, "n": 3, "owned": True, "owner": 5})
    shard = line_dedup.Shard.read(line_dedup.shard_row(frame))
    yes = np.ones(len(strangers), bool)
    assert not shard.drops(strangers, strangers + np.uint64(1), np.zeros(len(strangers), np.int64), yes).any()
    assert shard.drops(keys, keys + np.uint64(1), np.zeros(len(keys), np.int64), yes[: len(keys)]).all()
    assert len(shard.index.bits) < 5 * len(keys) and (shard.counts == 3).all()


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=20):
    terms = lambda t: TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // total if total else 0
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, n in Counter(terms(text)).items()
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i if i is not None else 0))
        out += [(item, at + 1, None if none else i, -score) for at, (score, none, i) in enumerate(sorted(found)[:k])]
    return Counter(out)


def test_search(spark, monkeypatch):
    rng = random.Random(5)
    words = ["the", "a", "of"] * 8 + [f"w{i}" for i in range(60)] + ["é", "naïve", "x1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(400)]
    docs += [(None, "w1 w2 the"), (None, "w1 w2 the"), (2**53 + 1, "w1 w2 the"), (2**53, "W1, w2! THE"), (900, None), (901, "!? \x00"), (902, "w3 " * 30_000)]
    docs += [(5000 + i, "the same text w7") for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(30)]
    items += [(100, None), (101, "nowhere"), (102, "w7 w7 w7"), (102, "w1"), (None, "w1 w2"), (103, "the " * 20_000 + "w5"), (104, "NAÏVE é")]
    frame = spark.createDataFrame(docs, DOCS).withColumn("SCORE", F.lit(1)).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(9))
    for block, part_bytes, top in ((16, 1 << 20, 20), (10_000, 4000, 3)):
        monkeypatch.setattr(ranked_search, "BLOCK", block)
        monkeypatch.setattr(ranked_search, "TERMS_AT_ONCE", 100)
        # Workers import the module anew: what it uses there is what it was sent.
        got = ranked_search.search(frame, asked, top, part_bytes=part_bytes)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(tuple(r) for r in got.collect()) == plain_search(docs, items, top)
    empty = frame.limit(0)
    assert ranked_search.search(empty, asked).count() == 0 and ranked_search.search(frame, asked.limit(0)).count() == 0


def test_blocks_of_any_size_give_the_same_best_and_stop_making_accumulators(monkeypatch):
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(words, k=30))) for i in range(1500)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(40)]
    for block in (7, 1500):
        monkeypatch.setattr(ranked_search, "BLOCK", block)
        asked, made, held = ranked_search.Asked(), 0, 0
        for item in items:
            asked.add(*item)
        frame = pd.DataFrame(docs, columns=["id", "text"])
        blocks = list(asked.blocks(iter([frame])))
        df = sum(np.diff(b.starts) for b in blocks)
        weights = np.array([ranked_search.weigh(1500, int(d)) if d else 0 for d in df])
        best = [ranked_search.Best(20) for _ in asked.items]
        for b in blocks:
            gains, scores, most = b.contributions(weights, 1500, 45_000), np.zeros(len(b.ids), np.int64), np.zeros(len(weights), np.int64)
            some = np.flatnonzero(np.diff(b.starts))
            most[some] = np.maximum.reduceat(gains, b.starts[some])
            for (_, wanted), top in zip(asked.items, best, strict=True):
                made += ranked_search.search_block(b, gains, most, df, wanted, top, scores)
                held += len(np.unique(np.concatenate([b.rows[b.starts[t] : b.starts[t + 1]] for t, _ in wanted])))
                assert not scores.any()
        got = Counter((item, n + 1, int(i), int(s)) for (item, _), top in zip(asked.items, best, strict=True) for n, (i, s) in enumerate(zip(top.ids, top.scores, strict=True)))
        assert got == plain_search(docs, items)
        assert made < 0.8 * held


# --- conversation trie


def plain_trie(rows, rebuild=True):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in said.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:] if rebuild else turns
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(whole[c]) == len(p)))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 3)
    rng, rows = random.Random(8), []
    for c in range(150):
        first = rng.choice(["hello there", "hello there", "one more"])
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", first if t == 0 else rng.choice(["yes", "no it is", "a b  c", ""])))
    rows += [(200 + c, t, "user", "the same, always") for c in range(40) for t in range(3)]
    rows += [(300, None, None, None), (300, None, "user", "null turn"), (300, 5, "user", None), (300, 5, "user", "tie"), (300, 5, "user", "tie")]
    rows += [(None, 0, "user", "nobody"), (2**53 + 1, 0, "user", "hello there"), (-5, 0, "bot", "negative"), (-25, 1, "u", "x"), (-20, 1, "u", "base " * 40_000)]
    rows += [(400, t, "user", f"deep {t}") for t in range(300)] + [(401, t, "user", f"deep {t}") for t in range(250)]
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(rows, schema).withColumn("DEPTH", F.lit(1)).repartition(4)
    for group, rebuild in ((3, True), (4096, True), (20, False)):
        got = prefix_trie.prefix_trie(frame, group=group, rebuild=rebuild)
        assert Counter(tuple(r) for r in got.collect()) == plain_trie(rows, rebuild), (group, rebuild)
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0


def test_a_conversation_that_is_left_without_turns_is_a_member_of_the_root(spark):
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(short, 0, "user", "goes away")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert Counter(tuple(r) for r in prefix_trie.prefix_trie(frame).collect()) == plain_trie(rows)


def test_radix_tree_layouts_and_paths():
    rng = random.Random(9)
    for width in (1, 3, 40):
        tree, keys = prefix_trie.RadixTree(), {bytes(rng.choices(range(256), k=rng.randint(0, width))) for _ in range(3000)}
        for row, key in enumerate(sorted(keys, key=lambda k: rng.random())):
            tree.insert(key, row)
        found, rooms, waiting = set(), set(), [(tree.root, b"")]
        while waiting:
            node, at = waiting.pop()
            rooms.add(node.children.room)
            at += node.path
            if node.row >= 0:
                found.add(at)
            else:
                assert node is tree.root or sum(1 for _ in node.children.each()) > 1  # paths are compressed
            for byte in range(256):
                if (child := node.children.get(byte)) is not None:
                    waiting.append((child, at + bytes([byte])))
        assert found == keys
        if width > 1:
            assert rooms >= {4, 16}
    tree, rooms = prefix_trie.RadixTree(), []
    for byte in range(256):
        tree.insert(bytes([byte]), byte)
        rooms.append(tree.root.children.room)
    assert [rooms.count(n) for n in (4, 16, 48, 256)] == [4, 12, 32, 208]
