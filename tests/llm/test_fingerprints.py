"""Fingerprints, edits and next documents against plain versions; slices with far, hot and missing ids."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from orderflow.llm import fingerprints

SCHEMA = "doc_id long, text string, hash string"


def digest(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def plain(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    weight, fp = sum(map(len, words)), 0
    for bit in range(64):
        if 2 * sum(len(w) for w in words if xxhash.xxh64_intdigest(w.encode(), 42) >> bit & 1) > weight:
            fp |= 1 << bit
    return fp


def expected(rows):
    rows = sorted((-(1 << 63) if i is None else i, digest(t or ""), t or "", i) for i, t in rows)
    out = Counter()
    for k, (_, _, text, doc_id) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][2]
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        fp, edited, following = plain(text), plain(edit), plain(after)
        near = [1 - (fp ^ other).bit_count() / 64 for other in (edited, following)]
        out[doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest(), f"{fp:016x}", f"{edited:016x}", *near] += 1
    return out


def some_text(rng):
    return " ".join(rng.choice(["Oak", "elm", "ash", "fir", "yew", "été", "κλ", "a,b"]) + str(rng.randrange(9)) for _ in range(rng.randrange(12)))


def cases():
    rng = random.Random(5)
    texts = [some_text(rng) for _ in range(160)]
    spread = [(rng.randrange(-(1 << 63), 1 << 63), t) for t in texts]
    return {
        "far": [(i, t) for i, t in enumerate(texts)] + [(1 << 62, "far away"), (-(1 << 62), "before")],
        "hot": [(7, t) for t in texts] + [(i, "x " * i) for i in range(20)],
        "missing": [(None, t) for t in texts] + [(1, None), (2, ""), (3, " \t")],
        "copies": [(4, "same words here")] * 90 + [(i, "same words here") for i in range(60)],
        "spread": [*spread, (-(1 << 63), "least"), ((1 << 63) - 1, "greatest")],
    }


@pytest.mark.parametrize("case", sorted(cases()))
def test_rows_equal_the_plain_version_in_many_slices(spark, monkeypatch, case):
    monkeypatch.setattr(fingerprints, "BUCKETS", 16)
    monkeypatch.setattr(fingerprints, "SLICE_BYTES", 150)
    rows = cases()[case]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = Counter(tuple(r) for r in fingerprints.fingerprint_documents(df).collect())
    assert got == expected(rows)


def test_no_slice_holds_far_more_than_its_share(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKETS", 64)
    monkeypatch.setattr(fingerprints, "SLICE_BYTES", 100)
    rows = [(5, i * 2**50, 10) for i in range(300)] + [(i, 1, 10) for i in range(300)] + [(1 << 62, 1, 10)]
    keys = spark.createDataFrame(rows, "id long, hash long, bytes long")
    slices = fingerprints._Slices(keys)
    sizes = [r["count"] for r in slices.placed(keys).groupBy("slice").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 60
    guests = slices.guests(keys.selectExpr("*", "'t' AS text")).groupBy("slice").count().collect()
    assert len(guests) == len(sizes) and all(r["count"] == 1 for r in guests)


def test_near_counts_equal_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (0, 0, 1, 2, 3, 4, 6)] + [0, 0, (1 << 64) - 1]
    rows = [(i if i % 9 else None, f"{fp:016x}") for i, fp in enumerate(prints)]
    got = fingerprints.with_near_counts(spark.createDataFrame(rows, "doc_id long, fingerprint string"), every=5).collect()
    every = set(prints)

    def count(doc_id, fp):
        if doc_id is None or doc_id % 5:
            return None
        return sum((int(fp, 16) ^ other).bit_count() <= 3 for other in every) - 1

    assert Counter(tuple(r) for r in got) == Counter((i, fp, count(i, fp)) for i, fp in rows)
