"""Uneven norms, ports, numbers that are no letters, pages without an article element, malformed pages."""

from __future__ import annotations

import re
import sys
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import html_text, language_id, neighbours, url_filter
from orderflow.llm.queries import RULES

# --- neighbours


def search(spark, x, every=20, **how):
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.nearest(frame, frame.where(F.col("vec_id") % every == 0), **how).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: [v for _, v, _ in sorted(rows)] for q, rows in got.items()}


def recall(x, got, k=20):
    hits = 0
    for q, found in got.items():
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores, kind="stable")[:k].tolist()) & set(found))
    return hits / (k * len(got))


@pytest.mark.parametrize("longer", [10.0, 100.0])
def test_a_long_vector_hides_no_neighbours(spark, longer):
    x = np.random.default_rng(8).normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[777] *= longer
    got = search(spark, x)
    assert set(got) == set(range(0, 2000, 20)) and all(len(v) == 20 for v in got.values())
    assert recall(x, got) > 0.9


@pytest.mark.parametrize("n", [22, 50, 200])
def test_few_vectors_give_whole_lists(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 64))
    got = search(spark, x, 1, probes=1, tables=1)
    assert all(len(set(v)) == 20 for v in got.values()) and len(got) == n


def test_magnitudes_far_apart(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 8)) * np.repeat([1e-200, 1e-5, 1.0, 1e150], 30)[:, None]
    got = search(spark, x, 1, k=5)
    assert len(got) == 120 and all(len(v) == 5 for v in got.values())
    # Each query's best lie among the longest vectors, the small queries' too.
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    for q, found in got.items():
        scores = x[90:] @ unit[q]
        if q >= 90:
            scores[q - 90] = -np.inf
        assert found == (90 + np.argsort(-scores, kind="stable")[:5]).tolist()


# --- url filters


def test_links_reach_pages_at_any_port(spark):
    page = lambda *hosts: "".join(f"<a href='http://{h}/x'>x</a>" for h in hosts)
    rows = [(1, "http://bad.net:8080/", None), (2, "http://farm.io:81/", page("user@bad.net")), (3, "http://far.io/", page("farm.io:443"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.rule, r.verdict, r.distrust) for r in url_filter.judge_urls(pages, RULES).collect()}
    assert [got[i][0] for i in (1, 2, 3)] == ["bad.net:8080", "farm.io:81", "far.io"]
    assert got[1][1] is None and got[2][3] == 0  # a rule's host has no port, so nothing is a seed
    rows[0] = (1, "http://bad.net/", None)
    got = {r.page_id: r.distrust for r in url_filter.judge_urls(spark.createDataFrame(rows, pages.schema), RULES).collect()}
    assert got[1] > got[2] > got[3] > 0


def test_ranks_go_on_until_the_tolerance_holds(spark):
    edges = spark.createDataFrame([("trust", f"h{i}", f"h{i + 1}", 2.0) for i in range(40)], "kind string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("trust", "h0", 1.0)], "kind string, host string, score double")
    got = {r.host: r.score for r in url_filter.propagate(seeds, edges, damping=0.5, tolerance=1e-4).collect()}
    assert len(got) >= 13 and all(got[f"h{i}"] / got["h0"] == pytest.approx(0.5**i) for i in range(13))


# --- languages


def test_numbers_are_no_letters(spark):
    model = language_id.Identifier([language_id.Automaton.of("en", " some words of it ")])
    found = language_id.identify(["½ ²", "Ⅷ ①", "12_3 ٣", "é", "中", "½a"], model, "numbers")
    assert [lang for lang, _ in found] == ["und", "und", "und", "en", "en", "en"]


def test_held_out_is_never_null_and_the_sample_knows_no_ids(spark):
    rows = [(i, f"a text number {'abcdefgh'[i]} of several", "en") for i in range(8)] + [(None, "a text without an id", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert docs.select(language_id.held_out().alias("h")).where("h IS NULL").count() == 0
    chosen = lambda df: sorted(r.text for r in language_id.training_sample(df, per_language=4).collect())
    assert chosen(docs) == chosen(docs.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(docs)) and len(chosen(docs)) == 4


def test_learning_is_bounded(spark, monkeypatch):
    rows = [(f"l{i}", "wörd " * 50, i) for i in range(4)] + [("l0", "other words", 9)]
    sample = spark.createDataFrame(rows, "lang string, text string, h long")
    assert {a.learned for a in language_id.learn(sample, 20).automata} == {21}
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    with pytest.raises(ValueError):
        language_id.learn(sample, 20)


# --- page text

BODY = "".join(f"<p>Sentence number {i}, with a comma, and more text to be long enough.</p>" for i in range(6))
TEXT = [f"Sentence number {i}, with a comma, and more text to be long enough." for i in range(6)]


@pytest.mark.parametrize(
    ("page", "before", "after"),
    [
        (f"<div><h1>T</h1><p>lead</p><div class=body>{BODY}</div></div>", ["T", "lead"], []),
        (f"<div><h1>T</h1><div class=a><div class=b>{BODY}</div></div><ul><li>one<li>two</ul></div>", ["T"], ["one", "two"]),
        (f"<div class=body>{BODY}</div><div><p>Short end.</p></div><div><a href=x>more. links.</a></div>", [], ["Short end."]),
        (f"<div class='no-sidebar'>{BODY}</div>", [], []),
        (f"<div class='content has-sidebar'>{BODY}</div>", [], []),
        (f"<div class='post comments-open'>{BODY}</div><div class=comments><p>{BODY}{BODY}</div>", [], []),
        (f"<div class='page-header-hidden'>{BODY}</div>", [], []),
        (f"<div class='related-article'><h1>T</h1>{BODY}</div><div class=related><p>Other news.</p></div>", ["T"], []),
        (f"<div class=x>{BODY}</div><div id=comments><article class=comment-body>{BODY}{BODY}</article></div>", [], []),
        (f"<article>{BODY}</article><div>Other text, outside.</div>", [], []),
        (f"<div>{BODY}<p>See <span class=share>Share this!</span>below.</p></div>", [], ["See below."]),
    ],
)
def test_siblings_and_names(page, before, after):
    assert html_text.main_text(f"<body><nav><a href=/>Home</a></nav>{page}<footer>Us.</footer></body>") == "\n\n".join([*before, *TEXT, *after])


@pytest.mark.parametrize(
    "page",
    ["<a" * 500_000, '<x "' * 250_000, "<div>" * 100_000 + "x" + "</div>" * 100_000, "<p>" * 100_000, "<b>" * 100_000 + "x",
     "<p><table>" + "<div>" * 100_000, "<div " + "a=1 " * 250_000 + ">x.</div>", "<div class='" + "nav-" * 250_000 + "'>y", "<!--" * 250_000],
    ids=["open tags", "open quotes", "divs", "paragraphs", "inline", "scopes", "attributes", "names", "comments"],
)
def test_malformed_pages_take_linear_time(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 10


def test_letters_are_found_in_one_lookup():
    """Fractions, superscripts, Roman and circled numbers are no letters; telling them apart takes no search for each character."""
    numbers = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
    plain, words = re.compile(rf"[^\W\d_{numbers}]+"), re.compile(r"[^\W\d_]+")
    odd = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for text in (odd, "a\U00010400b 1½Ⅷ \U00010107x_y", "\udc41a"):
        assert language_id.WORDS.findall(text) == plain.findall(text)
    text = "einige kleine Worte " * 20_000

    def seconds(pattern):
        start = time.process_time()
        pattern.findall(text)
        return time.process_time() - start

    assert min(seconds(language_id.WORDS) for _ in range(3)) < 4 * min(seconds(words) for _ in range(3))
