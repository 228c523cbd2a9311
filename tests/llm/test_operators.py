"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import base64
import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from orderflow.llm import byte_bpe, fingerprints, html_text, language_id, mixing, near_dedup, neighbours, piece_counts, sharding, url_filter
from orderflow.llm.components import components
from orderflow.llm.queries import RULES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the cat sat on the mat, and then the dog ran over the hill to the other house where it was warm"
ES = "el gato se sienta en la alfombra, y luego el perro corre por la colina hasta la otra casa donde hace calor"
MESSY = [
    (1, EN, "en", "a", 1),
    (2, EN, "en", "a", 1),
    (2, EN, "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, "  \t\n ", "es", "b", 1),
    (6, ES, "es", "b", 1),
    (7, ES + " 12%", "es", None, 1),
    (8, "12 %% 34", None, "c", 1),
    (9, "<s>é😀 中文</s>", "zh", "c", 1),
    (10, "ab " * 30_000 + "x" * 20_000, "en", "c", 1),
    (11, "one", "en", "c", 1),
    (None, "an id is missing here", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(MESSY, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet")


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


# --- url filters


def test_rules_and_parsing(spark):
    urls = {
        "http://A.example.NET/en/x?q=/": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
        "http://net": ("net", "", None, "allow"),
        "http://xnet/": ("xnet", "/", None, "allow"),
        "http://m.example.com/de/1#a": ("m.example.com", "/de/1", "example.com/de/", "block"),
        "http://example.org?u=a/fr/": ("example.org", "", None, "allow"),
        "x://y.org/fr/://z/": ("y.org", "/fr/://z/", "org/fr/", "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, None, "kept") for i, u in enumerate(urls)], "page_id long, url string, html string, HOST string")
    pages = pages.unionByName(pages.limit(1))
    got = url_filter.judge_urls(pages, RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.url], r.url
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_propagation_equals_power_iteration(spark):
    rng = random.Random(1)
    names = [f"h{i}" for i in range(12)]
    edges = {(rng.choice(names[:9]), rng.choice(names)) for _ in range(40)}
    edges = {(a, b): float(rng.randint(1, 5)) for a, b in sorted(edges) if a != b}
    frame = spark.createDataFrame([("trust", a, b, w) for (a, b), w in edges.items()], "kind string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("trust", "h0", 0.5), ("trust", "h3", 0.5)], "kind string, host string, score double")
    got = {r.host: r.score for r in url_filter.propagate(seeds, frame, damping=0.4, rounds=12, tolerance=1e-7).collect()}
    move, start = np.zeros((12, 12)), np.zeros(12)
    start[[0, 3]] = 0.5
    for (a, b), w in edges.items():
        move[names.index(a), names.index(b)] = w
    sums = move.sum(axis=1, keepdims=True)
    dead = (sums == 0).ravel()
    move = np.divide(move, sums, out=np.zeros_like(move), where=sums > 0)
    x = start
    for _ in range(2000):
        x = 0.6 * start + 0.4 * (x @ move + x[dead].sum() * start)
    assert all(abs(got.get(n, 0.0) - x[i]) < 1e-4 for i, n in enumerate(names))


def test_distrust_reaches_those_who_link_to_blocked_hosts(spark):
    link = lambda *hosts: "".join(f"<a HREF='https://u@{h}:80/x'>x</a>" for h in hosts)
    pages = spark.createDataFrame(
        [(1, "http://bad.net/", link()), (2, "http://farm.io/", link("bad.net") * 3), (3, "http://good.org/fr/", link("friend.io")), (4, "http://friend.io/", "")],
        "page_id long, url string, html string",
    )
    got = {r.host: r.verdict for r in url_filter.judge_urls(pages, RULES).collect()}
    assert got == {"bad.net": "block", "farm.io": "block", "good.org": "allow", "friend.io": "allow"}


# --- sharding


def best_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def test_sharding_is_minimax_over_the_ordered_groups(spark, docs, corpus, none):
    for df in (docs, corpus.select("doc_id", "text", F.lit(1).alias("shard"))):
        got, rows = sharding.shard_documents(df).collect(), df.collect()
        assert len(got) == len(rows)
        groups = Counter()
        for r in rows:
            groups[hashlib.sha256((r.text or "").encode()).hexdigest()] += len((r.text or "").encode()) + 1
        loads, slots, homes = Counter(), defaultdict(list), defaultdict(set)
        for r in got:
            loads[r.shard] += r.size
            slots[r.shard].append(r.slot)
            homes[r.size, r.text_crc32].add(r.shard)
        assert max(loads.values()) == best_capacity([groups[g] for g in sorted(groups)], 8)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(loads) <= set(range(8))
        assert all(len(h) == 1 for h in homes.values())
        assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((r.doc_id, zlib.crc32((r.text or "").encode())) for r in rows)
    assert sharding.shard_documents(none).count() == 0


def test_cuts_from_coarse_summaries_are_exact(spark):
    rng = random.Random(5)
    for n in (1, 3, 200):
        sizes = [rng.choice([1, 2, 50, 10**9]) for _ in range(n)]
        ends = spark.createDataFrame([(int(e),) for e in np.cumsum(sizes)], "end long")
        cuts = [0, *sharding.minimax_cuts(ends, sum(sizes), 8), sum(sizes)]
        assert max(np.diff(cuts)) == best_capacity(sizes, 8)


# --- token counts


def test_piece_counts_equal_the_library(docs, none, corpus):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for df in (docs.withColumn("N_tokens", F.lit("old")), corpus):
        for r in piece_counts.with_token_counts(df, PIECES).collect():
            assert r.n_tokens == len(model.encode(r.text or "")) and r.n_bytes == len((r.text or "").encode())
            assert r.over_limit == (r.n_tokens > 4096)
    assert piece_counts.with_token_counts(none, PIECES).count() == 0
    rng, pieces = random.Random(2), [model.id_to_piece(i) for i in range(300, 32000)]
    odd = ["".join(rng.choice("aabbe  \n▁é中😀") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    odd += ["".join(rng.choice(pieces) for _ in range(9)) for _ in range(3000)] + ["a" * 50_001, "ab" * 9_000, " " * 999, "中" * 5_000]
    assert piece_counts.count_tokens(odd, PIECES) == [len(x) for x in model.encode(odd)]


# --- language identification


def longest_phrases(text, word):
    at, n = 0, 0
    while at < len(word):
        end = at
        while end < len(word) and word[at : end + 1] in text:
            end += 1
        at, n = max(end, at + 1), n + 1
    return n


def test_automaton_finds_the_longest_phrases():
    rng, text = random.Random(3), " hello wörld ababab banana "
    model = language_id.Identifier([language_id.Automaton.of("x", text)])
    words = ["".join(rng.choice("abhelnowörzd") for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    assert model.count(words)[:, 0].tolist() == [longest_phrases(text, " " + w) for w in words]


def test_languages(docs, none, spark, tiny):
    model = language_id.fit(docs)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language_id.with_language(docs.withColumn("SCORE", F.lit("x")), model).collect()}
    assert len(got) == len(set((d, t) for d, t, *_ in MESSY))
    for (_, text), (lang, score) in got.items():
        assert (lang == "und" and score == 0) == (not re.search(r"[^\W\d_]", text or "")) and 0 <= score <= 1
    assert language_id.with_language(none, language_id.fit(none)).count() == 0
    assert {r.lang_pred for r in language_id.with_language(docs, language_id.fit(none)).collect()} == {"und"}


def test_a_tiny_language_wins_no_foreign_text():
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    of = language_id.Automaton.of
    for tiny in (" ok ", " the ok note ", " one short row here with few words "):
        model = language_id.Identifier([of("en", " " + " ".join(words * 5) + " "), of("aa", tiny)])
        found = language_id.identify([" ".join(rng.sample(words, 40)) for _ in range(30)], model, tiny)
        assert {lang for lang, _ in found} == {"en"}


def test_held_out_accuracy(spark):
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = language_id.with_language(whole, language_id.fit(whole)).where(language_id.held_out())
    right, n = judged.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right / n > 0.97


# --- page text

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="menu">
<header><p>Site name, with commas, and more, commas</p></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="sidebar-left"><p>Side text, long, long, long</p></div><!-- <p>comment</p> --><div id="cookie-notice"><p>We use, cookies</p></div>
<article><h1>Title &amp; more</h1><p><b>First,   paragraph<br>goes &eacute; on<p>Second 3 &lt; 4 <a href=x>link</a> a < b
<ul><li>one<li>two</ul><form><p>Search here, please</p></form><aside>See also, this</aside><div class="comments"><p>Reader, says, hi</p></div>
<p>Last.</article><footer>&copy; us, them, all</footer></body></html>"""


def test_page_text(spark):
    want = "Title & more\n\nFirst, paragraph goes é on\n\nSecond 3 < 4 link a < b\n\none\n\ntwo\n\nLast."
    assert html_text.main_text(PAGE) == want
    plain = "<div class=x><p>Some text, here, is the main part of it.</p><p>And more, of it.</p></div><div><a href=a>l1</a> <a href=b>l2</a></div>"
    assert html_text.main_text(plain) == "Some text, here, is the main part of it.\n\nAnd more, of it."
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<nav>a</nav><p", "x"), (5, "u", "just text " * 200_000, "x"), (6, "u", "<p>" * 3000 + "deep", "x"), (7, "u", "<div>" * 3000 + "deep", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text string")
    got = defaultdict(list)
    for r in html_text.with_main_text(pages).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert got[1] == [want, want] and got[2] == [""] and got[3] == [""] and got[6] == ["deep"] and got[7] == ["deep"]
    assert len(got[5][0]) == 1_999_999
    assert html_text.with_main_text(pages.limit(0)).count() == 0


def test_pages_of_the_table_keep_the_whole_article(spark, tiny):
    for r in html_text.with_main_text(spark.read.parquet(f"{tiny}/pages.parquet")).collect():
        body = r.html[r.html.index("<article>") : r.html.index("</article>")]
        blocks = re.split(r"</?(?:p|h1|article)[^>]*>", body.replace("<br>", " "))
        plain = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
        assert r.text == "\n\n".join(b for b in plain if b)


# --- near-duplicates


def slow_simhash(text, words):
    parts = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def smallest_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_near_duplicates(docs, none, corpus):
    edited = corpus.where("doc_id < 60").select((F.col("doc_id") + 10_000).alias("doc_id"), F.concat("text", F.lit(" end")).alias("text"))
    for df in (docs, corpus.select("doc_id", "text").unionByName(edited)):
        got = near_dedup.near_duplicates(df).collect()
        rows = Counter((r.doc_id, f"{slow_simhash(r.text, 3):016x}") for r in df.collect())
        assert Counter((r.doc_id, r.fingerprint) for r in got) == rows
        ids = defaultdict(list)
        for r in got:
            ids[int(r.fingerprint, 16)].append(r.doc_id)
        prints = sorted(ids)
        near = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 3]
        label = smallest_of(prints, near)
        least = defaultdict(list)
        for f in prints:
            least[label[f]] += [i for i in ids[f] if i is not None]
        for r in got:
            own = least[label[int(r.fingerprint, 16)]]
            assert r.component_id == (min(own) if own else None)
    assert near_dedup.near_duplicates(none).count() == 0


def test_dense_groups_of_fingerprints(spark):
    """Thousands of fingerprints around one, chains of single bits, and random ones: links join all that are near."""
    rng, centre = random.Random(7), 0x0123456789ABCDEF
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(1500)}
    prints |= {rng.getrandbits(64) for _ in range(500)} | {(1 << k) - 1 for k in range(40)}
    frame = spark.createDataFrame([(near_dedup.signed(f),) for f in prints], "fp long").repartition(4)
    joined = {r.node: r.least for r in components(near_dedup.links(frame)).collect()}
    a = np.array(sorted(near_dedup.signed(f) for f in prints), np.int64)
    near = [(int(a[i]), int(x)) for i in range(len(a)) for x in a[i + 1 :][np.bitwise_count(a[i + 1 :] ^ a[i]) <= 3]]
    want = smallest_of([int(x) for x in a], near)
    assert {n: joined.get(n, n) for n in want} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 30)]
    star = [(100, 101 + i) for i in range(300)]
    got = {r.node: r.least for r in components(spark.createDataFrame(chain + star + [(500, 500)], "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{101 + i: 100 for i in range(300)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each(docs, none):
    kept = texts(near_dedup.one_of_each(docs.where("doc_id IS NOT NULL"), words=5))
    assert [i for i, _ in kept] == [1, 3, 6, 8, 9, 10, 11] or [i for i, _ in kept] == [1, 3, 6, 7, 8, 9, 10, 11]
    assert near_dedup.one_of_each(none).columns == none.columns
    assert near_dedup.one_of_each(docs.where("doc_id IS NULL")).count() == 1


def test_one_of_each_keeps_unrelated_texts_without_or_with_one_id(spark):
    rows = [(None, EN), (None, ES), (None, ES), (5, "alpha beta gamma delta epsilon zeta"), (5, "one two three four five six"), (5, "red green blue black white grey")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for words, kept in ((3, 5), (5, 5)):
        got = [(r.doc_id, r.text) for r in near_dedup.one_of_each(frame, words=words).collect()]
        assert len(got) == len(set(got)) == kept and set(got) == set(rows)


# --- fingerprints


def test_fingerprints_and_edits(docs, none, corpus, monkeypatch):
    monkeypatch.setattr(fingerprints, "SLICE_BYTES", 20_000)
    for df in (docs, corpus, corpus.where("doc_id = 3")):
        rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect()))
        got = fingerprints.fingerprint_documents(df).collect()
        assert len(got) == len(rows)
        of_text, edits = {}, Counter()
        for k, (_, doc_id, text) in enumerate(rows):
            after, half = rows[(k + 1) % len(rows)][2], len(text) // 2
            edits[doc_id, hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest(), len(text)] += 1
        ties = Counter(doc_id for _, doc_id, _ in rows)
        assert all(edits[r.doc_id or 0, r.edited_sha256, r.n_chars] for r in got if ties[r.doc_id or 0] == 1)
        by_id = {r.doc_id or 0: r for r in got}
        for k, (_, doc_id, text) in enumerate(rows):
            if ties[doc_id] == 1:
                r, after = by_id[doc_id], by_id[rows[(k + 1) % len(rows)][1]]
                assert of_text.setdefault(text, r.fingerprint) == r.fingerprint
                assert r.near_next == 1 - (int(r.fingerprint, 16) ^ int(after.fingerprint, 16)).bit_count() / 64
                assert r.near_edited == 1 - (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count() / 64
    assert fingerprints.fingerprint_documents(none).count() == 0


def test_block_tables_find_all_within_radius(spark):
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(200)]
    every = sorted({near_dedup.signed(b ^ sum(1 << k for k in rng.sample(range(64), n))) for b in base for n in (0, 1, 2, 3, 4, 5)})
    asked = [near_dedup.signed(b) for b in base]
    index = spark.createDataFrame([(f,) for f in every], "fp long")
    got = [(r.query, r.fp) for r in fingerprints.within_radius(spark.createDataFrame([(f,) for f in asked], "query long"), index).collect()]
    want = {(q, f) for q in asked for f in every if ((q ^ f) & (2**64 - 1)).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want


# --- mixing


def test_raking_equals_numpy(spark, corpus, docs, none):
    targets = {"source": {"src0": 0.3, "src1": 0.1, "nowhere": 0.3}, "lang": {"en": 0.5, "fr": 0.3}}
    rows = mixing.with_probabilities(corpus, targets, rounds=15).collect()
    dims = [[getattr(r, d) for r in rows] for d in ("source", "lang", "topic")]
    codes = [np.unique(d, return_inverse=True) for d in dims]
    tokens = np.array([r.tokens for r in rows], float)
    cube = np.zeros([len(c[0]) for c in codes])
    np.add.at(cube, tuple(c[1] for c in codes), tokens)
    wanted = []
    for k, name in enumerate(("source", "lang", "topic")):
        share = cube.sum(axis=tuple(a for a in range(3) if a != k)) / cube.sum()
        w = np.array([targets.get(name, {}).get(v, s) if name in targets else s**mixing.TEMPER for v, s in zip(codes[k][0], share, strict=True)])
        wanted.append(w / w.sum() * cube.sum())
    fit = cube.copy()
    for _ in range(2000):
        for k in range(3):
            at = fit.sum(axis=tuple(a for a in range(3) if a != k))
            fit *= (wanted[k] / at).reshape([-1 if a == k else 1 for a in range(3)])
    ratio = np.divide(fit, cube, out=np.zeros_like(fit), where=cube > 0)
    want = (ratio / ratio.max())[tuple(c[1] for c in codes)]
    assert np.allclose([r.probability for r in rows], want, rtol=5e-3)
    messy = mixing.with_probabilities(docs.withColumn("Topic", F.lit(9))).collect()
    assert len(messy) == len(MESSY) and all(0 <= r.probability <= 1 for r in messy)
    assert len({(r.probability, r.sampled) for r in messy if r.doc_id == 2}) == 1
    assert mixing.with_probabilities(none).count() == 0


def test_one_rare_document_moves_no_other(spark, corpus):
    names = ["doc_id", "text", "source", "lang"]
    rare = spark.createDataFrame([(99_999, "word @ " * 25, "new", "xx")], "doc_id long, text string, source string, lang string")
    before, after = (
        {r.doc_id: r.probability for r in mixing.with_probabilities(df, share=0.6, rounds=6).collect()}
        for df in (corpus.select(names), corpus.select(names).unionByName(rare))
    )
    assert after[99_999] == 1 and all(abs(after[i] - p) < 0.01 for i, p in before.items())


# --- neighbours


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)) * rng.uniform(0.5, 2, (1500, 1))
    x[200:260] = x[200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist())]
    rows += [(9000, None), (9020, [0.0] * 24), (9040, [float("nan")] * 24), (9060, [1.0] * 23 + [None]), (None, x[3].tolist()), (9080, [float("inf")] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.nearest(frame, frame.where("vec_id % 20 = 0")).collect():
        got[r.query_id].append(r)
    assert set(got) == set(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        found.sort(key=lambda r: r.rank)
        scores = x @ x[q]
        scores[q] = -np.inf
        best = set(np.lexsort((np.arange(len(x)), -np.round(scores, 10)))[:20].tolist())
        hits += len(best & {r.vec_id for r in found})
        assert [r.rank for r in found] == list(range(1, 21))
        assert all(abs(r.score - scores[r.vec_id]) < 1e-9 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    assert hits / (20 * len(got)) > 0.9
    few = frame.where("vec_id < 5 OR vec_id > 8000")
    assert [(r.vec_id, r.rank) for r in neighbours.nearest(few, few.where("vec_id = 0")).collect()].__len__() == 4
    assert neighbours.nearest(few, few.where("vec_id = 0"), functions=2, tables=1, probes=1).count() == 4
    assert neighbours.nearest(frame.limit(0), frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        neighbours.nearest(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"), frame)


def test_neighbours_in_small_blocks(spark):
    """Buckets cut into blocks and queries cut into parts find the same; floats are scored as doubles."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[100:400] = x[100]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    asked = frame.where("vec_id % 5 = 0")
    rows = lambda **how: sorted(tuple(r) for r in neighbours.nearest(frame, asked, 5, **how).collect())
    whole = rows()
    assert rows(block=40, queries_at_most=30) == whole
    assert {q for q, *_ in whole} == set(range(0, 600, 5)) and len(whole) == 600
    wide = x.astype(np.float64)
    assert all(abs(s - wide[q] @ wide[v]) < 1e-12 for q, _, v, s in whole)
    assert [v for q, _, v, _ in whole if q == 200] == [100, 101, 102, 103, 104]


# --- byte-level BPE


def reference_encoder():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library(docs, none, corpus):
    encoder = reference_encoder()
    for df in (docs, corpus):
        coded = byte_bpe.with_digests(df.withColumn("IDS_sha256", F.lit(0)), RANKS, public_tokenizers.PATTERN)
        for r in coded.collect():
            ids = encoder.encode_ordinary(r.text or "")
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = byte_bpe.with_decoded(byte_bpe.with_ids(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert byte_bpe.with_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0
    rng, codec = random.Random(6), byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    for _ in range(3000):
        text = "".join(rng.choice("aabe  \n\t'sé中😀.,19'll\x00") for _ in range(rng.randint(0, 50)))
        assert [i for ids in codec.encode(text) for i in ids] == encoder.encode_ordinary(text)


def test_long_texts_in_parts(monkeypatch):
    from orderflow.llm import common

    encoder, codec = reference_encoder(), byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    text = (EN + "  \n " + ES + " '12") * 50
    whole = byte_bpe.digest(text, codec)
    monkeypatch.setattr(common, "LONG", 100)
    monkeypatch.setattr(common, "WORDS_AT_ONCE", 7)
    assert byte_bpe.digest(text, codec) == whole and whole[0] == len(encoder.encode_ordinary(text))
    count = piece_counts.count_tokens([text], PIECES)
    monkeypatch.setattr(piece_counts, "CHUNK", 50)
    assert piece_counts.count_tokens([text], PIECES) == count
