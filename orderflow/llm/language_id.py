"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text knows every substring of it. A word of a new text
is parsed greedily into the longest phrases that each automaton knows; few phrases mean a familiar
language. The entropy of a text in a language is (phrases + unknown characters) * bits / characters, summed over
all words of the whole text, with the same bits for every language: log2 of the most characters that any was learned from.
So phrases don't become cheap by learning little, and a character the language never showed costs its phrase and a literal. The
language with the lowest entropy wins, the first by name on ties.
The parse starts anew at each word, so it measures how words are built, not which ones follow.

The automata are learned from a bounded sample: distinct texts in the order of their hash, at most ``per_language`` of them and
``characters`` of their words for each language. Of a language no more than ``TEXT_FOR_WORDS * characters`` code points of each text are
read, and no further text behind as many; that is cut where the rows lie. More than LANGUAGES languages are an error, so what the driver
gathers and broadcasts is bounded (about 2 states and 3 transitions for a character, walked by numpy for all new words at once).

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is everything
if nothing was learned. Numbers such as fractions or Roman numerals are no letters. A null doc_id is never held out. Training rows with null
text or lang are not used, equal texts count once; a language whose sampled texts hold no
letter is not learned. Score: the winner's part of the sum of inverse entropies. All columns are kept, of equal
names the made one stays; repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import keep_names, latest, matches, or_empty, pieces
from orderflow.session import pin

UNKNOWN = "und"
PER_LANGUAGE, CHARACTERS, BROADCAST_ROWS, LANGUAGES, TEXT_FOR_WORDS = 200, 60_000, 100_000, 500, 4
SALTS, CACHE, BATCH = 64, 250_000, 10_000
#: Words of texts whose phrases are looked up together.
WORDS_TOGETHER = 200_000


def _letters() -> re.Pattern:
    """Runs of Unicode letters. ``re`` looks up characters of the basic plane in one table, but tries every other member of a set
    in turn, for each character of the text: the other planes' letters stand apart, where only their characters come."""

    def members(first: int, last: int) -> str:
        found = re.finditer("1+", "".join("01"[chr(n).isalpha()] for n in range(first, last + 1)))
        return "".join(f"\\U{first + m.start():08x}-\\U{first + m.end() - 1:08x}" for m in found)

    basic, others = members(0, 0xFFFF), members(0x10000, sys.maxunicode)
    return re.compile(rf"(?:[{basic}]++|(?=[\U00010000-\U0010ffff])[{others}]++)+")


WORDS = _letters()


@dataclass(frozen=True)
class Automaton:
    """Suffix automaton as sorted arrays: ``keys`` are state * width + character, ``to`` the states behind."""

    lang: str
    learned: int
    width: int
    codes: np.ndarray
    keys: np.ndarray
    to: np.ndarray

    @classmethod
    def of(cls, lang: str, text: str) -> "Automaton":
        nexts, link, length, last = [{}], [-1], [0], 0
        for c in text:
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(nexts)
                    nexts.append(dict(nexts[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nexts[p].get(c) == q:
                        nexts[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        codes = np.array(sorted({ord(c) for c in text}), np.int64)
        place = {chr(c): n for n, c in enumerate(codes.tolist())}
        width = len(codes) + 1
        moves = sorted((s * width + place[c], t) for s, d in enumerate(nexts) for c, t in d.items())
        keys, to = np.array([m[0] for m in moves], np.int64), np.array([m[1] for m in moves], np.int64)
        return cls(lang, len(text), width, codes, keys, to)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """State behind, 0 where there is none."""
        key = state * self.width + char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], 0)

    def phrases(self, code: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of each word; words are ``code[start : start + length]``, longest first."""
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        char = np.where(self.codes[at] == code, at, self.width - 1)
        state, count = np.zeros(len(start), np.int64), np.ones(len(start), np.int64)
        for k in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -k, side="left"))  # words with more than k characters
            c, s = char[start[:n] + k], state[:n]
            t = self.step(s, c)
            broken = np.flatnonzero(t == 0)
            # A character that doesn't follow starts a phrase, and so does any behind an unknown one.
            if k:
                count[:n] += (t == 0) | (s == 0)
            t[broken] = self.step(np.zeros(len(broken), np.int64), c[broken])
            state[:n] = t
        return count


class Identifier:
    def __init__(self, automata: list[Automaton]):
        self.automata = sorted(automata, key=lambda a: a.lang)
        self.bits = math.log2(max([a.learned for a in self.automata], default=2))

    def count(self, words: list[str]) -> np.ndarray:
        whole = sorted(((" " + w, n) for n, w in enumerate(words)), key=lambda x: -len(x[0]))
        length = np.fromiter((len(w) for w, _ in whole), np.int64, len(whole))
        code = np.frombuffer("".join(w for w, _ in whole).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start = np.cumsum(length) - length
        out = np.empty((len(words), len(self.automata)), np.int64)
        place = np.fromiter((n for _, n in whole), np.int64, len(whole))
        for k, a in enumerate(self.automata):
            out[place, k] = a.phrases(code, start, length)
        return out

    def costs(self, words: list[str]) -> np.ndarray:
        """Phrases and unknown characters of each word in each language."""
        out = self.count(words)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start = np.cumsum([0, *map(len, words)])
        for k, a in enumerate(self.automata):
            unknown = np.concatenate(([0], np.cumsum(~np.isin(code, a.codes))))
            out[:, k] += unknown[start[1:]] - unknown[start[:-1]]
        return out

    def judge(self, phrases: np.ndarray, characters: int) -> tuple[str, float]:
        if not characters or not len(self.automata):
            return UNKNOWN, 0.0
        inverse = 1 / (phrases * self.bits)
        best = int(np.argmax(inverse))
        return self.automata[best].lang, float(inverse[best] / inverse.sum())


class Seen:
    """Words seen by a worker with one model, and their rows of phrase counts."""

    def __init__(self, languages: int):
        self.place: dict[str, int] = {}
        self.counts = np.zeros((1024, languages), np.int32)

    def learn(self, model: Identifier, words: set[str]) -> None:
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > CACHE:
            self.place.clear()
            new = list(words)
        n = len(self.place)
        while n + len(new) > len(self.counts):
            self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
        for k in range(0, len(new), BATCH):
            some = new[k : k + BATCH]
            self.counts[n + k : n + k + len(some)] = model.costs(some)
        self.place.update(zip(new, range(n, n + len(new)), strict=True))


def identify(texts: list[str], model: Identifier, token: str = "") -> list[tuple[str, float]]:
    seen = latest(("language", token), lambda: Seen(len(model.automata)))
    waiting, n = [], 0
    totals = np.zeros((len(texts), len(model.automata)), np.int64)
    characters = [0] * len(texts)

    def settle() -> None:
        nonlocal n
        if model.automata:
            seen.learn(model, set().union(*(w for _, w in waiting)))
            get, counts = seen.place.__getitem__, seen.counts
            for i, words in waiting:
                totals[i] += counts[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0)
        waiting.clear()
        n = 0

    for i, text in enumerate(texts):
        for words in matches(WORDS, (text or "").lower()):
            characters[i] += sum(map(len, words)) + len(words)
            waiting.append((i, words))
            n += len(words)
            if n > WORDS_TOGETHER:
                settle()
    settle()
    return [model.judge(totals[i], characters[i]) for i in range(len(texts))]


def training_sample(
    docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE
) -> DataFrame:
    """At most ``per_language`` (lang, text) of each language. Ranked in salted parts first, so that no
    task sorts a whole language; only hashes are ranked, texts are fetched for the chosen ones."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )
    hashes = rows.select("lang", "h").distinct().withColumn("salt", F.pmod("h", F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
        hashes = hashes.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank")
    chosen = pin(hashes.select("lang", "h"))
    # Texts are moved only if the chosen hashes are too many to broadcast, that is with very many languages.
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    return rows.join(chosen, ["lang", "h"]).dropDuplicates(["lang", "h"])


def learn(sample: DataFrame, characters: int = CHARACTERS) -> Identifier:
    """Automata of the bounded sample (lang, text, h), built on the driver."""
    most, texts = TEXT_FOR_WORDS * characters, {}
    names = sample.select("lang").distinct().limit(LANGUAGES + 1).count()
    if names > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    before = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    cut = sample.withColumn("text", F.substring("text", 1, most)).withColumn("before", F.sum(F.char_length("text")).over(before))
    cut = cut.where(F.coalesce("before", F.lit(0)) < most).select("lang", "text", "h")
    for row in cut.orderBy("lang", "h").toLocalIterator():
        texts.setdefault(row["lang"], []).append(row["text"])
    automata = []
    for lang, some in texts.items():
        words, n = [], 0
        for word in (w for t in some for part in matches(WORDS, t.lower()) for w in part):
            if n + len(word) + 1 > characters:
                break
            words.append(word)
            n += len(word) + 1
        if words:
            automata.append(Automaton.of(lang, " " + " ".join(words) + " "))
    return Identifier(automata)


def with_language(docs: DataFrame, model: Identifier, text: str = "text") -> DataFrame:
    """Adds lang_pred and score to every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    token = f"{id(sent)}-{sent._jbroadcast.id()}"  # a worker keeps word counts of one model only

    @F.pandas_udf("lang_pred string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in (p for batch in batches for p in pieces(batch)):
            yield pd.DataFrame(identify(batch.tolist(), sent.value, token), columns=["lang_pred", "score"])

    made = ("lang_pred", "score")
    return docs.select(*keep_names(docs, *made), identified(or_empty(text)).alias("_found")).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made], "_found.lang_pred", "_found.score"
    )


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Identifier:
    """Model of the rows that are not held out (a null doc_id is never held out)."""
    return learn(training_sample(docs.where(~held_out(doc_id)), text, lang))
