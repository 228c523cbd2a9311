"""Token counts of a sentencepiece BPE vocabulary by rank-synchronous merging of arrays.

A text is cut into pre-tokens: no piece holds a space mark after another character, so no merge crosses
the front of a run of spaces. The new pre-tokens of a batch lie behind each other in one array of symbol
ids. In each round every sequence applies its own lowest-rank pair, all sequences at once; what is left
at the end is the count, a symbol that is no piece standing for its UTF-8 bytes. A sequence is first
cut wherever no piece holds the two neighbouring characters, which also keeps text without spaces short.

Several places of the same pair are merged in one round from left to right, unless a merge would make a
pair of still lower rank; then only the leftmost place is merged, as the sequential rule would.

Defined results: null and empty texts have no bytes and no tokens; only the text is looked at, so ties and
repeated rows give equal counts; every other column is kept, of equal names the made one stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keep_names, latest, matches, or_empty

MARK = "▁"
#: Counts of pre-tokens kept between batches by a worker; new ones above that start over.
CACHE = 400_000
#: Characters of text looked at together.
CHUNK = 4_000_000
#: Pre-tokens merged together: their arrays then fit a core's cache.
BATCH = 10_000
NEVER = np.int32(2**31 - 1)
GAPS = re.compile(" +[^ ]*")


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ranks = {}
        for i in range(model.get_piece_size()):
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i)):
                ranks[model.id_to_piece(i)] = -model.get_score(i)
        if any(MARK in p.lstrip(MARK) for p in ranks):
            raise ValueError("a piece of this vocabulary crosses a space")
        # Ids: pieces by their order, then characters that occur in pieces only.
        ids = {p: n for n, p in enumerate(ranks)}
        for c in {c for p in ranks for c in p}:
            ids.setdefault(c, len(ids))
        self.width, self.pieces = len(ids) + 1, len(ranks)
        order = {r: n for n, r in enumerate(sorted(set(ranks.values())))}
        pairs, inside = {}, set()
        for p, rank in ranks.items():
            inside.update(zip(p, p[1:], strict=False))
            for k in range(1, len(p)):
                left, right = ids.get(p[:k]), ids.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (order[rank], ids[p])
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.of_code = np.full(0x110000, -1, np.int32)
        for c in (c for c in ids if len(c) == 1):
            self.of_code[ord(c)] = ids[c]
        self.joined = np.array(sorted(ids[a] * self.width + ids[b] for a, b in inside), np.int64)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; NEVER where the two don't merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NEVER), self.made[at]

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token, given without its first space mark."""
        whole = [MARK + w.replace(" ", MARK) for w in words]
        lengths = np.fromiter(map(len, whole), np.int64, len(whole))
        code = np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.repeat(np.arange(len(whole)), lengths)
        sym = self.of_code[code]
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        left, right = sym[:-1].astype(np.int64), sym[1:]
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)
        linked = (self.joined[at] == key) & (left >= 0) & (right >= 0) & (word[:-1] == word[1:])
        seq = np.concatenate(([0], np.cumsum(~linked))).astype(np.int64)
        out = np.zeros(len(whole), np.int64)
        rank = np.full(len(sym), NEVER, np.int32)
        made = np.zeros(len(sym), np.int32)
        if len(sym) > 1:
            r, m = self._look(sym[:-1], sym[1:])
            rank[:-1], made[:-1] = np.where(linked, r, NEVER), m
        while len(sym):
            start = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            span = np.diff(np.concatenate((start, [len(sym)])))
            least = np.repeat(np.minimum.reduceat(rank, start), span)
            done = least == NEVER
            if done.any():
                weight = np.where((sym[done] >= 0) & (sym[done] < self.pieces), 1, size[done])
                out += np.bincount(word[done], weights=weight, minlength=len(out)).astype(np.int64)
                on = ~done
                sym, seq, word, size, rank, made, least = (x[on] for x in (sym, seq, word, size, rank, made, least))
                if not len(sym):
                    break
            place = np.flatnonzero(rank == least)
            new = np.concatenate(([True], np.diff(place) != 1))
            run = np.maximum.accumulate(np.where(new, place, 0))
            place = place[(place - run) % 2 == 0]
            n, to = len(sym), made[place]
            # Pairs that the merges make: with the symbol before (perhaps just merged) and the one behind.
            merged_before = np.concatenate(([False], np.diff(place) == 2)) & (seq[np.maximum(place - 2, 0)] == seq[place])
            before = np.where(merged_before, np.concatenate(([0], to[:-1])), sym[np.maximum(place - 1, 0)])
            r1, _ = self._look(before, to)
            r1 = np.where((place > 0) & (seq[np.maximum(place - 1, 0)] == seq[place]), r1, NEVER)
            behind = np.minimum(place + 2, n - 1)
            r2, _ = self._look(to, sym[behind])
            r2 = np.where((place + 2 < n) & (seq[behind] == seq[place]), r2, NEVER)
            odd = np.minimum(r1, r2) < rank[place]
            if odd.any():
                one = np.isin(seq[place], seq[place[odd]])
                first = np.concatenate(([True], seq[place[1:]] != seq[place[:-1]]))
                place = place[~one | first]
                to = made[place]
            sym[place] = to
            keep = np.ones(n, bool)
            keep[place + 1] = False
            moved = np.cumsum(keep) - 1
            sym, seq, word, size, rank, made = (x[keep] for x in (sym, seq, word, size, rank, made))
            at = moved[place]
            touched = np.zeros(len(sym), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            fresh = np.flatnonzero(touched)
            last = fresh + 1 >= len(sym)
            rank[fresh[last]] = NEVER
            fresh = fresh[~last]
            r, m = self._look(sym[fresh], sym[fresh + 1])
            rank[fresh], made[fresh] = np.where(seq[fresh] == seq[fresh + 1], r, NEVER), m
        return out


def _counter(path: str) -> tuple[PieceCounter, dict[str, int]]:
    return latest(("pieces", path), lambda: (PieceCounter(path), {}))


def _pretokens(text: str) -> Iterator[list[str]]:
    """Pre-tokens without their first mark; a text begins with one mark more than it has itself."""
    if not text:
        return
    text = " " + text.replace(MARK, " ")
    if len(text) < CHUNK and "  " not in text and text[-1] != " ":
        yield text[1:].split(" ")
    else:
        for part in matches(GAPS, text):
            yield [p[1:] for p in part]


def count_tokens(texts: list[str], path: str) -> list[int]:
    counter, known = _counter(path)
    totals, waiting, n = [0] * len(texts), [], 0

    def settle() -> None:
        nonlocal n
        words = set().union(*(p for _, p in waiting))
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(words)
        for k in range(0, len(new), BATCH):
            some = new[k : k + BATCH]
            known.update(zip(some, counter.count(some).tolist(), strict=True))
        for i, parts in waiting:
            totals[i] += sum(map(known.__getitem__, parts))
        waiting.clear()
        n = 0

    for i, text in enumerate(texts):
        for parts in _pretokens(text or ""):
            waiting.append((i, parts))
            n += len(parts)
            if n > CHUNK // 16:
                settle()
    settle()
    return totals


def with_token_counts(docs: DataFrame, model_path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (n_tokens > limit) to every row."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(count_tokens(batch.tolist(), model_path), dtype="int64")

    made = ("n_bytes", "n_tokens", "over_limit")
    return docs.select(
        *keep_names(docs, *made),
        F.octet_length(or_empty(text)).cast("long").alias("n_bytes"),
        counted(or_empty(text)).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
