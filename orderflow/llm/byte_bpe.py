"""Byte-level BPE through a sentencepiece model that is written straight from a vocabulary of ranks.

Each token's bytes become a piece of one character for a byte; its score is the negative rank, so that the
best-scoring merge is the one of lowest rank. The model has identity normalisation, no added or escaped spaces, and is
handed to sentencepiece as bytes; nothing is trained. Texts are cut into pre-tokens by the vocabulary's pattern, each is encoded by itself, and
ids are decoded by looking up their bytes. A pre-token that is itself a token gets that token's id, as rank-based encoders do.

Defined results: null texts are empty; empty texts have no ids. Only the text is looked at; repeated rows give equal results; all
columns are kept, of equal names the made one stays. A vocabulary without all single bytes is refused.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keep_names, latest, matches, or_empty, pieces

#: Byte b is written as the character FIRST + b; none of them is a space or a control character.
FIRST = 0x4E00
ALPHABET = "".join(chr(FIRST + b) for b in range(256))
#: Encoded pre-tokens kept between batches by a worker; new ones above that start over.
CACHE = 200_000
BATCH = 20_000
UNKNOWN = "<unk>"
# Field numbers and constants of sentencepiece's model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN_TYPE, BPE = 1, 2, 2


def _number(n: int) -> bytes:
    """Base-128 number; negative ones as 64-bit two's complement."""
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _whole(field: int, n: int) -> bytes:
    return _number(field << 3) + _number(n)


def _part(field: int, content: bytes) -> bytes:
    return _number(field << 3 | 2) + _number(len(content)) + content


def _piece(text: str, score: float, kind: int) -> bytes:
    return _part(PIECES, _part(1, text.encode()) + _number(2 << 3 | 5) + struct.pack("<f", score) + _whole(3, kind))


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        ranks = {int(n): base64.b64decode(token) for token, n in (line.split() for line in lines if line.strip())}
    tokens = [ranks[n] for n in range(len(ranks))]
    if missing := set(range(256)) - {t[0] for t in tokens if len(t) == 1}:
        raise ValueError(f"no token for the bytes {sorted(missing)}")
    return tokens


def model_bytes(tokens: list[bytes]) -> bytes:
    """Serialised model whose piece n is token n; the unknown piece comes behind them."""
    pieces = b"".join(_piece(codecs.charmap_decode(t, "strict", ALPHABET)[0], -float(n), NORMAL) for n, t in enumerate(tokens))
    trainer = b"".join((_whole(3, BPE), _whole(4, len(tokens) + 1), _whole(40, len(tokens)), _whole(41, -1), _whole(42, -1), _whole(43, -1)))
    normalizer = _part(1, b"identity") + _part(2, b"") + _whole(3, 0) + _whole(4, 0) + _whole(5, 0)
    return pieces + _piece(UNKNOWN, 0.0, UNKNOWN_TYPE) + _part(TRAINER, trainer) + _part(NORMALIZER, normalizer)


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.tokens = read_ranks(path)
        self.whole = {t: n for n, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.pattern = regex.compile(pattern)
        self.known: dict[str, list[int]] = {}

    def learn(self, words: set[str]) -> None:
        new = {w for w in words if w not in self.known}  # a set minus a key view would walk all keys
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = words
        parts = []
        for w in new:
            raw = w.encode("utf-8", "surrogatepass")
            if (n := self.whole.get(raw)) is not None:
                self.known[w] = [n]
            else:
                parts.append((w, codecs.charmap_decode(raw, "strict", ALPHABET)[0]))
        for at in range(0, len(parts), BATCH):
            some = parts[at : at + BATCH]
            ids = self.model.encode([p for _, p in some], num_threads=1)
            self.known.update(zip((w for w, _ in some), ids, strict=True))

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, in one list or several."""
        for words in matches(self.pattern, text):
            self.learn(set(words))
            known = self.known
            yield [i for w in words for i in known[w]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def codec(path: str, pattern: str) -> ByteBpe:
    return latest(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def digest(text: str, bpe: ByteBpe) -> tuple[int, str, str]:
    """Number of ids, hash of the ids, hash of what they decode to."""
    n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
    for ids in bpe.encode(text):
        if ids:
            of_ids.update((" " * bool(n) + " ".join(map(str, ids))).encode())
            of_bytes.update(bpe.decode(ids))
            n += len(ids)
    return n, of_ids.hexdigest(), of_bytes.hexdigest()


def with_ids(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds ids (array of int) and round_trip (they decode to the text's bytes again) to every row."""

    @F.pandas_udf("ids array<int>, round_trip boolean")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        for some in (p for batch in batches for p in pieces(batch)):
            ids = [np.array([i for ids in bpe.encode(t) for i in ids], np.int32) for t in some]
            back = [bpe.decode(i.tolist()) == t.encode("utf-8", "surrogatepass") for i, t in zip(ids, some, strict=True)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "round_trip": back})

    made = ("ids", "round_trip")
    return docs.select(*keep_names(docs, *made), encoded(or_empty(text)).alias("_made")).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made], *[f"_made.{m}" for m in made]
    )


def with_decoded(docs: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds decoded (binary): the bytes that ids stand for, null for null ids."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = codec(path, pattern)
        for batch in (p for batch in batches for p in pieces(batch)):
            yield pd.Series([None if i is None else bpe.decode(i) for i in batch], dtype=object)

    return docs.select(*keep_names(docs, "decoded"), decoded(F.col(ids)).alias("decoded"))


def with_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 to every row: encoded and decoded in one go."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        for batch in (p for batch in batches for p in pieces(batch)):
            yield pd.DataFrame([digest(t, bpe) for t in batch], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    made = ("n_tokens", "ids_sha256", "decoded_sha256")
    return docs.select(*keep_names(docs, *made), digested(or_empty(text)).alias("_made")).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made], *[f"_made.{m}" for m in made]
    )
