"""Small helpers shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Texts above this many characters are cut into words piece by piece, so that the list of words of
#: one very long text is never whole in memory.
LONG = 1_000_000
WORDS_AT_ONCE = 200_000
PIECE = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else untouched."""
    return F.translate(text, UPPER, LOWER)


def or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def keep_names(df: DataFrame, *made: str) -> list[Column]:
    """The columns of ``df`` but for those an operator makes anew."""
    clash = {m.lower() for m in made}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in clash]


_LATEST: dict = {}


def latest(key: tuple, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept by a worker until another is asked for: a worker that serves several
    operators one after the other holds the model and cache of one."""
    if key not in _LATEST:
        _LATEST.clear()
        _LATEST[key] = build()
    return _LATEST[key]


def pieces(batch: pd.Series) -> Iterator[pd.Series]:
    """A batch in parts of PIECE rows, so that results of long texts don't wait for thousands of others."""
    for at in range(0, len(batch), PIECE):
        yield batch.iloc[at : at + PIECE]


def matches(pattern: re.Pattern, text: str) -> Iterator[list[str]]:
    """All matches of ``pattern``, as one list or, for a very long text, as several."""
    if len(text) <= LONG:
        yield pattern.findall(text)
        return
    found = (m.group() for m in pattern.finditer(text))
    while part := list(islice(found, WORDS_AT_ONCE)):
        yield part
