"""Ordered top-k reports (the limit is the feature; ties are broken by the key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def largest(df: DataFrame, measure: str, key: str, k: int = 10) -> DataFrame:
    return df.orderBy(F.desc(measure), F.asc(key)).limit(k)


def earliest(df: DataFrame, time: str, key: str, k: int = 10) -> DataFrame:
    return df.orderBy(F.asc(time), F.asc(key)).limit(k)
