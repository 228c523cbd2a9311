"""Sinks: compressed Parquet with a verified row count, stages that are skipped when complete, splits in time order, tables and reports."""

from __future__ import annotations

import hashlib
import json
import math
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from orderflow.operators.quality import table_counts

#: Rows of a file of a split; together with the time ranges they bound what a time filter reads.
ROWS_PER_FILE = 2_000_000


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite ``path`` with ZSTD Parquet."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def write_verified(df: DataFrame, path: str, partition_by: Sequence[str] = (), grain: DataFrame | None = None) -> int:
    """Write once, count the stored rows from the files' footers, and return them. ``grain`` is a frame that must have as many
    rows and is cheap to count, like the input a step keeps the rows of; the frame itself isn't computed again."""
    write_parquet(df, path, partition_by)
    found = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if grain is not None and (expected := grain.count()) != found:
        raise IOError(f"{path}: expected {expected} rows, found {found}")
    return found


# --- stages


def _status(spark: SparkSession, name: str) -> tuple[str, int, int]:
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
    return name, status.getLen(), status.getModificationTime()


def fingerprint(*inputs: DataFrame) -> str | None:
    """A digest of names, sizes and times of all files behind the inputs and of their columns; None if one isn't read from
    files, so that nothing can be said about it."""
    seen = []
    for df in inputs:
        files = sorted(df.inputFiles())
        if not files:
            return None
        seen.append([df.schema.jsonValue(), [_status(df.sparkSession, f) for f in files]])
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()


def _manifest(spark: SparkSession, path: str) -> dict | None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return json.loads(spark.read.text(path).first()["value"])


def run_stage(
    spark: SparkSession,
    folder: str,
    name: str,
    make: Callable[[], DataFrame],
    inputs: Sequence[DataFrame],
    grain: Callable[[], DataFrame] | None = None,
    check: Callable[[DataFrame], None] | None = None,
    write: Callable[[DataFrame, str, DataFrame | None], int] | None = None,
) -> bool:
    """Write ``folder/name`` unless a complete one made from the same input files is there; True if it was written.

    The manifest (fingerprint of the inputs, schema, rows) is written last, after ``check`` accepted the stored rows: what a lost
    run left half done has none and is made again."""
    path, note = os.path.join(folder, name), os.path.join(folder, "_manifests", name)
    print_ = fingerprint(*inputs)
    known = _manifest(spark, note)
    if known and print_ and known["fingerprint"] == print_:
        return False
    made = make()
    store = write or (lambda df, to, same: write_verified(df, to, grain=same))
    rows = store(made, path, grain() if grain else None)
    if check:
        check(spark.read.parquet(path))
    record = {"fingerprint": print_, "schema": spark.read.parquet(path).schema.jsonValue(), "rows": rows}
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(note)
    return True


def write_splits(
    df: DataFrame, path: str, time: str | None = None, grain: DataFrame | None = None, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """One folder per split, so that reading one part prunes the others. With a time, files hold ranges of it that don't overlap
    within a split, at most about ``rows_per_file`` rows each, sorted: a time filter skips files by their minimum and maximum."""
    if time is None:
        return write_verified(df, path, ["split"], grain)
    rows = (df if grain is None else grain).count()
    ranges = max(1, math.ceil(rows / rows_per_file))
    laid_out = df.repartitionByRange(ranges, "split", time).sortWithinPartitions("split", time)
    return write_verified(laid_out, path, ["split"], grain)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def write_report(df: DataFrame, path: str, kind: str = "csv", order: Sequence[str] = ()) -> None:
    """A report table as CSV with header or JSON lines, ordered by ``order`` over all its files, else by its text columns."""
    keys = list(order) or [name for name, kind_ in df.dtypes if kind_ == "string"]
    writer = (df.orderBy(*keys) if keys else df).write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def catalog_report(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Rows and columns of every table in the catalog."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    prefix = f"{database}." if database else ""
    return table_counts({n: spark.table(prefix + n) for n in names})
