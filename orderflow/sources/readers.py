"""Table readers: declared schemas for production, full-scan inference as a convenience."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.contract import TableSpec

CORRUPT = "_corrupt_record"


class SourceMissing(FileNotFoundError):
    """A declared table has no files."""


def read_csv(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    columns: Sequence[str] | None = None,
    keep_corrupt: bool = False,
    strict: bool = False,
) -> DataFrame:
    """CSV with header and the declared types. A value that doesn't fit its type is NULL; ``keep_corrupt`` adds the whole
    row as text in CORRUPT, ``strict`` ends the read at it. Both parse all columns, so that the rows found don't depend
    on the columns asked for."""
    schema = T.StructType([*spec.schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else spec.schema
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if keep_corrupt or strict:
        reader = reader.option("columnPruning", False)
    df = _guarded(spec.name, path, lambda: reader.csv(path))
    return df.select(*columns) if columns else df


def split_malformed(spark: SparkSession, spec: TableSpec, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the declared types, and the others with their text in CORRUPT."""
    rows = read_csv(spark, spec, path, keep_corrupt=True)
    fit = F.col(CORRUPT).isNull()
    return rows.where(fit).drop(CORRUPT), rows.where(~fit)


def malformed_rows(spark: SparkSession, specs: Mapping[str, TableSpec], paths: Mapping[str, str]) -> DataFrame:
    """One row per table: rows, rows that don't fit the declared types, and a checksum of all values."""
    counts = [
        read_csv(spark, spec, paths[name], keep_corrupt=True)
        .select(F.col(CORRUPT).isNotNull().alias("unfit"), F.xxhash64(*spec.schema.names).alias("h"))
        .agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if("unfit").alias("malformed_rows"),
            F.bit_xor("h").alias("checksum"),
        )
        for name, spec in specs.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def infer_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """CSV with types inferred from a full scan (one extra pass over the file)."""
    reader = spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", 1.0)
    reader = reader.option("preferDate", False)
    return _guarded(name, path, lambda: reader.csv(path))


def read_parquet(spark: SparkSession, name: str, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = _guarded(name, path, lambda: spark.read.parquet(path))
    return df.select(*columns) if columns else df


def read_tables(spark: SparkSession, specs: Mapping[str, TableSpec], paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """All declared tables by name; a row that doesn't fit its declared types ends the read (see split_malformed)."""
    return {name: read_csv(spark, spec, paths[name], strict=True) for name, spec in specs.items()}


def file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """File names and sizes below a folder; the contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("bytes"))


def _guarded(name: str, path: str, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceMissing(f"table {name}: nothing to read at {path}") from error
        raise
