"""The batch scorer over a stream of order rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderflow.ml.score import Scorer


def read_orders(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder, read with the agreed schema."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_stream(
    orders: DataFrame,
    scorer: Scorer,
    output: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    available_now: bool = False,
) -> StreamingQuery:
    """Score rows as they arrive and append them to Parquet; the checkpoint makes restarts exact."""
    writer = (
        scorer.score(orders, keep)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
