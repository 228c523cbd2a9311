"""Preparation steps that learn from the training part only.

Learned state is a handful of numbers or words per column, kept in ML params so that every stage is
saved with its pipeline. The one table-sized state (category frequencies) stays a DataFrame.
"""

from __future__ import annotations

import json
import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.columns import number_sql
from orderflow.functions.derived import add_derived
from orderflow.operators.ordering import medians
from orderflow.operators.profile import long_numbers
from orderflow.session import pin


class _HasState(Params):
    """Learned values as JSON: readable in the saved metadata, no pickling."""

    state = Param(Params._dummy(), "state", "learned values as JSON", TypeConverters.toString)

    def learned(self):
        return json.loads(self.getOrDefault(self.state))


class _Columns(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})


class _ColumnsModel(Model, HasInputCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, state=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})


class ExactMedianImputer(Estimator, _Columns):
    """Fill gaps with the exact median of the training part (0 for a column without any value)."""

    def _fit(self, dataset: DataFrame) -> "ExactMedianImputerModel":
        columns = self.getInputCols()
        found = medians(long_numbers(dataset, columns), "value", ["column_name"])
        middle = {r["column_name"]: r["median"] for r in found.collect()}
        fills = {c: middle.get(c, 0.0) for c in columns}
        return ExactMedianImputerModel(inputCols=columns, state=json.dumps(fills))


class ExactMedianImputerModel(_ColumnsModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = self.learned()
        return dataset.withColumns(
            {c: F.expr(f"coalesce({number_sql(c)}, {fills[c]!r}D)") for c in self.getInputCols()}
        )


class Standardizer(Estimator, _Columns):
    """Subtract the mean and divide by the population deviation (1 where there is none)."""

    def _fit(self, dataset: DataFrame) -> "StandardizerModel":
        columns = self.getInputCols()
        row = dataset.selectExpr(
            *[f"avg(`{c}`) AS `m_{c}`" for c in columns], *[f"stddev_pop(`{c}`) AS `s_{c}`" for c in columns]
        ).first()
        scale = {c: [row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0] for c in columns}
        return StandardizerModel(inputCols=columns, state=json.dumps(scale))


class StandardizerModel(_ColumnsModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        scale = self.learned()
        return dataset.withColumns(
            {c: F.expr(f"(`{c}` - {scale[c][0]!r}D) / {scale[c][1]!r}D") for c in self.getInputCols()}
        )


class ModeImputer(Estimator, _Columns):
    """Fill gaps with the most frequent category (the smallest among equals) and make all text."""

    def _fit(self, dataset: DataFrame) -> "ModeImputerModel":
        columns = self.getInputCols()
        texts = dataset.select(*[F.col(c).cast("string").alias(c) for c in columns])
        counts = (
            texts.unpivot([], columns, "feature", "category")
            .where(F.col("category").isNotNull())
            .groupBy("feature", "category")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        best = F.min_by("category", F.struct(-F.col("n"), F.col("category").try_cast("double"), F.col("category")))
        found = {r["feature"]: r["mode"] for r in counts.groupBy("feature").agg(best.alias("mode")).collect()}
        return ModeImputerModel(inputCols=columns, state=json.dumps({c: found.get(c, "") for c in columns}))


class ModeImputerModel(_ColumnsModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = self.learned()
        return dataset.withColumns(
            {c: F.coalesce(F.col(c).cast("string"), F.lit(fills[c])) for c in self.getInputCols()}
        )


class DerivedFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds every derived feature whose inputs are present."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_derived(dataset)


# --- category frequency -------------------------------------------------------------------------


class _InOut(HasInputCol, HasOutputCol):
    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})


class FrequencyEncoder(Estimator, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Share of training rows that hold the category."""

    def _fit(self, dataset: DataFrame) -> "FrequencyEncoderModel":
        name = self.getInputCol()
        counts = dataset.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        total = dataset.agg(F.count(name).alias("total"))
        shares = counts.select(F.col(name).alias("category"), (F.col("n") / total.scalar()).alias("share"))
        model = FrequencyEncoderModel(inputCol=name, outputCol=self.getOutputCol())
        # Frozen here: later reads neither aggregate the training rows again nor follow changes of their files.
        model.shares = pin(shares)
        return model


class FrequencyEncoderModel(Model, _InOut, MLWritable, MLReadable):
    """Looks the share up; a category the training part never had gets 0.

    The lookup is a plain left join: Catalyst broadcasts the table while it is small and splits
    skewed partitions of the big side when it is not.
    """

    shares: DataFrame

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = self.shares.select(F.col("category").alias("_category"), F.col("share").alias("_share"))
        joined = dataset.join(table, F.col(self.getInputCol()) == F.col("_category"), "left")
        return joined.withColumn(self.getOutputCol(), F.coalesce("_share", F.lit(0.0))).drop("_category", "_share")

    def write(self) -> MLWriter:
        return _FrequencyWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FrequencyReader()


class _FrequencyWriter(MLWriter):
    def __init__(self, instance: FrequencyEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.shares.write.mode("overwrite").parquet(os.path.join(path, "shares"))


class _FrequencyReader(MLReader):
    def load(self, path: str) -> FrequencyEncoderModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = FrequencyEncoderModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.shares = spark.read.parquet(os.path.join(path, "shares"))
        return model


# --- assembly -----------------------------------------------------------------------------------


def one_hot_stages(columns: list[str]) -> list:
    """Sorted categories, nothing dropped; a category unknown to the training part is all zeros (it
    falls into the extra slot that the encoder drops)."""
    indexed, encoded = [f"{c}_index" for c in columns], [f"{c}_hot" for c in columns]
    indexer = StringIndexer(
        inputCols=columns, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return [indexer, OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)]


def preparation_stages(numerical: list[str], categorical: list[str], output: str = "features") -> list:
    """Impute and scale numbers, impute and encode categories, one sparse vector column."""
    return [
        ExactMedianImputer(inputCols=numerical),
        Standardizer(inputCols=numerical),
        ModeImputer(inputCols=categorical),
        *one_hot_stages(categorical),
        VectorAssembler(inputCols=[*numerical, *[f"{c}_hot" for c in categorical]], outputCol=output),
    ]


def feature_names(prepared: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, from its ML attributes."""
    groups = prepared.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in slots]


def learned_state(stages: list) -> dict[str, dict]:
    """What the fitted stages learned: fills, scales and category counts, by stage name."""
    report: dict[str, dict] = {}
    for stage in stages:
        if isinstance(stage, _ColumnsModel):
            report[type(stage).__name__] = stage.learned()
        elif hasattr(stage, "labelsArray"):
            names = stage.getInputCols()
            report["category_counts"] = {c: len(labels) for c, labels in zip(names, stage.labelsArray)}
    return report


def finite_check(prepared: DataFrame, column: str = "features") -> DataFrame:
    """Rows, vector width and how many rows hold a value that is not a finite number."""
    values = vector_to_array(F.col(column))
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return prepared.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(F.size(values)).cast("bigint").alias("width"),
        F.count_if(bad).alias("rows_not_finite"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (2 * n_class) of each class and the ratio of negatives to positives."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    ratio = df.agg(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("r"))
    return counts.select(
        "label",
        "row_count",
        (total.scalar() / (2 * F.col("row_count"))).alias("balanced_weight"),
        ratio.scalar().cast("double").alias("positive_weight"),
    )
