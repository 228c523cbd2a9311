"""Scoring under the input contract: whole tables, records with a payload, and frozen test runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.contract import FeatureContract, require_columns
from orderflow.ml.models import PREDICTION, SCORE
from orderflow.operators.evaluate import DEFAULT_THRESHOLD, predict_class

PROBABILITY, CLASS, DAYS = "late_delivery_probability", "late_delivery_prediction", "predicted_delivery_days"


@dataclass(frozen=True)
class Scorer:
    """Both fitted pipelines with the threshold that was chosen for the classifier."""

    contract: FeatureContract
    classifier: PipelineModel
    regressor: PipelineModel
    threshold: float = DEFAULT_THRESHOLD

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Probability, class, threshold and days for every row; missing inputs are named in the error.

        Stateless row by row, so the same method serves batches and streams.
        """
        require_columns(df, [*self.contract.features, *keep])
        kept = [f"_keep_{c}" for c in keep]
        # Kept columns get their own names: preparation rewrites the inputs in place.
        inputs = df.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], *self.contract.features)
        features = self.contract.features
        late = self.classifier.transform(inputs.withColumn("_inputs", F.struct(*features)))
        once = late.select(*kept, F.col(SCORE).alias(PROBABILITY), "_inputs.*")
        days = self.regressor.transform(once)
        return days.select(
            *[F.col(k).alias(c) for c, k in zip(keep, kept)],
            PROBABILITY,
            predict_class(PROBABILITY, self.threshold).alias(CLASS),
            F.lit(float(self.threshold)).alias("classification_threshold"),
            F.col(PREDICTION).alias(DAYS),
        )


def _typed(text: Column, kind: str) -> Column:
    """The text as ``kind``, NULL where it doesn't fit: numbers must be finite, whole numbers may be written as 2.0."""
    value = text.try_cast(kind)
    if kind in ("float", "double"):
        return F.when(F.abs(value) < float("inf"), value)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        number = text.try_cast("decimal(38,18)")
        return F.coalesce(value, F.when(number == F.floor(number), number.try_cast(kind)))
    return value


def split_records(df: DataFrame, payload: str, contract: FeatureContract, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Turn a JSON payload per row into contract columns; unusable rows go to the second frame.

    A row is usable when its payload is a JSON object that names every feature with a value of its type (a null
    value is allowed). Rejected rows keep the payload and list the missing names and the names of unfit values.
    """
    required = F.array(*[F.lit(f) for f in contract.features])
    named = F.from_json(F.col(payload), "map<string,string>")
    given = {f: F.col("_named")[f] for f in contract.features}
    unfit = [F.when(v.isNotNull() & _typed(v, types[f]).isNull(), F.lit(f)) for f, v in given.items()]
    checked = df.withColumn("_named", named).withColumns(
        {
            "missing_features": F.array_except(
                required, F.coalesce(F.map_keys("_named"), F.array().cast("array<string>"))
            ),
            "invalid_features": F.array_compact(F.array(*unfit)),
        }
    )
    usable = (F.size("missing_features") == 0) & (F.size("invalid_features") == 0)
    others = [c for c in df.columns if c != payload]
    accepted = checked.where(usable).select(*others, *[_typed(v, types[f]).alias(f) for f, v in given.items()])
    return accepted, checked.where(~usable).drop("_named")


def evaluate_frozen(scorer: Scorer, test: DataFrame, key: str) -> DataFrame:
    """One row per order: both targets, both predictions and the absolute error in days."""
    contract = scorer.contract
    label, days = contract.classification_target, contract.regression_target
    scored = scorer.score(test, [key, label, days])
    return scored.select(
        key,
        F.col(label).alias("late_delivery_actual"),
        PROBABILITY,
        CLASS,
        days,
        DAYS,
        F.abs(F.col(days) - F.col(DAYS)).alias("absolute_delivery_error_days"),
    )
