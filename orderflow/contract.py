"""Table specifications and the feature contract that every later step is checked against."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(ValueError):
    """A frame or a contract does not have the agreed shape."""


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    grain: str


@dataclass(frozen=True)
class FeatureContract:
    tracking: tuple[str, ...]
    categorical: tuple[str, ...]
    numerical: tuple[str, ...]
    classification_target: str
    regression_target: str
    analysis_only: tuple[str, ...] = field(default=())

    @property
    def features(self) -> list[str]:
        return [*self.categorical, *self.numerical]

    @property
    def targets(self) -> list[str]:
        return [self.classification_target, self.regression_target]

    @property
    def forbidden(self) -> list[str]:
        return [*self.tracking, *self.analysis_only, *self.targets]

    @property
    def columns(self) -> list[str]:
        return [*self.tracking, *self.features, *self.targets, *self.analysis_only]

    def problems(self) -> list[str]:
        """Duplicates, columns with two roles, and inputs that would leak the outcome."""
        found = [f"{name} is listed {n} times" for name, n in Counter(self.features).items() if n > 1]
        both = sorted(set(self.categorical) & set(self.numerical))
        found += [f"{name} is both categorical and numerical" for name in both]
        leaks = sorted(set(self.features) & set(self.forbidden))
        found += [f"{name} must not be a model input" for name in leaks]
        return found

    def lint(self) -> None:
        if self.problems():
            raise ContractError("; ".join(self.problems()))

    def select_features(self, df: DataFrame) -> DataFrame:
        """Keep the contract's inputs in their own order; everything else is dropped."""
        allowed = set(self.features)
        return df.select(*[c for c in df.columns if c in allowed])

    def check(self, df: DataFrame) -> None:
        """All contract columns are present and the numerical ones are numeric."""
        require_columns(df, self.columns)
        require_numeric(df, self.numerical)

    def manifest(self, splits: DataFrame | None = None) -> str:
        """The contract as JSON, optionally with the (few) split summary rows."""
        payload: dict[str, object] = {
            "tracking_columns": list(self.tracking),
            "categorical_features": list(self.categorical),
            "numerical_features": list(self.numerical),
            "classification_target": self.classification_target,
            "regression_target": self.regression_target,
            "analysis_only_columns": list(self.analysis_only),
            "forbidden_columns": self.forbidden,
            "feature_count": len(self.features),
        }
        if splits is not None:
            payload["splits"] = [row.asDict() for row in splits.orderBy("split").collect()]
        return json.dumps(payload, indent=2, default=str)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")


def require_numeric(df: DataFrame, names: Iterable[str]) -> None:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wrong = [n for n in names if not isinstance(kinds[n], T.NumericType)]
    if wrong:
        raise ContractError(f"columns are not numeric: {', '.join(wrong)}")


def require_same_schema(frames: dict[str, DataFrame]) -> None:
    """All frames have the same column names in the same order and the same types."""
    shapes = {name: df.dtypes for name, df in frames.items()}
    first = next(iter(shapes))
    different = [name for name, shape in shapes.items() if shape != shapes[first]]
    if different:
        raise ContractError(f"schema of {', '.join(different)} differs from {first}")
