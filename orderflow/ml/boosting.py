"""Second-order gradient boosting of regression trees on binned features.

Each row is stored once as one byte per feature, its bin among at most MOST_BINS quantile bins; the last bin holds missing
values. A level of a tree is one job: every task sums gradients, second derivatives and rows by (node, bin) for each
feature, the sums of a feature meet in one task that finds its best split of each node, and one row per feature and node
reaches the driver. A split sends missing values to the side that gains more. Leaves are -G / (H + l2), shrunken by the step size.

Scores of finished trees are added up when a row is read and are stored every STORE_EVERY trees, so a job never looks at more than that many.
Rows and features are sampled by hashes of the row's key and of the feature with the tree's number and the seed: the trees don't
depend on how rows are dealt to tasks, but for the last digits of sums.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.session import pin, unpin

MOST_BINS, STORE_EVERY = 254, 20
#: Relative rank error of the quantiles that become bin edges.
EDGE_ACCURACY = 2_000
LOGISTIC, SQUARED = "logistic", "squared"
SPLIT = "feature int, node int, bin int, missing_left boolean, gain double, gl double, hl double, gr double, hr double"


@dataclass(frozen=True)
class Settings:
    """What a booster is told; ``least_hessian`` and ``least_rows`` hold for each side of a split."""

    trees: int
    step: float
    depth: int
    l2: float = 1.0
    least_hessian: float = 0.0
    least_rows: int = 1
    rows: float = 1.0
    features: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Node arrays; feature -1 is a leaf. Rows with bin <= ``bin`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, s, l2: float, step: float) -> None:
        self.feature[node], self.bin[node], self.missing_left[node] = s["feature"], s["bin"], s["missing_left"]
        self.left[node], self.right[node] = len(self.value), len(self.value) + 1
        for g, h in ((s["gl"], s["hl"]), (s["gr"], s["hr"])):
            for names, empty in ((self.feature, -1), (self.bin, 0), (self.missing_left, False), (self.left, 0), (self.right, 0)):
                names.append(empty)
            self.value.append(-g / (h + l2) * step)

    def places(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The node of each row, where ``missing`` is each feature's last bin."""
        feature, cut, to_left, left, right = (np.array(a) for a in (self.feature, self.bin, self.missing_left, self.left, self.right))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            node = at[rows]
            f = feature[node]
            b = bins[rows, f]
            goes_left = np.where(b == missing[f], to_left[node], b <= cut[node])
            at[rows] = np.where(goes_left, left[node], right[node])
        return at

    def scores(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.places(bins, missing)]


# --- bins


def bin_edges(train: DataFrame, features: str, most: int = MOST_BINS) -> list[list[float]]:
    """Distinct inner quantiles of each feature, at most ``most``; a value belongs to the first edge that isn't below it.
    One row per feature reaches the driver."""
    values = train.select(F.posexplode(vector_to_array(F.col(features))).alias("feature", "value"))
    at = [i / most for i in range(1, most + 1)]
    present = F.when(~F.isnan("value"), F.col("value"))
    found = values.groupBy("feature").agg(F.array_distinct(F.percentile_approx(present, at, EDGE_ACCURACY)).alias("edges"))
    return [r["edges"] or [] for r in found.orderBy("feature").collect()]


def to_bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.where(np.isnan(values[:, f]), len(e) + 1, np.searchsorted(e, values[:, f], "left"))
    return out


def binned(df: DataFrame, edges: list[list[float]], features: str) -> Column:
    cuts = [np.array(e, float) for e in edges]

    @F.pandas_udf("binary")
    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            made = to_bins(np.stack(batch.to_list()).astype(float), cuts) if len(batch) else np.empty((0, len(cuts)), np.uint8)
            yield pd.Series([r.tobytes() for r in made], dtype=object)

    return rows(vector_to_array(F.col(features)))


# --- histograms and splits


def drawn(seed: int, tree: int, ids: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each 64-bit id."""
    x = ids.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
    return (x >> np.uint64(11)) / float(1 << 53)


def gradients(loss: str, score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if loss == SQUARED:
        return weight * (score - label), weight
    p = 1 / (1 + np.exp(-score))
    return weight * (p - label), weight * np.maximum(p * (1 - p), 1e-16)


def histogram(place: np.ndarray, nodes: list[int], bins: np.ndarray, width: int, stats: np.ndarray) -> np.ndarray:
    """(node, bin, g / h / rows) sums of one feature for rows at one of ``nodes``."""
    local = np.full(max(nodes) + 1, -1)
    local[nodes] = np.arange(len(nodes))
    index = local[place] * width + bins
    return np.stack([np.bincount(index, s, len(nodes) * width).reshape(len(nodes), width) for s in stats], axis=2)


def best_splits(hist: np.ndarray, settings: Settings) -> list[tuple]:
    """(node, bin, missing_left, gain, gl, hl, gr, hr) of each node's best split of one feature; the first among equals, missing
    values to the right."""
    out, l2 = [], settings.l2
    whole, gone = hist.sum(axis=1), hist[:, -1]
    for n in range(len(hist)):
        below, best = np.cumsum(hist[n, :-2], axis=0), None
        for missing_left in (False, True) if gone[n, 2] else (False,):
            left = below + gone[n] if missing_left else below
            right = whole[n] - left
            fits = (np.minimum(left[:, 1], right[:, 1]) >= settings.least_hessian) & (np.minimum(left[:, 2], right[:, 2]) >= settings.least_rows)
            gain = left[:, 0] ** 2 / (left[:, 1] + l2) + right[:, 0] ** 2 / (right[:, 1] + l2) - whole[n, 0] ** 2 / (whole[n, 1] + l2)
            gain = np.where(fits & (np.minimum(left[:, 2], right[:, 2]) > 0), gain, -np.inf)
            if len(gain) and (at := int(np.argmax(gain))) is not None and (best is None or gain[at] > best[3]):
                best = (n, at, missing_left, float(gain[at]), *map(float, left[at, :2]), *map(float, right[at, :2]))
        if best is not None and np.isfinite(best[3]) and best[3] > 1e-12:
            out.append(best)
    return out


@dataclass(frozen=True)
class Booster:
    """A loss and settings over rows of (bins, label, weight, row_id, score)."""

    loss: str
    settings: Settings
    widths: list[int]  # bins of each feature, the missing one included

    @property
    def missing(self) -> np.ndarray:
        return np.array(self.widths) - 1

    def chosen_features(self, tree: int) -> list[int]:
        every = np.arange(len(self.widths))
        if self.settings.features >= 1:
            return every.tolist()
        order = np.argsort(drawn(self.settings.seed + 1, tree, every), kind="stable")
        return sorted(order[: max(1, round(self.settings.features * len(every)))].tolist())

    def level(self, rows: DataFrame, done: list[Tree], tree: Tree, number: int, nodes: list[int]) -> list:
        """The best split of each feature for each of ``nodes`` of an unfinished tree."""
        features, widths, missing, s, loss = self.chosen_features(number), self.widths, self.missing, self.settings, self.loss

        def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                if not len(batch):
                    continue
                bins = np.frombuffer(b"".join(batch["bins"]), np.uint8).reshape(len(batch), -1)
                score = batch["score"].to_numpy(float)
                for t in done:
                    score = score + t.scores(bins, missing)
                g, h = gradients(loss, score, batch["label"].to_numpy(float), batch["weight"].to_numpy(float))
                place = tree.places(bins, missing)
                used = np.isin(place, nodes)
                if s.rows < 1:
                    used &= drawn(s.seed, number, batch["row_id"].to_numpy(np.int64)) < s.rows
                stats = np.stack((g, h, np.ones(len(g))))[:, used]
                for f in features:
                    part = histogram(place[used], nodes, bins[used, f].astype(np.int64), widths[f], stats)
                    sums[f] = sums[f] + part if f in sums else part
            yield pd.DataFrame({"feature": list(sums), "sums": [a.tobytes() for a in sums.values()]})

        def split(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(b).reshape(len(nodes), widths[key[0]], 3) for b in parts["sums"])
            found = [(key[0], *b) for b in best_splits(total, s)]
            return pd.DataFrame(found, columns=[c.split()[0] for c in SPLIT.split(", ")])

        columns = ["bins", "label", "weight", "row_id", "score"]
        parts = rows.select(*columns).mapInPandas(summed, "feature int, sums binary")
        return parts.groupBy("feature").applyInPandas(split, SPLIT).collect()

    def fit(self, rows: DataFrame) -> list[Tree]:
        trees, waiting, s = [], [], self.settings
        for number in range(s.trees):
            tree, nodes = Tree(), [0]
            for _ in range(s.depth):
                found = self.level(rows, waiting, tree, number, nodes)
                best: dict[int, object] = {}
                for r in sorted(found, key=lambda r: (-r["gain"], r["feature"])):
                    best.setdefault(r["node"], r)
                for local in sorted(best):
                    tree.split(nodes[local], best[local], s.l2, s.step)
                nodes = [child for local in sorted(best) for child in (tree.left[nodes[local]], tree.right[nodes[local]])]
                if not nodes:
                    break
            trees.append(tree)
            waiting = [*waiting, tree]
            if len(waiting) == STORE_EVERY and number + 1 < s.trees:
                before, rows = rows, pin(rows.withColumn("score", F.col("score") + added(F.col("bins"), waiting, self.missing)))
                unpin(before)
                waiting = []
        return trees


def added(bins: Column, trees: list[Tree], missing: np.ndarray) -> Column:
    """The sum of the trees for rows of bins."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.frombuffer(b"".join(batch), np.uint8).reshape(len(batch), -1) if len(batch) else np.empty((0, len(missing)), np.uint8)
            yield pd.Series(sum((t.scores(rows, missing) for t in trees), np.zeros(len(rows))))

    return scored(bins)


# --- model


class BoostedTrees(Model, HasFeaturesCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the probability of class 1 (logistic loss) or the predicted value. Edges and trees are kept as JSON."""

    state = Param(Params._dummy(), "state", "loss, base score, edges and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol=None, outputCol=None, state=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault(self.state))["trees"]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = json.loads(self.getOrDefault(self.state))
        missing = np.array([len(e) + 1 for e in known["edges"]])
        score = added(binned(dataset, known["edges"], self.getFeaturesCol()), self.trees(), missing) + F.lit(known["base"])
        return dataset.withColumn(self.getOutputCol(), 1 / (1 + F.exp(-score)) if known["loss"] == LOGISTIC else score)


def fit_boosted(
    train: DataFrame,
    loss: str,
    settings: Settings,
    output: str,
    features: str = "features",
    label: str = "_label",
    weight: str | None = None,
    row_id: str | None = None,
    base: float | None = None,
) -> BoostedTrees:
    """Fit on rows of a feature vector (NaN: missing) and a label. ``base``: where scores start; the mean label for squared loss,
    0 (probability one half) for logistic. ``row_id``: 64-bit key for row sampling; without it rows with equal contents are drawn together."""
    edges = bin_edges(train, features)
    if base is None:
        base = 0.0 if loss == LOGISTIC else train.agg(F.avg(label)).first()[0] or 0.0
    rows = train.select(
        binned(train, edges, features).alias("bins"),
        F.col(label).cast("double").alias("label"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        (F.col(row_id) if row_id else F.xxhash64(vector_to_array(F.col(features)), F.col(label))).alias("row_id"),
        F.lit(float(base)).alias("score"),
    )
    trees = Booster(loss, settings, [len(e) + 2 for e in edges]).fit(pin(rows))
    state = {"loss": loss, "base": float(base), "edges": edges, "trees": [t.__dict__ for t in trees]}
    return BoostedTrees(featuresCol=features, outputCol=output, state=json.dumps(state))
