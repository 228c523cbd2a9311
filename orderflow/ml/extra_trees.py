"""Extremely randomised trees on binned features: one random threshold for each node and feature.

A threshold is drawn evenly between the limits that the path to a node sets on a feature (at the root: least and largest value), and a
node looks at a share of the features. Draws come from the seed and the numbers of tree, node and feature, so trees don't depend
on how rows are dealt to tasks, but for the last digits of sums. A split gains by the weighted variance of the label, which for labels
0 and 1 orders splits as the Gini impurity does. Each tree sees all rows; the prediction is the mean of the trees.

TOGETHER trees grow side by side: a level of all of them is one job, in which every task sums label and weight on both sides of each drawn
threshold, at most 2 * 2^depth sums a feature and tree; Spark adds them up by (tree, node, feature), picks the best of
each node, and one row per open node reaches the driver.

Defined results: missing values go right. A node whose drawn thresholds all leave a side with less than ``least_rows`` is a leaf. A table
without rows gives trees that predict 0.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.ml.boosting import SQUARED, BoostedTrees, Settings, Tree, bin_edges, binned, drawn
from orderflow.session import pin, unpin

TOGETHER = 5
SUMS = ("gl", "hl", "nl", "gr", "hr", "nr")


class Growing:
    """A tree with its open nodes and, for each, the lowest and highest bin that its path allows of each feature."""

    def __init__(self, number: int, edges: list[np.ndarray], mean: float):
        self.number, self.edges, self.tree = number, edges, Tree(value=[mean])
        self.nodes = [0]
        self.low = np.zeros((1, len(edges)), np.int64)
        self.high = np.array([[len(e) - 1 for e in edges]], np.int64)

    def draw(self, s: Settings) -> np.ndarray:
        """(node, feature) last bin that goes left, -1 where a node doesn't look."""
        width = len(self.edges)
        ids = np.array(self.nodes, np.int64)[:, None] * width + np.arange(width)
        at = drawn(s.seed, self.number, ids)
        cuts = np.full(at.shape, -1)
        for f, e in enumerate(self.edges):
            if len(e):
                low, high = e[self.low[:, f]], e[np.maximum(self.high[:, f], 0)]
                cut = np.searchsorted(e, low + at[:, f] * (high - low), "right") - 1
                cuts[:, f] = np.where(self.low[:, f] < self.high[:, f], np.clip(cut, self.low[:, f], self.high[:, f] - 1), -1)
        order = np.argsort(drawn(s.seed + 1, self.number, ids), axis=1, kind="stable")
        unseen = order[:, max(1, int(s.features * width)) :]
        np.put_along_axis(cuts, unseen, -1, axis=1)
        return cuts

    def split(self, best: dict[int, object], cuts: np.ndarray, step: float) -> None:
        nodes, low, high = [], [], []
        for local in sorted(best):
            r, node = best[local], self.nodes[local]
            f, cut = r["feature"], int(cuts[local, r["feature"]])
            self.tree.split(node, {"feature": f, "bin": cut, "missing_left": False, **{k: r[k] for k in ("gl", "hl", "gr", "hr")}}, 0.0, step)
            for child, side in ((self.tree.left[node], 0), (self.tree.right[node], 1)):
                below, above = self.low[local].copy(), self.high[local].copy()
                if side:
                    below[f] = cut + 1
                else:
                    above[f] = cut
                nodes.append(child)
                low.append(below)
                high.append(above)
        self.nodes, self.low, self.high = nodes, np.array(low), np.array(high)


def sides(place: np.ndarray, nodes: list[int], bins: np.ndarray, cuts: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """(feature, node, side, g / h / rows) sums at the drawn thresholds."""
    local = np.full(max(int(place.max(initial=0)), max(nodes)) + 1, -1)
    local[nodes] = np.arange(len(nodes))
    at = local[place]
    used = at >= 0
    at, bins, stats = at[used], bins[used], stats[:, used]
    out = np.empty((bins.shape[1], len(nodes), 2, len(stats)))
    for f in range(bins.shape[1]):
        index = at * 2 + (bins[:, f] > cuts[at, f])
        for k, s in enumerate(stats):
            out[f, :, :, k] = np.bincount(index, s, 2 * len(nodes)).reshape(-1, 2)
    return out


def grow_level(rows: DataFrame, growing: list[Growing], cuts: list[np.ndarray], missing: np.ndarray, s: Settings) -> list:
    """(tree, node, feature, sums of both sides) of the best split of each open node; ``node`` counts the open ones."""
    work = [(g.number, g.tree, g.nodes, c) for g, c in zip(growing, cuts, strict=True) if g.nodes]

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            bins = np.frombuffer(b"".join(batch["bins"]), np.uint8).reshape(len(batch), -1)
            label, weight = batch["label"].to_numpy(float), batch["weight"].to_numpy(float)
            stats = np.stack((-weight * label, weight, np.ones(len(batch))))
            for number, tree, nodes, cut in work:
                part = sides(tree.places(bins, missing), nodes, bins, cut, stats)
                sums[number] = sums[number] + part if number in sums else part
        for number, _, _, cut in work:
            if number in sums:
                feature, node = np.nonzero((cut.T >= 0) & (sums[number][..., 2].sum(axis=2) > 0))
                values = sums[number][feature, node].reshape(-1, 6)
                yield pd.DataFrame({"tree": number, "node": node, "feature": feature, **dict(zip(SUMS, values.T, strict=True))})

    schema = "tree int, node int, feature int, " + ", ".join(f"{c} double" for c in SUMS)
    total = rows.mapInPandas(summed, schema).groupBy("tree", "node", "feature").agg(*[F.sum(c).alias(c) for c in SUMS])
    part = lambda g, h: F.col(g) * F.col(g) / F.col(h)
    whole = (F.col("gl") + F.col("gr")) * (F.col("gl") + F.col("gr")) / (F.col("hl") + F.col("hr"))
    fits = total.where(F.least("nl", "nr") >= max(1, s.least_rows)).where("hl > 0 AND hr > 0")
    gained = fits.withColumn("gain", part("gl", "hl") + part("gr", "hr") - whole).where("gain > 1e-12")
    best = F.max(F.struct("gain", (-F.col("feature")).alias("back"), "feature", "gl", "hl", "gr", "hr")).alias("s")
    return gained.groupBy("tree", "node").agg(best).select("tree", "node", "s.*").collect()


def grow(rows: DataFrame, edges: list[list[float]], s: Settings, mean: float) -> list[Tree]:
    """Trees over rows of (bins, label, weight), each node's value divided by their number."""
    cuts_at, missing, out, step = [np.array(e, float) for e in edges], np.array([len(e) + 1 for e in edges]), [], 1 / s.trees
    for first in range(0, s.trees, TOGETHER):
        growing = [Growing(n, cuts_at, mean * step) for n in range(first, min(first + TOGETHER, s.trees))]
        for _ in range(s.depth):
            if not any(g.nodes for g in growing):
                break
            cuts = [g.draw(s) if g.nodes else np.zeros((0, len(edges)), np.int64) for g in growing]
            best: dict[int, dict[int, object]] = {g.number: {} for g in growing}
            for r in grow_level(rows, growing, cuts, missing, s):
                best[r["tree"]][r["node"]] = r
            for g, c in zip(growing, cuts, strict=True):
                g.split(best[g.number], c, step)
        out += [g.tree for g in growing]
    return out


def fit_extra_trees(
    train: DataFrame, settings: Settings, output: str, features: str = "features", label: str = "_label", weight: str | None = None
) -> BoostedTrees:
    """Fit on rows of a feature vector and a label; for labels 0 and 1 the prediction is the probability of 1. Of the settings
    trees, depth, least_rows, features (the share a node looks at) and seed are used."""
    edges = bin_edges(train, features)
    rows = pin(
        train.select(
            binned(train, edges, features).alias("bins"),
            F.col(label).cast("double").alias("label"),
            (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        )
    )
    mean = rows.agg(F.sum(F.col("label") * F.col("weight")) / F.nullif(F.sum("weight"), F.lit(0.0))).first()[0] or 0.0
    trees = grow(rows, edges, settings, float(mean))
    unpin(rows)
    state = {"loss": SQUARED, "base": 0.0, "edges": edges, "trees": [t.__dict__ for t in trees]}
    return BoostedTrees(featuresCol=features, outputCol=output, state=json.dumps(state))
