"""Random forests on binned features: bagged trees whose nodes each look at a drawn subset of the features.

A tree counts each row as often as a Poisson(1) draw says; a node is split where the weighted variance of the label falls most, which for
labels 0 and 1 orders splits as the Gini impurity does. All draws come from the seed and the numbers of tree, row, node and feature, so trees
don't depend on tasks, but for the last digits of sums and what these decide between splits of equal gain. The prediction is the mean over trees of the weighted label mean in a leaf.

Deep trees have more nodes than a histogram for each of them could pay for, so the rows of a node are brought to one task that grows the whole
subtree. A table that fits a task (LOCAL_BYTES of bins) is sent once to each task, which grows its share of the trees. In a larger
table the upper levels of TOGETHER trees grow side by side, a level of all of them by one job that adds up histograms, until the rows of a
node fit; one row per node of these levels and one per finished subtree reach the driver.

Defined results: missing values go right. A node is a leaf if its labels are equal or no feature it looks at leaves ``least_rows`` counted rows
on both sides with a gain. A tree that drew no row predicts the mean label.
"""

from __future__ import annotations

import base64
import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.ml.boosting import bin_edges, binned, drawn
from orderflow.session import pin, unpin

#: Bins (one byte each) of the rows that a task grows a subtree of.
LOCAL_BYTES = 1 << 28
#: Trees of a large table that grow side by side, and their nodes that one job makes histograms of.
TOGETHER, NODES_A_JOB = 5, 128
#: Rows whose splits are searched at a time, so that they stay in the processor's cache.
CHUNK = 1 << 15
#: A gain below this share of a node's squares is rounding.
LEAST_GAIN = 1e-12
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
NODES = {"feature": np.int16, "cut": np.uint8, "left": np.int32, "value": np.float64}
GROWN = "tree int, path bigint, feature binary, cut binary, value binary"
SHIPPED = {"bins": np.uint8, "id": np.int64, "label": np.float64, "weight": np.float64}


@dataclass(frozen=True)
class Growth:
    """What a forest is told; ``features`` is the number a node looks at."""

    trees: int
    depth: int
    least_rows: int
    features: int
    seed: int


def features_looked_at(strategy: str, width: int, trees: int, classes: bool) -> int:
    """Spark's names: auto, all, sqrt, onethird, log2, a share ("0.8") or a number ("3")."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if classes else "onethird"
    named = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "onethird": math.ceil(width / 3), "log2": math.ceil(math.log2(max(width, 2)))}
    if strategy in named:
        return named[strategy]
    return min(width, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * width)


def times(seed: int, tree: int, ids: np.ndarray) -> np.ndarray:
    """How often a tree counts each row."""
    return np.searchsorted(POISSON, drawn(seed, tree, ids), "right")


def looked_at(s: Growth, tree: int, paths: np.ndarray, width: int) -> np.ndarray:
    """(node, feature) whether a node looks at a feature; a node's path is 1 at the root, 2p and 2p + 1 below p."""
    if s.features >= width:
        return np.ones((len(paths), width), bool)
    draws = drawn(s.seed + 1, tree, paths.astype(np.uint64)[:, None] * np.uint64(width) + np.arange(width, dtype=np.uint64))
    out = np.zeros(draws.shape, bool)
    np.put_along_axis(out, np.argpartition(draws, s.features - 1, axis=1)[:, : s.features], True, axis=1)
    return out


def gains(g, w, c, whole_g, whole_w, whole_c, least: int) -> np.ndarray:
    """Sum over both sides of squared label sum by weight, -inf where a side has too few rows; g, w, c are sums of the left side."""
    fits = (c >= least) & (whole_c - c >= least) & (w > 0) & (whole_w - w > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(fits, g * g / w + (whole_g - g) ** 2 / (whole_w - w), -np.inf)


# --- subtrees in one task


class Table:
    """Rows in one task: a column of bins per feature, those with two bins as the list of features whose upper bin a row is in."""

    def __init__(self, columns: np.ndarray, ids: np.ndarray, label: np.ndarray, weight: np.ndarray):
        order = np.argsort(ids, kind="stable")
        for f in range(len(columns)):
            columns[f] = columns[f][order]
        self.columns, self.ids, self.label, self.weight = columns, ids[order], label[order], weight[order]
        top = columns.max(axis=1, initial=0)
        self.wide, self.two = np.flatnonzero(top > 1), np.flatnonzero(top == 1)
        self.widths = top.astype(np.int64) + 1
        per_row = np.zeros(len(ids), np.int64)
        for f in self.two:
            per_row += columns[f]
        self.upper = np.full((int(per_row.max(initial=0)), len(ids)), len(self.two), np.int32)
        filled = np.zeros(len(ids), np.int64)
        for k, f in enumerate(self.two):
            rows = np.flatnonzero(columns[f])
            self.upper[filled[rows], rows] = k
            filled[rows] += 1


def _two_bins(table: Table, rows, stats, whole, lens, looks, least):
    """(gain, feature) of the best feature with two bins for each node."""
    node, width = np.repeat(np.arange(len(lens)), lens), len(table.two) + 1
    sums = np.zeros((3, len(lens) * width))
    for slot in table.upper:
        key = node * width + slot[rows]
        for total, s in zip(sums, stats, strict=True):
            total += np.bincount(key, s, len(total))
    right = sums.reshape(3, len(lens), width)[:, :, :-1]
    gain = gains(*(whole[:, :, None] - right), *whole[:, :, None], least)
    gain[~looks[:, table.two]] = -np.inf
    best = gain.argmax(axis=1)
    return gain[np.arange(len(lens)), best], table.two[best]


def _wide(bins, width, stats, whole, lens, least):
    """(node, gain, cut) of the best cut of one feature for the nodes that have one."""
    count = len(lens)
    node = np.repeat(np.arange(count), lens)
    if count * width <= 2 * len(bins):
        key = node * width + bins
        left = np.stack([np.bincount(key, s, count * width).reshape(count, width).cumsum(axis=1)[:, :-1] for s in stats])
        gain = gains(*left, *whole[:, :, None], least)
        cut = gain.argmax(axis=1)
        return np.arange(count), gain[np.arange(count), cut], cut
    packed = ((node * 256 + bins) << 32) | np.arange(len(bins))
    packed.sort()
    key, at = packed >> 32, packed & 0xFFFFFFFF
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    owner, first = key[last] >> 8, np.cumsum(lens) - lens
    running = [np.concatenate(([0.0], np.cumsum(s[at]))) for s in stats]
    left = [r[last + 1] - r[first[owner]] for r in running]
    gain = gains(*left, *(t[owner] for t in whole), least)
    used = np.flatnonzero(gain > -np.inf)
    if not len(used):
        return used, gain[used], used
    gain, owner, cut = gain[used], owner[used], key[last[used]] & 255
    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    top = np.maximum.reduceat(gain, begin)
    hit = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(begin, len(gain)))))
    hit = hit[np.append(True, owner[hit][1:] != owner[hit][:-1])]
    return owner[hit], gain[hit], cut[hit]


def best_cuts(table: Table, rows, stats, whole, lens, looks, least):
    """(gain, feature, cut) for each node; rows lie node by node. The first feature among equals, those with two bins after the others; -1
    where none splits."""
    gain, feature, cut = np.full(len(lens), -np.inf), np.full(len(lens), -1), np.zeros(len(lens), np.int64)
    for f in table.wide:
        seen = np.flatnonzero(looks[:, f])
        if not len(seen):
            continue
        if len(seen) == len(lens):
            found = _wide(table.columns[f][rows], table.widths[f], stats, whole, lens, least)
        else:
            mine = np.repeat(looks[:, f], lens)
            found = _wide(table.columns[f][rows[mine]], table.widths[f], [s[mine] for s in stats], whole[:, seen], lens[seen], least)
        node = seen[found[0]]
        better = found[1] > gain[node]
        node = node[better]
        gain[node], feature[node], cut[node] = found[1][better], f, found[2][better]
    if len(table.two):
        found = _two_bins(table, rows, stats, whole, lens, looks, least)
        better = found[0] > gain
        gain[better], feature[better], cut[better] = found[0][better], found[1][better], 0
    return gain, feature, cut


def grow(table: Table, s: Growth, number: int, path: int) -> dict[str, np.ndarray]:
    """The subtree at ``path`` of one tree as node arrays, level by level; the right child follows the left one."""
    count = times(s.seed, number, table.ids)
    rows = np.flatnonzero(count)
    if not len(rows):
        return {c: np.array([-1 if c == "feature" else 0], kind) for c, kind in NODES.items()}
    counted = count[rows].astype(float)
    weight = counted * table.weight[rows]
    stats = [weight * table.label[rows], weight, counted]
    levels, lens, paths, base, depth = [], np.array([len(rows)]), np.array([path], np.uint64), 0, path.bit_length() - 1
    while True:
        first = np.cumsum(lens) - lens
        whole = np.stack([np.add.reduceat(x, first) for x in stats])
        label = table.label[rows]
        squares = np.add.reduceat(stats[1] * label * label, first)
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(whole[1] > 0, whole[0] / whole[1], 0.0)
            least_gain = np.where(whole[1] > 0, whole[0] ** 2 / whole[1], np.inf) + LEAST_GAIN * squares
        feature, cut = np.full(len(lens), -1), np.zeros(len(lens), np.int64)
        mixed = np.maximum.reduceat(label, first) > np.minimum.reduceat(label, first)
        nodes = np.flatnonzero(mixed & (whole[2] >= 2 * s.least_rows)) if depth < s.depth else np.empty(0, np.int64)
        looks = looked_at(s, number, paths[nodes], len(table.columns))
        part = np.cumsum(lens[nodes]) // CHUNK
        for some in np.split(np.arange(len(nodes)), np.flatnonzero(part[1:] != part[:-1]) + 1) if len(nodes) else ():
            at = nodes[some]
            here = np.concatenate([np.arange(first[n], first[n] + lens[n]) for n in at]) if len(at) < at[-1] - at[0] + 1 else slice(first[at[0]], first[at[-1]] + lens[at[-1]])
            gain, f, c = best_cuts(table, rows[here], [x[here] for x in stats], whole[:, at], lens[at], looks[some], s.least_rows)
            split = gain > least_gain[at]
            feature[at[split]], cut[at[split]] = f[split], c[split]
        split = feature >= 0
        left = np.where(split, base + len(lens) + 2 * (np.cumsum(split) - 1), 0)
        levels.append((feature, cut, left, value))
        if not split.any():
            return {c: np.concatenate(x).astype(kind) for (c, kind), x in zip(NODES.items(), zip(*levels, strict=True), strict=True)}
        mine = np.repeat(split, lens)
        node = np.repeat(np.arange(split.sum()), lens[split])
        rows, stats = rows[mine], [x[mine] for x in stats]
        side = node * 2 + (table.columns[feature[split][node], rows] > cut[split][node])
        order = np.argsort(side, kind="stable")
        rows, stats = rows[order], [x[order] for x in stats]
        base, depth = base + len(lens), depth + 1
        lens = np.bincount(side, minlength=2 * int(split.sum()))
        paths = (paths[split][:, None] * np.uint64(2) + np.arange(2, dtype=np.uint64)).ravel()


# --- rows to tasks


def _unpacked(batch: pd.DataFrame) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(batch["bins"]), np.uint8).reshape(len(batch), -1)
    return bins, batch["id"].to_numpy(np.int64), batch["label"].to_numpy(float), batch["weight"].to_numpy(float)


def _grown(rows: DataFrame, s: Growth, work: list[list[tuple[int, int]]], tops: dict[int, dict[int, tuple]]) -> list:
    """Subtrees at (tree, path). A list of ``work`` is done by one task on the rows that its first pair's path holds."""

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            arrays = _unpacked(batch)
            places = {t: paths_of(top, arrays[0]) for t, top in tops.items()}
            counted = {t: times(s.seed, t, arrays[1]) > 0 for t in tops}
            for task, ((tree, path), *_) in enumerate(work):
                part = arrays
                if tree in tops:
                    mine = (places[tree] == path) & counted[tree]
                    part = [a[mine] for a in arrays]
                if len(part[1]):
                    yield pd.DataFrame({"task": [task], **{c: [a.tobytes()] for c, a in zip(SHIPPED, part, strict=True)}})

    def finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = [r for batch in batches for r in batch.itertuples(index=False)]
        if not blocks:
            return
        task = blocks[0].task
        ids, label, weight = (np.concatenate([np.frombuffer(getattr(b, c), SHIPPED[c]) for b in blocks]) for c in ("id", "label", "weight"))
        columns, end = np.empty((len(blocks[0].bins) * 8 // len(blocks[0].id), len(ids)), np.uint8), len(ids)
        while blocks:
            block = np.frombuffer(blocks.pop().bins, np.uint8).reshape(-1, len(columns))
            columns[:, end - len(block) : end] = block.T
            end -= len(block)
        table = Table(columns, ids, label, weight)
        for tree, path in work[task]:
            nodes = grow(table, s, tree, path)
            nodes["value"] = nodes["value"][nodes["feature"] < 0]
            yield pd.DataFrame({"tree": [tree], "path": [path], **{c: [zlib.compress(nodes[c], 1)] for c in ("feature", "cut", "value")}})

    blobs = rows.select(*SHIPPED).mapInPandas(sent, "task int, " + ", ".join(f"{c} binary" for c in SHIPPED))
    return blobs.repartitionById(len(work), F.col("task")).mapInPandas(finished, GROWN).collect()


# --- upper levels of a large table

# A tree's upper levels: path -> (feature, cut) of a split node, (-1, value) of a leaf.


def paths_of(top: dict[int, tuple], bins: np.ndarray) -> np.ndarray:
    """The path of the lowest node known for each row."""
    at = np.ones(len(bins), np.int64)
    for path in sorted(top):
        feature, cut = top[path]
        if feature >= 0:
            here = np.flatnonzero(at == path)
            at[here] = 2 * path + (bins[here, feature] > cut)
    return at


def _level(rows: DataFrame, s: Growth, tops: dict[int, dict[int, tuple]], asked: list[tuple[int, int]], widths: list[int]) -> list:
    """(tree, path, feature, cut, value, rows on both sides) of the best split of each node; feature -1 where none splits."""
    offset = np.cumsum([0, *widths])

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not len(batch):
                continue
            bins, ids, label, weight = _unpacked(batch)
            key = bins + offset[:-1]
            for tree in {t for t, _ in asked}:
                place, count = paths_of(tops[tree], bins), times(s.seed, tree, ids)
                for path in [p for t, p in asked if t == tree]:
                    mine = np.flatnonzero((place == path) & (count > 0))
                    if not len(mine):
                        continue
                    c, y = count[mine].astype(float), label[mine]
                    w = c * weight[mine]
                    flat = key[mine].ravel()
                    part = np.stack([np.bincount(flat, np.repeat(x, len(widths)), offset[-1]) for x in (w * y, w, c)])
                    old = sums.get((tree, path), (0.0, 0.0, np.inf, -np.inf))
                    sums[tree, path] = (old[0] + part, old[1] + (w * y * y).sum(), min(old[2], y.min()), max(old[3], y.max()))
        for (tree, path), (part, squares, low, high) in sums.items():
            yield pd.DataFrame({"tree": [tree], "path": [path], "sums": [part.tobytes()], "squares": [squares], "low": [low], "high": [high]})

    def split(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        tree, path = (int(k) for k in key)
        total = sum(np.frombuffer(b).reshape(3, -1) for b in parts["sums"])
        whole = total[:, : widths[0]].sum(axis=1)
        best, value = (-np.inf, -1, 0, 0.0, 0.0), whole[0] / whole[1] if whole[1] > 0 else 0.0
        if path.bit_length() <= s.depth and parts["low"].min() < parts["high"].max():
            for f in np.flatnonzero(looked_at(s, tree, np.array([path]), len(widths))[0]):
                left = total[:, offset[f] : offset[f + 1]].cumsum(axis=1)[:, :-1]
                gain = gains(*left, *whole, s.least_rows)
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (gain[at], f, at, left[2, at], whole[2] - left[2, at])
        if not (whole[1] > 0 and best[0] > whole[0] ** 2 / whole[1] + LEAST_GAIN * parts["squares"].sum()):
            best = (-np.inf, -1, 0, 0.0, 0.0)
        return pd.DataFrame([(tree, path, best[1], best[2], value, best[3], best[4])], columns=["tree", "path", "feature", "cut", "value", "left_rows", "right_rows"])

    parts = rows.select(*SHIPPED).mapInPandas(summed, "tree int, path bigint, sums binary, squares double, low double, high double")
    found = "tree int, path bigint, feature int, cut int, value double, left_rows double, right_rows double"
    return parts.groupBy("tree", "path").applyInPandas(split, found).collect()


def _grown_from_top(rows: DataFrame, s: Growth, numbers: list[int], widths: list[int], most: int) -> list[dict[str, np.ndarray]]:
    """Trees whose upper levels grow over all rows until at most ``most`` counted rows are left at a node."""
    tops: dict[int, dict[int, tuple]] = {t: {} for t in numbers}
    waiting, work = [(t, 1) for t in numbers], []
    while waiting:
        found = []
        for i in range(0, len(waiting), NODES_A_JOB):
            found += _level(rows, s, tops, waiting[i : i + NODES_A_JOB], widths)
        waiting = []
        for r in sorted(found, key=lambda r: (r["tree"], r["path"])):
            split = r["feature"] >= 0
            tops[r["tree"]][r["path"]] = (r["feature"], r["cut"]) if split else (-1, r["value"])
            for path, size in ((2 * r["path"], r["left_rows"]), (2 * r["path"] + 1, r["right_rows"])) if split else ():
                (waiting if size > most else work).append((r["tree"], path))
    below = {(r["tree"], r["path"]): r for r in _grown(rows, s, [[w] for w in work], tops)} if work else {}
    return [_joined(t, tops[t], below) for t in numbers]


def _joined(number: int, top: dict[int, tuple], below: dict[tuple[int, int], object]) -> dict[str, np.ndarray]:
    """Upper levels and subtrees in one set of node arrays."""
    out: dict[str, list] = {c: [0] for c in NODES}

    def put(path: int, at: int) -> None:
        if path in top and top[path][0] >= 0:
            left = len(out["left"])
            for c in NODES:
                out[c] += [0, 0]
            out["feature"][at], out["cut"][at], out["left"][at] = *top[path], left
            put(2 * path, left)
            put(2 * path + 1, left + 1)
        elif path in top or (number, path) not in below:
            out["feature"][at], out["value"][at] = -1, top.get(path, (-1, 0.0))[1]
        else:
            # The subtree's root takes the place kept for it; its other nodes follow the ones there are.
            nodes = _nodes(below[number, path])
            shift = len(out["left"]) - 1
            nodes["left"] = np.where(nodes["feature"] >= 0, nodes["left"] + shift, 0)
            for c, a in nodes.items():
                out[c][at] = a[0]
                out[c] += a[1:].tolist()

    put(1, 0)
    return {c: np.array(out[c], kind) for c, kind in NODES.items()}


def _nodes(row) -> dict[str, np.ndarray]:
    """A subtree as its task sent it: values of leaves only, and children in the order of the split nodes."""
    feature, cut, leaves = (np.frombuffer(zlib.decompress(row[c]), NODES[c]) for c in ("feature", "cut", "value"))
    split, value = feature >= 0, np.zeros(len(feature))
    value[~split] = leaves
    return {"feature": feature, "cut": cut, "left": np.where(split, 2 * np.cumsum(split) - 1, 0).astype(NODES["left"]), "value": value}


# --- model


class Forest(Model, HasFeaturesCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the mean of the trees. The state is JSON: mean label, edges, and the nodes of all trees as compressed arrays."""

    state = Param(Params._dummy(), "state", "mean, edges, roots and nodes as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol=None, outputCol=None, state=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def known(self) -> tuple[float, list[list[float]], list[int], dict[str, np.ndarray]]:
        """Mean label, edges, the roots' places and the node arrays of all trees one after another."""
        kept = json.loads(self.getOrDefault(self.state))
        nodes = {c: np.frombuffer(zlib.decompress(base64.b64decode(kept["nodes"][c])), kind) for c, kind in NODES.items()}
        return kept["mean"], kept["edges"], kept["roots"], nodes

    @property
    def toDebugString(self) -> str:
        mean, edges, roots, nodes = self.known()
        lines = [f"Forest of {len(roots)} trees"]
        for i, (feature, cut, left, value) in enumerate(zip(*nodes.values(), strict=True)):
            lines += [f"Tree {roots.index(i)}"] if i in roots else []
            split = f"feature {feature} <= {edges[feature][cut]:.12f}: {left}, else {left + 1}" if feature >= 0 else f"predict {value + mean:.12f}"
            lines.append(f"  {i}: {split}")
        return "\n".join(lines)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        mean, edges, roots, nodes = self.known()
        feature, cut, left, value = nodes.values()

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                bins = np.frombuffer(b"".join(batch), np.uint8).reshape(len(batch), -1) if len(batch) else np.empty((0, len(edges)), np.uint8)
                total = np.zeros(len(bins))
                for root in roots:
                    at, rows = np.full(len(bins), root), np.arange(len(bins))
                    while len(rows):
                        rows = rows[feature[at[rows]] >= 0]
                        node = at[rows]
                        at[rows] = left[node] + (bins[rows, feature[node]] > cut[node])
                    total += value[at]
                yield pd.Series(total / len(roots) + mean)

        return dataset.withColumn(self.getOutputCol(), scored(binned(dataset, edges, self.getFeaturesCol())))


def fit_forest(
    train: DataFrame,
    settings: dict,
    classes: bool,
    seed: int,
    output: str,
    features: str = "features",
    label: str = "_label",
    weight: str | None = None,
    local_bytes: int = LOCAL_BYTES,
) -> Forest:
    """Fit on rows of a feature vector and a label; for ``classes`` (labels 0 and 1) the prediction is the probability of 1. Settings have
    Spark's names: numTrees, maxDepth, minInstancesPerNode, featureSubsetStrategy."""
    edges = bin_edges(train, features)
    rows = pin(
        train.select(
            binned(train, edges, features).alias("bins"),
            F.monotonically_increasing_id().alias("id"),
            F.col(label).cast("double").alias("label"),
            (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        )
    )
    found = rows.agg(F.sum(F.col("label") * F.col("weight")) / F.nullif(F.sum("weight"), F.lit(0.0)), F.count("*"), F.count("label")).first()
    if not edges or found[1] != found[2]:
        raise ValueError("a forest needs rows, and a label in each")
    mean, width, trees = float(found[0] or 0.0), len(edges), settings["numTrees"]
    looks = features_looked_at(settings.get("featureSubsetStrategy", "auto"), width, trees, classes)
    s = Growth(trees, settings["maxDepth"], settings["minInstancesPerNode"], looks, seed)
    centred, most = rows.withColumn("label", F.col("label") - F.lit(mean)), max(1, local_bytes // width)
    if found[1] <= most:
        tasks = min(trees, train.sparkSession.sparkContext.defaultParallelism)
        grown = {r["tree"]: _nodes(r) for r in _grown(centred, s, [[(t, 1) for t in range(i, trees, tasks)] for i in range(tasks)], {})}
        forest = [grown[t] for t in range(trees)]
    else:
        widths, forest = [len(e) + 2 for e in edges], []
        for i in range(0, trees, TOGETHER):
            forest += _grown_from_top(centred, s, list(range(i, min(i + TOGETHER, trees))), widths, most)
    unpin(rows)
    roots = np.cumsum([0, *(len(t["left"]) for t in forest[:-1])]).tolist()
    nodes = {c: np.concatenate([t[c] for t in forest]) for c in NODES}
    starts = np.repeat(roots, [len(t["left"]) for t in forest])
    nodes["left"] = np.where(nodes["feature"] >= 0, nodes["left"] + starts, 0).astype(NODES["left"])
    packed = {c: base64.b64encode(zlib.compress(a.tobytes(), 1)).decode() for c, a in nodes.items()}
    return Forest(featuresCol=features, outputCol=output, state=json.dumps({"mean": mean, "edges": edges, "roots": roots, "nodes": packed}))
