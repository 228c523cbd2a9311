"""Extremely randomised trees against a plain version that grows one node after the other."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from orderflow.ml.boosting import Settings, drawn
from orderflow.ml.extra_trees import fit_extra_trees


def literal(n=300, seed=5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 40, n) / 3, rng.integers(0, 30, n) * 1.0, rng.integers(0, 2, n) * 1.0, rng.integers(-20, 20, n) * 0.7], axis=1)
    days = 3 * x[:, 0] + np.where(x[:, 2] > 0, x[:, 3], -2) + rng.normal(0, 1, n)
    return x, days, rng.integers(1, 4, n).astype(float)


def plain_tree(x, y, w, s, number):
    """Predictions for x; nodes are numbered level by level, as splits are found."""
    every = [np.unique(x[:, f]) for f in range(x.shape[1])]
    level, count, out = [(0, np.ones(len(x), bool), [(e[0], e[-1]) for e in every])], 1, np.zeros(len(x))
    for depth in range(s.depth + 1):
        below = []
        for node, rows, limits in level:
            ids = np.array([node * x.shape[1] + f for f in range(x.shape[1])])
            looked = np.argsort(drawn(s.seed + 1, number, ids), kind="stable")[: max(1, int(s.features * len(ids)))]
            best = None
            for f in sorted(looked.tolist()):
                low, high = limits[f]
                at = low + drawn(s.seed, number, ids[f : f + 1])[0] * (high - low)
                cut = min(every[f][every[f] <= at][-1], every[f][every[f] < high][-1]) if low < high else None
                if cut is None or depth == s.depth:
                    continue
                left, right = rows & (x[:, f] <= cut), rows & (x[:, f] > cut)
                if min(left.sum(), right.sum()) < s.least_rows:
                    continue
                spread = lambda m: (w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum()
                gain = spread(rows) - spread(left) - spread(right)
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut, left, right)
            if best is None:
                out[rows] = np.average(y[rows], weights=w[rows])
                continue
            _, f, cut, left, right = best
            above = every[f][every[f] > cut][0]
            for part, limit in ((left, (limits[f][0], cut)), (right, (above, limits[f][1]))):
                below.append((count, part, [*limits[:f], limit, *limits[f + 1 :]]))
                count += 1
        level = below
    return out


@pytest.mark.parametrize("binary", [False, True])
def test_trees_equal_a_plain_version(spark, binary):
    x, y, w = literal()
    y = (y > np.quantile(y, 0.7)).astype(float) if binary else y
    s = Settings(trees=7, step=1.0, depth=5, least_rows=6, features=0.5, seed=11)
    frame = spark.createDataFrame([(i, Vectors.dense(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w))], ["i", "features", "_label", "w"])
    want = np.mean([plain_tree(x, y, w, s, n) for n in range(s.trees)], axis=0)
    for parts in (1, 6):
        model = fit_extra_trees(frame.repartition(parts), s, "out", weight="w")
        got = {r.i: r.out for r in model.transform(frame).select("i", "out").collect()}
        assert np.allclose([got[i] for i in range(len(x))], want)


def test_missing_values_and_empty_tables(spark):
    nan = float("nan")
    rows = [(Vectors.dense([float(i % 5), nan if i % 3 else 1.0]), float(i % 5)) for i in range(60)]
    frame = spark.createDataFrame(rows, ["features", "_label"])
    model = fit_extra_trees(frame, Settings(trees=3, step=1.0, depth=6, least_rows=1), "out")
    assert all(0 <= r.out <= 4 for r in model.transform(frame).collect())
    assert len({t.bin[0] for t in model.trees()}) >= 1 and all(len(t.value) > 1 for t in model.trees())
    one = frame.where("_label = 2")
    assert {r.out for r in fit_extra_trees(one, Settings(trees=4, step=1.0, depth=6), "out").transform(one).collect()} == {2.0}
