import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from orderflow.ml import boosting
from orderflow.ml.boosting import LOGISTIC, SQUARED, Settings, fit_boosted


def literal(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 40, n) / 3, rng.integers(0, 30, n) * 1.0, rng.integers(0, 2, n) * 1.0, rng.integers(-20, 20, n) * 0.7], axis=1)
    days = 3 * x[:, 0] + np.where(x[:, 2] > 0, x[:, 3], -2) + np.where(x[:, 1] < 8, 25, 0) + rng.normal(0, 1, n)
    x[(rng.random(n) < 0.5) & (x[:, 1] < 8), 1] = np.nan  # missing is like small
    return x, days, (days > np.quantile(days, 0.7)).astype(float), rng.integers(1, 4, n).astype(float)


def plain_trees(x, label, weight, loss, s, base):
    """All splits of all nodes by masks over the raw values."""
    score, out = np.full(len(x), base), []
    for _ in range(s.trees):
        if loss == SQUARED:
            g, h = weight * (score - label), weight
        else:
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (p - label), weight * p * (1 - p)
        level, splits = [np.ones(len(x), bool)], []
        for depth in range(s.depth):
            below = []
            for rows in level:
                best = None
                for f in range(x.shape[1]):
                    for cut in sorted({v for v in x[:, f] if not math.isnan(v)}):
                        for missing_left in (False, True) if np.isnan(x[rows, f]).any() else (False,):
                            with np.errstate(invalid="ignore"):
                                left = rows & ((x[:, f] <= cut) | (np.isnan(x[:, f]) & missing_left))
                            right = rows & ~left
                            hl, hr = h[left].sum(), h[right].sum()
                            if min(left.sum(), right.sum()) < max(1, s.least_rows) or min(hl, hr) < s.least_hessian:
                                continue
                            gain = g[left].sum() ** 2 / (hl + s.l2) + g[right].sum() ** 2 / (hr + s.l2) - g[rows].sum() ** 2 / (h[rows].sum() + s.l2)
                            if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, cut, missing_left, left, right)
                if best:
                    splits.append((best[1], best[2], best[3]))
                    for part in best[4:]:
                        below.append(part)
                else:
                    score = score - rows * s.step * (g[rows].sum() / (h[rows].sum() + s.l2)) if depth else score
            level = below
        for rows in level:
            score = score - rows * s.step * (g[rows].sum() / (h[rows].sum() + s.l2))
        out.append(splits)
    return out, score


@pytest.mark.parametrize("loss", [SQUARED, LOGISTIC])
def test_trees_equal_a_plain_version(spark, monkeypatch, tmp_path, loss):
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    x, days, late, weight = literal()
    label = days if loss == SQUARED else late
    rows = [(Vectors.dense(a), float(b), float(w)) for a, b, w in zip(x, label, weight)]
    frame = spark.createDataFrame(rows, ["features", "_label", "w"]).repartition(5)
    s = Settings(trees=5, step=0.3, depth=3, l2=1.5, least_hessian=2.0, least_rows=7)
    base = float(label.mean()) if loss == SQUARED else 0.0
    splits, score = plain_trees(x, label, weight, loss, s, base)
    model = fit_boosted(frame, loss, s, "out", weight="w")
    edges = boosting.json.loads(model.getOrDefault(model.state))["edges"]
    got = []
    for tree in model.trees():
        order, level = [], [0]
        while level:
            inner = [n for n in level if tree.feature[n] >= 0]
            order += [(tree.feature[n], edges[tree.feature[n]][tree.bin[n]], tree.missing_left[n]) for n in inner]
            level = [c for n in inner for c in (tree.left[n], tree.right[n])]
        got.append(order)
    assert got == splits and any(m for t in got for _, _, m in t)
    want = score if loss == SQUARED else 1 / (1 + np.exp(-score))
    ordered = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], ["i", "features"])
    assert np.allclose([r.out for r in model.transform(ordered).orderBy("i").collect()], want, atol=1e-9)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(ordered).orderBy("i").collect()
    assert np.allclose([r.out for r in again], want, atol=1e-9)


def test_sampling_follows_rows_and_not_their_dealing(spark):
    x, days, _, _ = literal(300, 4)
    frame = spark.createDataFrame([(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, days))], ["key", "features", "_label"])
    s = Settings(trees=3, step=0.5, depth=3, rows=0.6, features=0.5)
    one, two = (
        fit_boosted(frame.repartition(n), SQUARED, s, "out", row_id="key").transform(frame).orderBy("key").select("out").collect() for n in (1, 7)
    )
    assert np.allclose([r.out for r in one], [r.out for r in two], atol=1e-9)
    shares = boosting.drawn(1, 2, np.arange(20_000))
    assert abs((shares < 0.6).mean() - 0.6) < 0.02 and abs(np.corrcoef(shares, boosting.drawn(1, 3, np.arange(20_000)))[0, 1]) < 0.03
    chosen = [tuple(boosting.Booster(SQUARED, s, [3] * 10).chosen_features(t)) for t in range(20)]
    assert all(len(c) == 5 for c in chosen) and len(set(chosen)) > 10


def test_rows_without_any_split_and_empty_frames(spark):
    frame = spark.createDataFrame([(Vectors.dense([1.0, float("nan")]), 2.0)] * 4, ["features", "_label"])
    model = fit_boosted(frame, SQUARED, Settings(trees=2, step=0.5, depth=2), "out")
    assert {r.out for r in model.transform(frame).collect()} == {2.0}
    assert model.transform(frame.limit(0)).count() == 0
    assert model.transform(frame.limit(1).withColumn("more", F.lit(1))).columns[-1] == "out"
