import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderflow.ml import forests
from orderflow.ml.models import CLASSIFIERS, REGRESSORS
from orderflow.plans import queries as catalogue
from orderflow.session import pin_partitions


def test_model_compare_fits_every_base_family(spark, tiny):
    got = {r["model_name"]: r for r in catalogue.model_compare(spark, tiny).collect()}
    assert set(got) == {*CLASSIFIERS, *REGRESSORS, "ridge", "ridge_log_target", "elastic_net"}
    assert 0 <= got["random_forest"]["pr_auc"] <= 1 and got["random_forest_regressor"]["mae"] > 0
    late, days = catalogue._fitted(spark, tiny)
    assert late.best_metrics["pr_auc"] == max(r["pr_auc"] for r in got.values() if r["pr_auc"] is not None)
    assert days.best_metrics["mae"] == min(r["mae"] for r in got.values() if r["mae"] is not None)


def rows_of_bins(rows: int, widths: list[int], seed: int):
    """Bins, and labels in pairs y, -y of the same weight: all sums of the tests are exact and the mean is 0."""
    random = np.random.default_rng(seed)
    bins = np.stack([random.integers(0, w, rows) for w in widths], axis=1).astype(np.uint8)
    half = random.integers(1, 9, rows // 2)
    weight = random.choice([0.5, 1.0, 2.0], rows // 2)
    order = random.permutation(rows)
    return bins, np.concatenate((half, -half))[order].astype(float), np.concatenate((weight, weight))[order]


def plain_tree(bins, label, weight, s, number, path, ids):
    """One node after the other, one cut after the other; nested (feature, cut, left, right) or the value."""
    count = forests.times(s.seed, number, ids)
    two = [f for f in range(bins.shape[1]) if bins[:, f].max() == 1]
    order = [f for f in range(bins.shape[1]) if f not in two] + two

    def node(rows, path):
        c, y = count[rows], label[rows]
        w = c * weight[rows]
        g, best = (w * y).sum(), None
        if path.bit_length() <= s.depth and len(set(y)) > 1:
            looks = forests.looked_at(s, number, np.array([path]), bins.shape[1])[0]
            least = g * g / w.sum() + forests.LEAST_GAIN * (w * y * y).sum()
            for f in (f for f in order if looks[f]):
                for cut in sorted(set(bins[rows, f])):
                    left = bins[rows, f] <= cut
                    if min(c[left].sum(), c[~left].sum()) >= s.least_rows:
                        gl, wl = (w * y)[left].sum(), w[left].sum()
                        gain = gl * gl / wl + (g - gl) ** 2 / (w.sum() - wl)
                        if gain > least and (best is None or gain > best[0]):
                            best = (gain, f, int(cut), left)
        if best is None:
            return g / w.sum()
        return best[1], best[2], node(rows[best[3]], 2 * path), node(rows[~best[3]], 2 * path + 1)

    return node(np.flatnonzero(count), path)


def nested(nodes, at=0):
    f, cut, left, value = (nodes[c][at] for c in forests.NODES)
    return value if f < 0 else (f, cut, nested(nodes, left), nested(nodes, left + 1))


@pytest.mark.parametrize(("features", "least", "depth", "chunk"), [(7, 1, 20, 50), (3, 4, 9, 1 << 15), (7, 5, 3, 1 << 15), (1, 2, 20, 1)])
def test_trees_equal_a_plain_version(monkeypatch, features, least, depth, chunk):
    monkeypatch.setattr(forests, "CHUNK", chunk)
    bins, label, weight = rows_of_bins(600, [250, 2, 30, 2, 3, 1, 2], 5)
    s = forests.Growth(3, depth, least, features, 42)
    ids = np.arange(600) * 3
    shuffled = np.random.default_rng(1).permutation(600)
    for number in range(3):
        table = forests.Table(bins[shuffled].T.copy(), ids[shuffled], label[shuffled], weight[shuffled])
        assert nested(forests.grow(table, s, number, 1)) == plain_tree(bins, label, weight, s, number, 1, ids)


def test_rows_are_counted_as_a_bootstrap_does():
    ids = np.concatenate([(np.arange(20_000) + (p << 33)) for p in range(3)])
    a, b = (forests.times(42, t, ids) for t in (0, 1))
    assert np.allclose([(a == k).mean() for k in range(4)], [0.3679, 0.3679, 0.1839, 0.0613], atol=0.01)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.02


def test_number_of_features_a_node_looks_at():
    found = [forests.features_looked_at(n, 121, 200, c) for n, c in (("auto", True), ("auto", False), ("0.8", False), ("all", True), ("3", True))]
    assert found == [11, 41, 97, 121, 3]
    s = forests.Growth(1, 5, 1, 11, 42)
    assert (forests.looked_at(s, 0, np.arange(1, 50), 121).sum(axis=1) == 11).all()


@pytest.fixture(scope="module")
def table(spark):
    bins, label, weight = rows_of_bins(800, [200, 2, 30, 2, 3], 7)
    rows = [(*map(float, b), y, w) for b, y, w in zip(bins.tolist(), label.tolist(), weight.tolist(), strict=True)]
    names = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame(rows, [*names, "_label", "_weight"]).repartition(3, "x0").sortWithinPartitions(*names, "_label")
    return df.select(array_to_vector(F.array(*names)).alias("features"), "_label", "_weight").transform(pin_partitions)


SETTINGS = {"numTrees": 7, "maxDepth": 8, "minInstancesPerNode": 3, "featureSubsetStrategy": "0.6"}


def predicted(model, table):
    return model.transform(table).toPandas().apply(lambda r: (*r["features"].toArray(), r["_label"], r["p"]), axis=1).sort_values().tolist()


def test_upper_levels_grow_the_same_trees_in_many_tasks(table):
    at_once = forests.fit_forest(table, SETTINGS, False, 42, "p", weight="_weight")
    for rows in (20, 300):
        by_levels = forests.fit_forest(table, SETTINGS, False, 42, "p", weight="_weight", local_bytes=rows * 5)
        assert len(by_levels.known()[3]["left"]) == len(at_once.known()[3]["left"])
        assert predicted(by_levels, table) == predicted(at_once, table)


def test_prediction_is_the_mean_of_trees_and_survives_a_save(table, tmp_path):
    model = forests.fit_forest(table, SETTINGS, False, 42, "p", weight="_weight")
    mean, edges, roots, nodes = model.known()
    assert len(roots) == 7 and mean == 0.0
    for *x, _, p in predicted(model, table)[:50]:
        bins = [int(np.searchsorted(e, v)) for e, v in zip(edges, x, strict=True)]
        total = 0.0
        for at in roots:
            while nodes["feature"][at] >= 0:
                at = nodes["left"][at] + (bins[nodes["feature"][at]] > nodes["cut"][at])
            total += nodes["value"][at]
        assert p == pytest.approx(total / 7)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    assert predicted(PipelineModel.load(str(tmp_path / "m")), table) == predicted(model, table)


def test_missing_values_equal_labels_and_empty_tables(spark, table):
    gaps = table.withColumn("features", array_to_vector(F.array(F.lit(float("nan")), F.col("_label"))))
    got = forests.fit_forest(gaps, {**SETTINGS, "featureSubsetStrategy": "all"}, False, 42, "p").transform(gaps)
    assert got.where("abs(p - _label) > 2").count() == 0
    same = forests.fit_forest(table.withColumn("_label", F.lit(1.0)), SETTINGS, True, 42, "p")
    assert {r["p"] for r in same.transform(table).select("p").distinct().collect()} == {1.0}
    with pytest.raises(ValueError, match="needs rows"):
        forests.fit_forest(table.limit(0), SETTINGS, False, 42, "p")
    with pytest.raises(ValueError, match="a label in each"):
        forests.fit_forest(table.withColumn("_label", F.lit(None).cast("double")), SETTINGS, False, 42, "p")
