"""Boosted trees: against brute force, independent of partitioning, early stopping and resuming without refits."""
import heapq
import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscore.functions.splitmix import unit_hash_reference
from panelscore.operators import boosting as bo
from panelscore.operators import metrics

FEATURES = ["a", "b", "c"]
LEAF = bo.Settings(rate=0.3, l2=2.0, rounds=4, patience=50, borders=15, leaves=6, least_rows=8, features=0.7, rows=0.8)
SYMMETRIC = bo.Settings(rate=0.3, l2=2.0, rounds=4, patience=50, borders=15, symmetric=True, depth=3, average=False)


def _rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), float(rng.randint(0, 6)), rng.choice([None, float("nan"), rng.random()])
        out.append((i * 7 + seed, a, b, c, int(a + 0.3 * b + rng.gauss(0, 0.7) > 1.2)))
    return out


SCHEMA = "id long, a double, b double, c double, flag int"


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(_rows(600, 1), SCHEMA).repartition(5).cache(), spark.createDataFrame(_rows(300, 2), SCHEMA).cache()


def _bins(rows, borders):
    return np.array([[len(b) if v is None or v != v else sum(x <= v for x in b) for v, b in zip(r[1:4], borders)] for r in rows])


def _gain(g, h, n, left, s):
    def value(m):
        return (sum(g[m]) / bo.UNIT) ** 2 / (sum(h[m]) / bo.UNIT + s.l2)
    return value(left) + value(~left & n) - value(n)


def _brute_tree(bins, g, h, drawn, features, s):
    """Best-first growth, every split tried one by one: the list of (gain, feature, bin, rows) and the leaves' row masks."""
    def best(mask):
        found = None
        for f in features:
            for t in sorted(set(bins[mask, f])):
                left = mask & (bins[:, f] <= t)
                if left.sum() >= s.least_rows and (mask & ~left).sum() >= s.least_rows:
                    gain = _gain(g, h, mask, left, s)
                    if gain > bo.LEAST_GAIN and (found is None or gain > found[0] + 1e-12):
                        found = (gain, f, int(t))
        return found

    leaves, heap, splits, count = {0: drawn}, [], [], 1
    if b := best(drawn):
        heap.append((-b[0], 0, b))
    routes = {0: np.ones(len(bins), bool)}
    while heap and len(leaves) < s.leaves:
        _, node, (gain, f, t) = heapq.heappop(heap)
        mask, route = leaves.pop(node), routes.pop(node)
        splits.append((gain, f, t, int(mask.sum())))
        for side in (bins[:, f] <= t, bins[:, f] > t):
            leaves[count], routes[count] = mask & side, route & side
            if b := best(leaves[count]):
                heapq.heappush(heap, (-b[0], count, b))
            count += 1
    return splits, [(routes[i], leaves[i]) for i in leaves]


def test_leafwise_trees_equal_brute_force(spark, data):
    train, valid = data
    model = bo.fit(FEATURES, train, valid, settings=LEAF)
    full = replace(model)
    rows = sorted(map(tuple, train.collect()))
    y = np.array([r[4] for r in rows])
    bins = _bins(rows, model.borders)
    margin = np.full(len(rows), math.log(y.mean() / (1 - y.mean())))
    assert model.base == margin[0]
    for number, tree in enumerate(full.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = bo.whole_units(p - y), bo.whole_units(p * (1 - p))
        drawn = np.array([unit_hash_reference(r[0], bo.ROUND_SEED + number) < LEAF.rows for r in rows])
        splits, leaves = _brute_tree(bins, g, h, drawn, bo.feature_sample(3, LEAF.features, number), LEAF)
        got = sorted((round(float(tree.gain[i]), 9), int(tree.feature[i]), int(tree.bin[i]), int(tree.rows[i])) for i in range(len(tree.feature)) if tree.feature[i] >= 0)
        assert got == sorted((round(gain, 9), f, t, n) for gain, f, t, n in splits) and 0 < len(got) < LEAF.leaves
        for route, mask in leaves:
            margin[route] += -LEAF.rate * (g[mask].sum() / bo.UNIT) / (h[mask].sum() / bo.UNIT + LEAF.l2)
    scored = {r["id"]: r["y_score"] for r in bo.score(model, train).collect()}
    assert np.allclose([scored[r[0]] for r in rows], 1 / (1 + np.exp(-margin)), atol=1e-12)


def test_symmetric_trees_equal_brute_force(data):
    train, valid = data
    model = bo.fit(FEATURES, train, valid, settings=SYMMETRIC)
    rows = sorted(map(tuple, train.collect()))
    y, bins, margin = np.array([r[4] for r in rows]), _bins(rows, model.borders), np.zeros(len(rows))
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = bo.whole_units(p - y), bo.whole_units(p * (1 - p))
        leaf = np.zeros(len(rows), int)
        for d in range(SYMMETRIC.depth):
            tried = [(sum(_gain(g, h, leaf == v, (leaf == v) & (bins[:, f] <= t), SYMMETRIC) for v in set(leaf)), -f, -t) for f in range(3) for t in range(SYMMETRIC.borders + 1)]
            gain = max(t[0] for t in tried)
            f, t = next((-f, -t) for v, f, t in sorted(tried, key=lambda t: (-t[1], -t[2])) if v > gain - 1e-9)
            first = (1 << d) - 1
            assert (tree.feature[first], tree.bin[first]) == (f, t) and abs(tree.gain[first] - gain) < 1e-9
            leaf = 2 * leaf + (bins[:, f] > t)
        for v in set(leaf):
            margin[leaf == v] += -SYMMETRIC.rate * (g[leaf == v].sum() / bo.UNIT) / (h[leaf == v].sum() / bo.UNIT + SYMMETRIC.l2)
        assert len(tree.feature) == 2 ** (SYMMETRIC.depth + 1) - 1
    scored = {r["id"]: r["y_score"] for r in bo.score(model, train).collect()}
    assert np.allclose([scored[r[0]] for r in rows], 1 / (1 + np.exp(-margin)), atol=1e-12)


def _same(x, y):
    return len(x) == len(y) and all(all(np.array_equal(a, b) for a, b in zip(s, t)) for s, t in zip(x, y))


@pytest.mark.parametrize("settings", [LEAF, SYMMETRIC])
def test_trees_do_not_depend_on_partitions_or_on_where_they_are_grown(data, settings):
    train, valid = data
    one = bo.fit(FEATURES, train, valid, settings=settings)
    for parts, whole in ((1, bo.WHOLE), (7, 100), (3, 1)):
        assert _same(one.trees, bo.fit(FEATURES, train.repartition(parts), valid, settings=settings, whole=whole).trees)


def test_sums_of_many_tasks_are_merged_in_groups(data, monkeypatch):
    train, valid = data
    one = bo.fit(FEATURES, train, valid, settings=LEAF, rounds=1, whole=100)
    monkeypatch.setattr(bo, "MERGE", 2)
    assert _same(one.trees, bo.fit(FEATURES, train.repartition(7), valid, settings=LEAF, rounds=1, whole=100).trees)


def _counted(monkeypatch, name):
    calls, fn = [], getattr(bo, name)
    monkeypatch.setattr(bo, name, lambda *a, **k: calls.append(1) or fn(*a, **k))
    return calls


def test_patience_ends_a_fit_and_every_tree_is_fitted_once(data, monkeypatch):
    train, valid = data
    calls = _counted(monkeypatch, "leafwise_tree")
    model = bo.fit(FEATURES, train, valid, settings=replace(LEAF, rate=1.0, rounds=500, patience=4))
    assert len(calls) == model.trained < 500 and model.trained % bo.SPELL == 0
    best, spent = bo.best_iteration(model.history, 4, True)
    assert spent and model.rounds == best == int(np.argmax(model.history[:best])) + 1


def test_a_stopped_fit_goes_on_without_refitting(data, monkeypatch, tmp_path):
    train, valid = data
    settings = replace(SYMMETRIC, rounds=14)
    whole = bo.fit(FEATURES, train, valid, settings=settings)
    state = str(tmp_path / "state")
    bo.fit(FEATURES, train, valid, settings=settings, rounds=10, state=state)
    calls = _counted(monkeypatch, "symmetric_tree")
    resumed = bo.fit(FEATURES, train, valid, settings=settings, state=state)
    assert len(calls) == 4 and _same(whole.trees, resumed.trees) and whole.history == resumed.history
    with pytest.raises(ValueError, match="another|other"):
        bo.fit(["a", "b"], train, valid, settings=settings, state=state)


def test_the_validation_metric_is_exact(data):
    train, valid = data
    model = bo.fit(FEATURES, train, valid, settings=LEAF)
    at_best = metrics.ranking_metrics(bo.score(model, valid)).first()["roc_auc"]
    assert abs(model.history[model.rounds - 1] - at_best) < 1e-12
    losses = bo.fit(FEATURES, train, valid, settings=LEAF, metric="logloss")
    rows = bo.score(losses, valid).collect()
    assert abs(losses.history[losses.rounds - 1] - np.mean([-math.log(r["y_score"] if r["y_true"] else 1 - r["y_score"]) for r in rows])) < 1e-9


def test_best_iteration_has_patience():
    assert bo.best_iteration([5, 4, 3, 3.5, 3.2, 2, 1], 4, False) == (7, False)
    assert bo.best_iteration([5, 4, 3, 3.5, 3.2, 2, 1], 2, False) == (3, True)
    assert bo.best_iteration([1, 1, 1], 150, True) == (1, False)
    assert bo.best_iteration([.5, .7, .7, .6], 2, True) == (2, True)


@pytest.mark.parametrize("settings", [LEAF, SYMMETRIC])
def test_saved_model_scores_the_same_and_is_a_node_table(spark, data, settings, tmp_path):
    train, valid = data
    model = bo.fit(FEATURES, train, valid, settings=settings)
    bo.save(spark, model, str(tmp_path / "m"))
    again = bo.load(spark, str(tmp_path / "m"))
    assert _same(model.trees, again.trees) and replace(again, trees=()) == replace(model, trees=())
    assert bo.score(model, valid).exceptAll(bo.score(again, valid.select("flag", "c", "b", "a", "id"))).count() == 0
    nodes = {(r["tree"], r["node"]): r for r in bo.node_table(spark, model).collect()}
    for r, want in zip(valid.orderBy("id").collect()[:50], bo.score(model, valid).orderBy("id").collect()):
        margin = model.base
        for t in range(model.rounds):
            at = nodes[t, 0]
            while at["feature"]:
                v = r[at["feature"]]
                at = nodes[t, at["left"] if v is not None and v < at["threshold"] else at["right"]]
            margin += at["value"]
        assert abs(1 / (1 + math.exp(-margin)) - want["y_score"]) < 1e-12


def test_importance_is_the_share_of_gain(spark, data):
    train, valid = data
    model = bo.fit(FEATURES, train, valid, settings=LEAF)
    rows = {r["feature"]: r for r in bo.feature_importance(spark, model).collect()}
    gains = [sum(float(t.gain[t.feature == i].sum()) for t in model.trees) for i in range(3)]
    assert list(rows) == sorted(FEATURES, key=lambda f: -gains[FEATURES.index(f)])
    assert all(abs(rows[f]["importance"] - g / sum(gains)) < 1e-12 for f, g in zip(FEATURES, gains))


@pytest.mark.parametrize("settings", [LEAF, SYMMETRIC])
def test_degenerate_tables(spark, settings):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(_rows(60, 3), SCHEMA)
    assert bo.fit(FEATURES, empty, empty, settings=settings).rounds == 0
    one_class = bo.fit(FEATURES, some.withColumn("flag", F.lit(0)), empty, settings=settings, rounds=2)
    assert one_class.rounds == 2 and all(r["y_score"] <= 0.5 for r in bo.score(one_class, some).collect())
    constant = bo.fit(["a"], some.withColumn("a", F.lit(1.0)), some, settings=settings, rounds=2)
    assert all(len(t.feature) == 1 for t in constant.trees)
    text_keys = bo.fit(FEATURES, some.withColumn("id", F.col("id").cast("string")), some.withColumn("id", F.col("id").cast("string")), settings=settings, rounds=1)
    assert text_keys.rounds == 1


def test_unit_hash_equals_the_column_hash():
    keys = [0, 1, -1, 2**62, -(2**63), 12345]
    assert bo.unit_hash(np.array(keys), 42).tolist() == [unit_hash_reference(k & (2**64 - 1), 42) for k in keys]
