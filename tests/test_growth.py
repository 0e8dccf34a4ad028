"""Parts, passes and blocks that follow the number of rows."""
import numpy as np
import pytest

from panelscore.operators import boosting as bo
from panelscore.plans import queries
from panelscore.sources import bindings as B
from panelscore.sources import io


def test_parts_follow_the_rows():
    assert [io.parts_for(n) for n in (0, 1, io.ROWS_A_TASK, io.ROWS_A_TASK + 1, 1 << 60)] == [1, 1, 1, 2, 100_000]
    assert io.parts_for(5, 8) == 8


def test_buckets_follow_the_rows(spark, sf_dir, monkeypatch):
    """More rows, more buckets (they were eight): a bucket is read, sorted and folded by one task."""
    seen = []
    write = io.write_bucketed
    monkeypatch.setattr(io, "write_bucketed", lambda df, path, key, order, buckets: seen.append(buckets) or write(df, path, key, order, buckets))
    few = sorted(map(tuple, queries.mart_bucketed(spark, sf_dir).collect()))
    rows = B.history_rows(spark, sf_dir)
    monkeypatch.setattr(io, "ROWS_A_TASK", rows // 20)
    assert sorted(map(tuple, queries.mart_bucketed(spark, sf_dir).collect())) == few and seen == [8, -(-rows // (rows // 20))]


@pytest.mark.parametrize("name", ["mart_segmented", "client_mart"])
def test_a_histories_parts_follow_its_rows(spark, sf_dir, monkeypatch, name):
    few = sorted(map(tuple, queries.REGISTRY[name](spark, sf_dir).collect()))
    monkeypatch.setattr(io, "ROWS_A_TASK", B.history_rows(spark, sf_dir) // 20)
    assert B.lineitem_history(spark, sf_dir).rdd.getNumPartitions() in (20, 21)
    assert sorted(map(tuple, queries.REGISTRY[name](spark, sf_dir).collect())) == few


def _tree(depth=9):
    """A chain: every right child is split again."""
    n = 2 * depth + 1
    t = bo.Tree(np.full(n, -1), *[np.zeros(n, np.int64) for _ in range(3)], np.arange(n, dtype=float), np.zeros(n), np.zeros(n, np.int64))
    for d in range(depth):
        t.feature[2 * d], t.bin[2 * d], t.left[2 * d], t.right[2 * d] = d % 3, 20 * d + 5, 2 * d + 1, 2 * d + 2
    return t


def test_rows_find_their_leaves():
    t, bins = _tree(), np.random.default_rng(1).integers(0, 256, (2000, 3)).astype(np.uint8)
    want = []
    for row in bins:
        at = 0
        while t.feature[at] >= 0:
            at = int(t.left[at] if row[t.feature[at]] <= t.bin[at] else t.right[at])
        want.append(at)
    assert t.leaves_of(bins).tolist() == want and t.leaves_of(bins[:0]).tolist() == []


def test_a_tree_of_many_rows_takes_few_passes(spark, monkeypatch):
    """``whole`` follows the rows: sixteen times the rows, no more passes. It was fixed, so passes grew with the tree's depth."""
    settings = bo.Settings(rate=0.3, l2=2.0, rounds=1, patience=5, borders=31, leaves=32, least_rows=4)
    monkeypatch.setattr(bo, "WHOLE", 100)
    passes = []
    merged = bo.merged
    monkeypatch.setattr(bo, "merged", lambda *a: passes.append(1) or merged(*a))
    trees, counts = [], []
    for copies in (1, 16):
        rng = np.random.default_rng(3)
        a, b = rng.normal(size=500), rng.normal(size=500)
        rows = [(i * 500 + j, float(a[j]), float(b[j]), int(a[j] + np.sin(3 * b[j]) > 0.5)) for i in range(copies) for j in range(500)]
        df = spark.createDataFrame(rows, "id long, a double, b double, flag int").repartition(4)
        passes.clear()
        model = bo.fit(["a", "b"], df, df.limit(0), settings=settings)
        counts.append(len(passes))
        assert bo.fit(["a", "b"], df, df.limit(0), settings=settings, whole=30).trees[0].rows.tolist() == model.trees[0].rows.tolist()
        trees.append(model.trees[0])
    assert counts[1] <= counts[0] + 3 and trees[0].rows[0] * 16 == trees[1].rows[0]


def test_symmetric_trees_are_walked_by_level():
    levels = [(2, 9, 1.0), (0, 100, 0.5), (1, 30, 0.2)]
    t, bins = bo._symmetric_nodes(levels, np.ones((3, 8), np.int64), bo.COMPARISON), np.random.default_rng(2).integers(0, 129, (999, 3)).astype(np.uint8)
    assert t.levels() == [(f, b) for f, b, _ in levels] and _tree().levels() is None and _tree(1).levels() == [(0, 5)]
    assert t.leaves_of(bins).tolist() == (bo._symmetric_leaf(bins, levels) + 7).tolist()
    none = bo._symmetric_nodes([], np.ones((3, 1), np.int64), bo.COMPARISON)
    assert none.leaves_of(bins).tolist() == [0] * 999


def test_both_models_read_one_sketch(spark, sf_dir, monkeypatch):
    """The borders of 128 and of 255 a feature come from one aggregate (each model made its own sketches)."""
    df = spark.range(30_000).selectExpr("id", "id * 7919 % 10007 / 3 AS a", "CASE WHEN id % 5 > 0 THEN id % 11 END AS b", "CAST(NULL AS DOUBLE) AS c")
    both = bo.shared_borders(df, ["a", "b", "c"], [128, 255])
    for count in (128, 255):
        assert [x.tolist() for x in both[count]] == [x.tolist() for x in bo.quantile_borders(df, ["a", "b", "c"], count)]
    made = []
    shared = bo.shared_borders
    monkeypatch.setattr(bo, "shared_borders", lambda *a: made.append(1) or shared(*a))
    monkeypatch.setattr(queries, "ML_ROUNDS", 1)
    assert queries.REGISTRY["model_comparison"](spark, sf_dir).count() == 3 and len(made) == 1


def test_a_pass_walks_few_trees(spark, monkeypatch):
    """Inside a spell the rows get their margins after a few leaf-wise trees: a pass applied up to nine of them."""
    settings = bo.Settings(rate=0.3, l2=2.0, rounds=12, patience=50, borders=31, leaves=8, least_rows=4)
    df = spark.range(600).selectExpr("id", "id * 37 % 101 / 7 AS a", "id * 53 % 97 / 3 AS b", "CAST(id * 37 % 101 + id * 53 % 97 > 100 AS INT) AS flag").repartition(3)
    seen = []
    grow = bo.leafwise_tree
    monkeypatch.setattr(bo, "leafwise_tree", lambda rows, n, now, *a: seen.append(len(now.pending)) or grow(rows, n, now, *a))
    one = bo.fit(["a", "b"], df, df, settings=settings)
    assert seen == [0, 1, 2] * 3 + [0] + [0, 1]
    monkeypatch.setattr(bo, "PENDING", 99)
    other = bo.fit(["a", "b"], df, df, settings=settings)
    assert one.history == other.history and all(np.array_equal(x, y) for s, t in zip(one.trees, other.trees) for x, y in zip(s, t))


def test_settings_are_as_before_after_a_fit(spark):
    before = {k: spark.conf.get(k) for k in bo._READING}
    with pytest.raises(ValueError), io.settings(spark, bo._READING):
        assert {k: spark.conf.get(k) for k in bo._READING} == bo._READING
        raise ValueError
    assert {k: spark.conf.get(k) for k in bo._READING} == before


def test_score_test_folds_the_history_once(spark, sf_dir, monkeypatch):
    """The clients to learn from and those to score are rows of one mart (it was folded for each)."""
    folded = []
    fold_history = queries.fold.fold_history
    monkeypatch.setattr(queries.fold, "fold_history", lambda *a, **k: folded.append(1) or fold_history(*a, **k))
    monkeypatch.setattr(queries, "ML_ROUNDS", 1)
    scored = {r["id"] for r in queries.REGISTRY["score_test"](spark, sf_dir).collect()}
    new = {r["id"] for r in B.clients_by_date(spark, sf_dir)[1].join(B.history_clients(spark, sf_dir), "id", "left_semi").collect()}
    assert len(folded) == 1 and scored == new and new


def test_parts_follow_the_rows_under_few_shuffle_partitions(spark, sf_dir, monkeypatch):
    """Fewer shuffle partitions than cores: a table of a few rows a core was left to them, several times the rows a task."""
    few = sorted(map(tuple, queries.REGISTRY["mart_segmented"](spark, sf_dir).collect()))
    with io.settings(spark, {"spark.sql.shuffle.partitions": "1"}):
        monkeypatch.setattr(io, "ROWS_A_TASK", B.history_rows(spark, sf_dir) // 3)
        assert B.lineitem_history(spark, sf_dir).rdd.getNumPartitions() in (3, 4)
        assert sorted(map(tuple, queries.REGISTRY["mart_segmented"](spark, sf_dir).collect())) == few
