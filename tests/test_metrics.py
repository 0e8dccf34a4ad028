"""Metrics against brute-force numpy definitions, FIXTURES §3 cases and SURVEY §5.2 properties."""
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscore.functions.splitmix import unit_hash_reference
from panelscore.operators import metrics, split


def _preds(spark, pairs):
    return spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(pairs)], "id long, y_true int, y_score double")


def _auc_brute(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def _ap_brute(y, s):
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for a, b in zip(y, s) if b >= t and a == 1)
        fp = sum(1 for a, b in zip(y, s) if b >= t and a == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def _ks_brute(y, s):
    """First maximum of TPR - FPR in descending score order, compared exactly."""
    P, N = sum(y), len(y) - sum(y)
    best, thr = Fraction(-1), None
    for t in sorted(set(s), reverse=True):
        tp = sum(1 for a, b in zip(y, s) if b >= t and a == 1)
        fp = sum(1 for a, b in zip(y, s) if b >= t and a == 0)
        if Fraction(tp, P) - Fraction(fp, N) > best:
            best, thr = Fraction(tp, P) - Fraction(fp, N), t
    return float(best), thr


def _random_pairs(seed, n=300):
    rnd = random.Random(seed)
    return [(int(rnd.random() < 0.3), round(rnd.random(), 2)) for _ in range(n)]  # many ties


@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_metrics_equal_brute_force(spark, seed):
    pairs = _random_pairs(seed)
    y, s = [p[0] for p in pairs], [p[1] for p in pairs]
    m = metrics.ranking_metrics(_preds(spark, pairs)).collect()[0]
    assert math.isclose(m["roc_auc"], _auc_brute(y, s), rel_tol=1e-12)
    assert math.isclose(m["gini"], 2 * m["roc_auc"] - 1, rel_tol=1e-12)
    assert math.isclose(m["average_precision"], _ap_brute(y, s), rel_tol=1e-9)
    ks, thr = _ks_brute(y, s)
    assert math.isclose(m["ks"], ks, rel_tol=1e-12) and m["ks_threshold"] == thr


def test_auc_invariant_under_monotone_map(spark):
    pairs = _random_pairs(3)
    a = metrics.ranking_metrics(_preds(spark, pairs)).collect()[0]["roc_auc"]
    b = metrics.ranking_metrics(_preds(spark, [(y, s ** 3 + 1) for y, s in pairs])).collect()[0]["roc_auc"]
    assert math.isclose(a, b, rel_tol=1e-12)


def test_tied_scores(spark):
    m = metrics.ranking_metrics(_preds(spark, [(1, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)])).collect()[0]
    assert m["roc_auc"] == 0.5 and m["average_precision"] == 0.5


def test_perfect_ranking(spark):
    m = metrics.ranking_metrics(_preds(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])).collect()[0]
    assert (m["roc_auc"], m["gini"], m["average_precision"], m["ks"]) == (1.0, 1.0, 1.0, 1.0)


def test_two_equal_ks_maxima_take_the_higher_score(spark):
    # TPR-FPR is 0.5 at 0.9 and again at 0.5
    pairs = [(1, 0.9), (0, 0.7), (1, 0.5), (0, 0.3)]
    m = metrics.ranking_metrics(_preds(spark, pairs)).collect()[0]
    assert m["ks"] == 0.5 and m["ks_threshold"] == 0.9


def test_useless_scores_put_the_threshold_at_infinity(spark):
    # positives always below negatives: TPR never exceeds FPR, sklearn's start point (inf) is the maximum
    m = metrics.ranking_metrics(_preds(spark, [(1, 0.1), (1, 0.2), (0, 0.8), (0, 0.9)])).collect()[0]
    assert m["ks"] == 0.0 and m["ks_threshold"] == float("inf") and m["roc_auc"] == 0.0
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in metrics.confusion_at_ks(
        _preds(spark, [(1, 0.1), (1, 0.2), (0, 0.8), (0, 0.9)])).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def test_one_class_gives_null(spark):
    m = metrics.ranking_metrics(_preds(spark, [(0, 0.1), (0, 0.4)])).collect()[0]
    assert m["roc_auc"] is None and m["ks"] is None and m["ks_threshold"] is None


def test_ks_is_max_of_ks_curve(spark):
    p = _preds(spark, _random_pairs(4))
    ks = metrics.ranking_metrics(p).collect()[0]["ks"]
    curve = metrics.ks_curve(p).select(F.max(F.col("cdf_neg") - F.col("cdf_pos"))).collect()[0][0]
    assert math.isclose(ks, curve, rel_tol=1e-9)


def test_confusion_cells_sum_to_rows(spark):
    p = _preds(spark, _random_pairs(5))
    cells = metrics.confusion_at_ks(p).collect()
    assert len(cells) == 4 and sum(r["n"] for r in cells) == 300


@pytest.mark.parametrize("probs", [[0.5, 0.9, 0.99], [0.0, 0.25, 1.0]])
def test_exact_percentiles_equal_numpy(spark, probs):
    rnd = np.random.default_rng(7)
    x = np.round(rnd.random(1001), 3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = {r["p"]: r["value"] for r in metrics.exact_percentiles(df, "x", probs).collect()}
    want = np.percentile(x, [p * 100 for p in probs])
    for p, w in zip(probs, want):
        assert got[p] == w  # bit-equal


def test_calibration_equals_quantile_rule(spark):
    pairs = [(int(v > 0.6), float(v)) for v in np.round(np.random.default_rng(3).random(500), 3)]
    y = np.array([a for a, _ in pairs]); s = np.array([b for _, b in pairs])
    bins = np.percentile(s, np.linspace(0, 1, 16) * 100)
    ids = np.searchsorted(bins[1:-1], s)
    got = {r["bin"]: r for r in metrics.calibration_table(_preds(spark, pairs)).collect()}
    for b in np.unique(ids):
        assert got[int(b)]["n"] == int((ids == b).sum())
        assert math.isclose(got[int(b)]["mean_score"], s[ids == b].mean(), rel_tol=1e-12)
        assert math.isclose(got[int(b)]["observed_rate"], y[ids == b].mean(), rel_tol=1e-12)


def test_histogram_equals_numpy(spark):
    pairs = _random_pairs(6) + [(1, 0.99), (0, 0.99)]  # the maximum falls in the last bin
    y = np.array([a for a, _ in pairs]); s = np.array([b for _, b in pairs])
    edges = np.linspace(0, s.max(), 60)
    got = {r["bin"]: r for r in metrics.score_histogram(_preds(spark, pairs)).collect()}
    assert sorted(got) == list(range(59))
    for cls, col in ((0, "density_neg"), (1, "density_pos")):
        dens, _ = np.histogram(s[y == cls], bins=edges, density=True)
        for b, d in enumerate(dens):
            assert (got[b][col] if b in got else 0.0) == pytest.approx(d, rel=1e-12, abs=0)
    assert got[58]["n_pos"] >= 1


def test_histogram_leaves_out_negative_scores_and_survives_a_zero_maximum(spark):
    rows = metrics.score_histogram(_preds(spark, [(1, 0.9), (0, 0.1), (1, 0.5), (0, -0.2)])).collect()
    assert sorted(r["bin"] for r in rows) == list(range(59))
    assert sum(r["n_neg"] for r in rows) == 1 and sum(r["n_pos"] for r in rows) == 2
    width = 0.9 / 59
    assert sum(r["density_neg"] for r in rows) * width == pytest.approx(1) and sum(r["density_pos"] for r in rows) * width == pytest.approx(1)
    zero = metrics.score_histogram(_preds(spark, [(1, 0.0), (0, 0.0)])).collect()
    assert len(zero) == 59 and all(r["density_neg"] is None for r in zero) and [r["bin"] for r in zero if r["n_pos"]] == [58]
    assert metrics.score_histogram(_preds(spark, [(1, -1.0)])).count() == 0


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_rows_without_a_score_fail_or_are_counted(spark, bad):
    p = _preds(spark, [(1, 0.9), (0, 0.1), (1, bad), (0, bad)])
    with pytest.raises(Exception, match="NULL or NaN"):
        metrics.metric_record(p, "m").collect()
    r = metrics.metric_record(p, "m", on_missing="count").first()
    assert (r["valid_rows"], r["unscored_rows"], r["roc_auc"]) == (2, 2, 1.0)
    assert metrics.score_summary(p).first()["unscored_rows"] == 2


def test_everything_from_one_curve_equals_everything_from_predictions(spark):
    p = _preds(spark, _random_pairs(8))
    c = metrics.score_curve(p)
    for f in (metrics.ranking_metrics, metrics.roc_curve, metrics.score_histogram, metrics.calibration_table, metrics.confusion_at_ks):
        assert sorted(map(tuple, f(p).collect())) == sorted(map(tuple, f(c).collect()))
    assert metrics.exact_percentiles(p, "y_score", [0.1, 0.5]).collect() == metrics.exact_percentiles(c, "y_score", [0.1, 0.5]).collect()


def test_report_rounding_is_pythons(spark):
    from panelscore.functions.numeric import round_report
    rnd = random.Random(2)
    xs = [2.675, 1.005, 0.125, 0.375, -2.675, 2.5, 0.0, 1e-7, 0.135, 123456.785, 1e9 + 0.125] + [round(rnd.random() * 10 ** rnd.randint(0, 5), 3) for _ in range(2000)] \
        + [rnd.randint(0, 10 ** 6) / 2 ** rnd.randint(0, 9) for _ in range(500)] + [rnd.random() for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (0, 2, 5):
        got = [r[0] for r in df.select(round_report(F.col("x"), digits)).collect()]
        assert got == [float(round(x, digits)) for x in xs]


def test_null_keys_cannot_be_split(spark):
    with pytest.raises(Exception, match="NULL key"):
        split.hash_split(spark.createDataFrame([(None,), (1,)], "id long")).collect()


def test_hash_split_equals_python_and_ignores_partitioning(spark):
    keys = list(range(0, 3000, 7)) + [2 ** 40 + 3, 2 ** 62 - 1, -5]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    want = {k: unit_hash_reference(k, 42) for k in keys}
    for parts in (1, 3, 7):
        got = {r["id"]: r["u"] for r in split.hash_split(df.repartition(parts)).collect()}
        assert got == want
    valid = split.hash_split(df).where("is_valid").count()
    assert valid == sum(1 for v in want.values() if v < 0.2)


def test_class_weights_and_absent_class(spark):
    t = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0)], "id long, flag int")
    w = {r["flag"]: r["weight"] for r in split.class_weights(t).collect()}
    assert w == {0: 4 / 6, 1: 2.0}
    only0 = spark.createDataFrame([(1, 0), (2, 0)], "id long, flag int")
    rows = split.with_class_weights(only0).collect()
    assert all(r["w"] == 0.5 for r in rows)  # n / (2 * n_class)
    pos_w = split.with_class_weights(only0.union(spark.createDataFrame([(3, 1)], "id long, flag int")),
                                     counted_on=only0).where("flag = 1").collect()[0]["w"]
    assert pos_w is None


def test_binned_areas_equal_the_exact_ones_and_mllibs(spark, sf_dir):
    """With bins for every score the ROC area is exact and both equal MLlib's; with few bins they are near."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    from panelscore.sources import bindings as B
    preds = B.orders_predictions(spark, sf_dir)
    exact = metrics.ranking_metrics(preds).first()
    full, few = (metrics.binned_areas(preds, n).first() for n in (10**6, 50))
    raw = preds.select(F.col("y_true").cast("double").alias("label"), array_to_vector(F.array(-F.col("y_score"), F.col("y_score"))).alias("rawPrediction"))
    ev = BinaryClassificationEvaluator(numBins=0)
    assert abs(full["roc_auc"] - exact["roc_auc"]) < 1e-12 and abs(full["gini"] - exact["gini"]) < 1e-12
    assert abs(full["roc_auc"] - ev.evaluate(raw)) < 1e-9
    assert abs(full["pr_auc_trapezoid"] - ev.setMetricName("areaUnderPR").evaluate(raw)) < 1e-9
    assert few["points"] < 100 and abs(few["roc_auc"] - full["roc_auc"]) < 0.01
