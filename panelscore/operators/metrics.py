"""Ranking metrics, curves and score distributions on (id, y_true, y_score) (W3-W5, A19, A21, A22,
A25, A27, A28, M11-M14, O3, O5, P9, F6, F9).

Everything rests on one distributed table, ``Curve``: the distinct scores in descending order with their
positive and negative counts and the running totals ``tps``/``fps`` (``ordered.running_totals``), checkpointed once. Every
metric, curve, histogram and percentile takes either predictions or a ``Curve`` already built from them, so
an evaluation sorts each prediction table once. A score value held by a third of all rows is one row after the
first, map-side combined aggregate. Integer parts of the formulas stay integers (decimal(38,0) where a
product of two counts could pass 2^63), so ties compare exactly and each metric ends with a single division.

A NULL or NaN score cannot be ranked: a curve fails on predictions that hold one (``on_missing="raise"``), or leaves those
rows out and reports their number (``on_missing="count"``; the metric record has it as ``unscored_rows``).
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import checkpoint_dir
from .ordered import running_totals

DEC = "decimal(38,0)"


@dataclass(frozen=True)
class Curve:
    """Distinct scores with their counts, and one row of totals.

    points: (score, pos, neg, tps, fps; tps and fps count rows at or above the score); totals: (p, n, unscored, top)."""
    points: DataFrame
    totals: DataFrame
    score: str

    @property
    def pos(self) -> Column:
        return self.totals.select("p").scalar()

    @property
    def neg(self) -> Column:
        return self.totals.select("n").scalar()

    def with_totals(self, df: DataFrame) -> DataFrame:
        """``df`` with the one row of totals beside each row."""
        return df.crossJoin(F.broadcast(self.totals))


def score_curve(preds: DataFrame | Curve, label: str = "y_true", score: str = "y_score", on_missing: str = "raise") -> Curve:
    """The curve table of a prediction table (a ``Curve`` is returned as it is). It has two checkpoints: the per-score
    groups in their ranges, and the finished points that every metric reads."""
    if isinstance(preds, Curve):
        return preds
    if on_missing not in ("raise", "count"):
        raise ValueError(f"unknown on_missing {on_missing!r}")
    checkpoint_dir(preds.sparkSession)
    s = F.col(score)
    missing = s.isNull() | F.isnan(s)
    groups = (preds.groupBy(F.when(~missing, s).alias(score))
              .agg(F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("pos"),
                   (F.count(F.lit(1)) - F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0))).alias("neg")))
    if on_missing == "raise":
        groups = groups.withColumn(score, F.when(s.isNull(), F.raise_error(F.lit("predictions hold NULL or NaN scores"))).otherwise(s))
    # rows without a score, if they are counted, sort last and take no part in the running totals
    cum = running_totals(groups.withColumns({"_p": F.when(s.isNotNull(), F.col("pos")).otherwise(0), "_n": F.when(s.isNotNull(), F.col("neg")).otherwise(0)}),
                         score, ["_p", "_n"], descending=True, prefix="c")
    points = cum.select(score, "pos", "neg", F.col("c_p").alias("tps"), F.col("c_n").alias("fps")).checkpoint()
    scored = s.isNotNull()
    total = lambda c: F.coalesce(F.sum(F.when(scored, F.col(c))), F.lit(0))
    totals = points.agg(total("pos").alias("p"), total("neg").alias("n"),
                        F.coalesce(F.sum(F.when(~scored, F.col("pos") + F.col("neg"))), F.lit(0)).alias("unscored"), F.max(s).alias("top"))
    return Curve(points.where(scored), totals, score)


def roc_curve(preds: DataFrame | Curve, label: str = "y_true", score: str = "y_score") -> DataFrame:
    """One point per distinct score (W4); sklearn also drops collinear points and adds a start point."""
    c = score_curve(preds, label, score)
    return c.with_totals(c.points).select(F.col(c.score).alias("threshold"), "tps", "fps",
                                          ratio(F.col("tps"), F.col("p")).alias("tpr"), ratio(F.col("fps"), F.col("n")).alias("fpr"))


def pr_curve(preds: DataFrame | Curve, label: str = "y_true", score: str = "y_score") -> DataFrame:
    """Precision and recall at each distinct score."""
    c = score_curve(preds, label, score)
    return c.with_totals(c.points).select(F.col(c.score).alias("threshold"),
                                          ratio(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"),
                                          ratio(F.col("tps"), F.col("p")).alias("recall"))


def ks_curve(preds: DataFrame | Curve, label: str = "y_true", score: str = "y_score") -> DataFrame:
    """Class CDFs at each distinct score, ascending (W3): share of each class at or below the score."""
    c = score_curve(preds, label, score)
    return c.with_totals(c.points).select(c.score, ratio(F.col("p") - F.col("tps") + F.col("pos"), F.col("p")).alias("cdf_pos"),
                                          ratio(F.col("n") - F.col("fps") + F.col("neg"), F.col("n")).alias("cdf_neg"))


def ranking_metrics(preds: DataFrame | Curve, label: str = "y_true", score: str = "y_score") -> DataFrame:
    """One row: roc_auc (ties count one half, M11), gini (F9), average_precision (step sum, M12), ks and
    ks_threshold (first maximum of TPR-FPR in descending score order, M13/O5). NULL with one class."""
    c = score_curve(preds, label, score)
    p, n = F.col("p").cast(DEC), F.col("n").cast(DEC)
    tps, fps = F.col("tps").cast(DEC), F.col("fps").cast(DEC)
    gp, gn = F.col("pos").cast(DEC), F.col("neg").cast(DEC)
    ks_num = tps * n - fps * p  # (TPR - FPR) * P * N, exact
    m = c.with_totals(c.points).agg(
        F.sum(gp * (n - fps) * 2 + gp * gn).alias("_auc"),
        F.sum(ratio(F.col("pos"), F.col("p")) * ratio(F.col("tps"), F.col("tps") + F.col("fps"))).alias("average_precision"),
        F.max(ks_num).alias("_ks_num"), F.max_by(F.col(c.score), F.struct(ks_num, F.col(c.score))).alias("_ks_at"))
    m = c.with_totals(m)
    pn = F.col("p").cast("double") * F.col("n").cast("double")
    # the ROC curve starts at (FPR, TPR) = (0, 0) with threshold +inf: it is the first maximum when no
    # threshold has TPR > FPR
    top = F.greatest(F.col("_ks_num"), F.lit(0).cast(DEC))
    thr = F.when(F.col("_ks_num") > 0, F.col("_ks_at")).otherwise(F.lit(float("inf")))
    auc = ratio(F.col("_auc"), pn * 2)
    return m.select(auc.alias("roc_auc"), (auc * 2 - 1).alias("gini"), "average_precision",
                    ratio(top, pn).alias("ks"), F.when(pn > 0, thr).alias("ks_threshold"))


def score_summary(preds: DataFrame, label: str = "y_true", score: str = "y_score") -> DataFrame:
    """Rows, positives, base rate (A19) and min/mean/max (A25, H3) of the scored rows, and the number of rows without a score."""
    s = F.col(score)
    ok = s.isNotNull() & ~F.isnan(s)
    y = F.col(label)
    return preds.agg(F.count(F.when(ok, 1)).alias("rows"), F.sum(F.when(ok, y.cast("long"))).alias("positives"),
                     F.avg(F.when(ok, y)).alias("base_rate"), F.min(F.when(ok, s)).alias("score_min"),
                     F.avg(F.when(ok, s)).alias("score_mean"), F.max(F.when(ok, s)).alias("score_max"),
                     F.count(F.when(~ok, 1)).alias("unscored_rows"))


def metric_record(preds: DataFrame | Curve, model: str, label: str = "y_true", score: str = "y_score", on_missing: str = "raise") -> DataFrame:
    """The evaluation record of one model (M14), with the rows that have no score counted beside the valid ones."""
    c = score_curve(preds, label, score, on_missing)
    return c.with_totals(ranking_metrics(c)).select(
        F.lit(model).alias("model"), "roc_auc", "gini", "average_precision", "ks", "ks_threshold",
        (F.col("p") + F.col("n")).alias("valid_rows"), F.col("p").alias("valid_pos"), ratio(F.col("p"), F.col("p") + F.col("n")).alias("base_rate"),
        F.col("unscored").alias("unscored_rows"))


def binned_areas(preds: DataFrame | Curve, bins: int = 1000, label: str = "y_true", score: str = "y_score") -> DataFrame:
    """M5, one row: areas under the ROC and the precision-recall curve through at most about ``bins`` points, by trapezoids (the second
    is not sklearn's average precision, SURVEY D2).

    Distinct scores are ranked in ranges (``running_totals``) and every g-th one is kept, g = distinct scores / ``bins``; with fewer scores than
    twice ``bins`` all are. Only the kept points, under twice ``bins`` and so bounded, meet in one window. The ROC curve starts at (0, 0), the
    other at recall 0 with the first point's precision."""
    c = score_curve(preds, label, score)
    ranked = running_totals(c.points.select(c.score, "tps", "fps", F.lit(1).alias("one")), c.score, ["one"])
    n = c.points.select(F.count(F.lit(1))).scalar()
    group = F.greatest(F.lit(1), F.floor(n / F.lit(bins)))
    kept = ranked.where((F.col("cum_one") % group == 0) | (F.col("cum_one") == n))
    w = Window.orderBy("cum_one")
    points = c.with_totals(kept).select("cum_one", ratio(F.col("fps"), F.col("n")).alias("x"), ratio(F.col("tps"), F.col("p")).alias("y"),
                                        ratio(F.col("tps"), F.col("tps") + F.col("fps")).alias("q"))
    before = lambda col, first: F.coalesce(F.lag(col).over(w), first)
    steps = points.select(((F.col("x") - before("x", F.lit(0.0))) * (F.col("y") + before("y", F.lit(0.0))) / 2).alias("roc"),
                          ((F.col("y") - before("y", F.lit(0.0))) * (F.col("q") + before("q", F.col("q"))) / 2).alias("pr"))
    areas = steps.agg(F.sum("roc").alias("roc_auc"), F.sum("pr").alias("pr_auc_trapezoid"), F.count(F.lit(1)).alias("points"))
    return areas.select("roc_auc", (F.col("roc_auc") * 2 - 1).alias("gini"), "pr_auc_trapezoid", "points")


def confusion_at(preds: DataFrame | Curve, threshold: Column, label: str = "y_true",
                 score: str = "y_score") -> DataFrame:
    """Counts of (y_true, y_pred) with y_pred = score >= threshold; all four cells present."""
    c = score_curve(preds, label, score)
    above = F.col(c.score) >= threshold
    cells = [(t, q) for t in (0, 1) for q in (0, 1)]
    one = c.points.agg(*[F.coalesce(F.sum(F.when(above if q else ~above, F.col("pos" if t else "neg"))), F.lit(0)).alias(f"c{t}{q}")
                         for t, q in cells])
    pairs = ", ".join(f"{t}, {q}, c{t}{q}" for t, q in cells)
    return one.selectExpr(f"stack(4, {pairs}) AS (y_true, y_pred, n)")


def confusion_at_ks(preds: DataFrame | Curve, label: str = "y_true", score: str = "y_score") -> DataFrame:
    c = score_curve(preds, label, score)
    return confusion_at(c, ranking_metrics(c).select("ks_threshold").scalar())


def score_histogram(preds: DataFrame | Curve, bins: int = 59, label: str = "y_true",
                    score: str = "y_score") -> DataFrame:
    """Per-class density over ``bins`` equal bins on [0, max score] (A22), like ``np.histogram(density=True)``: always
    ``bins`` rows, empty bins with 0; scores below 0 are in no bin and not in the density's total. A value on an
    edge goes right, the last bin is closed. If the maximum is 0, all bins have width 0, zeros are in the last one
    and the densities are NULL (numpy: NaN), as for a class without a score in the range; without a score >= 0 there are no rows."""
    c = score_curve(preds, label, score)
    # the edges: one small row, i * (top / bins) with the last one being top itself
    top = F.col("top").cast("double")
    edges = c.totals.where(F.col("top") >= 0).select(
        top.alias("_top"), F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.when(i == bins, top).otherwise(i.cast("double") * (top / F.lit(float(bins))))).alias("_edges"))
    s = F.col(c.score).cast("double")
    guess = F.when(F.col("_top") == 0, bins - 1).otherwise(F.least(F.floor(s * F.try_divide(F.lit(float(bins)), F.col("_top"))).cast("int"), F.lit(bins - 1)))
    # rounding can put the guess one bin off: compare with the edges themselves
    lower = F.when(s < F.get("_edges", guess), guess - 1).otherwise(guess)
    bin_ = F.when((lower < bins - 1) & (s >= F.get("_edges", lower + 1)), lower + 1).otherwise(lower)
    counts = (c.points.where(s >= 0).crossJoin(F.broadcast(edges))
              .groupBy(bin_.alias("bin")).agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")))
    inside = c.points.where(s >= 0).agg(F.sum("neg").alias("_neg"), F.sum("pos").alias("_pos"))
    every = edges.crossJoin(inside).select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = F.get("_edges", F.col("bin") + 1) - F.get("_edges", F.col("bin"))
    n_neg, n_pos = F.coalesce("neg", F.lit(0)), F.coalesce("pos", F.lit(0))
    # numpy: n / db / n.sum()
    return every.join(counts, "bin", "left").select(
        "bin", n_neg.alias("n_neg"), n_pos.alias("n_pos"), ratio(ratio(n_neg, width), F.col("_neg")).alias("density_neg"),
        ratio(ratio(n_pos, width), F.col("_pos")).alias("density_pos"))


def exact_percentiles(df: DataFrame | Curve, col: str, probs: list[float]) -> DataFrame:
    """(p, value): numpy's default ('linear') percentile of ``col``, exact and distributed.

    Distinct values with their counts get running totals; each wanted order statistic is found by a
    range condition against a broadcast table of at most 2 * len(probs) ranks; then numpy's index and
    interpolation formulas are applied as they are. A ``Curve`` already has the running totals."""
    if isinstance(df, Curve):
        at, below = df.points, F.col("p") + F.col("n") - F.col("tps") - F.col("fps")  # rows under this score
        cum = df.with_totals(at).select(F.col(df.score).cast("double").alias("x"), (F.col("pos") + F.col("neg")).alias("k"), below.alias("before"))
        n = df.totals.select(F.col("p") + F.col("n")).scalar()
    else:
        v = df.where(F.col(col).isNotNull() & ~F.isnan(col)).select(F.col(col).cast("double").alias("x"))
        counts = v.groupBy("x").agg(F.count(F.lit(1)).alias("k"))
        cum = running_totals(counts, "x", ["k"], descending=False, prefix="c_").checkpoint()
        n = cum.select(F.coalesce(F.sum("k"), F.lit(0))).scalar()
        cum = cum.select("x", "k", (F.col("c_k") - F.col("k")).alias("before"))
    spark = df.points.sparkSession if isinstance(df, Curve) else df.sparkSession
    q = spark.createDataFrame([(float(p),) for p in probs], "p double")
    # numpy 'linear': virtual index = (n - 1) * q; previous = floor; gamma = index - previous
    q = q.select(F.col("p").alias("prob"), n.alias("_n"))
    q = q.select("prob", "_n", ((F.col("_n") - 1).cast("double") * F.col("prob")).alias("vidx"))
    q = q.select("prob", "_n", "vidx", F.greatest(F.least(F.floor("vidx"), F.col("_n") - 1), F.lit(0)).cast("long").alias("lo"))
    q = q.select("prob", (F.col("vidx") - F.floor("vidx")).alias("gamma"), "lo", F.least(F.col("lo") + 1, F.col("_n") - 1).alias("hi"))
    ranks = q.select("prob", "gamma", F.explode(F.array(F.struct(F.lit(True).alias("lower"), F.col("lo").alias("r")),
                                                        F.struct(F.lit(False).alias("lower"), F.col("hi").alias("r")))).alias("_o")).select("prob", "gamma", "_o.*")
    hit = cum.join(F.broadcast(ranks), (F.col("r") >= F.col("before")) & (F.col("r") < F.col("before") + F.col("k")))
    stats = hit.groupBy("prob", "gamma").agg(F.max(F.when(F.col("lower"), F.col("x"))).alias("a"),
                                             F.max(F.when(~F.col("lower"), F.col("x"))).alias("b"))
    a, b, g = F.col("a"), F.col("b"), F.col("gamma")
    diff = b - a
    lerp = F.when(g >= 0.5, b - diff * (F.lit(1.0) - g)).otherwise(a + diff * g)
    return stats.select(F.col("prob").alias("p"), F.when(a == b, a).otherwise(lerp).alias("value"))


def calibration_table(preds: DataFrame | Curve, bins: int = 15, label: str = "y_true",
                      score: str = "y_score") -> DataFrame:
    """Quantile calibration (A28), as sklearn's ``calibration_curve(strategy='quantile')``: edges are the
    exact percentiles at linspace(0, 1, bins + 1); a score's bin is the number of inner edges below it;
    empty bins are dropped. Columns: bin, n, mean_score, observed_rate. The edges are one row, joined once."""
    c = score_curve(preds, label, score)
    probs = [float(x) for x in (np.linspace(0, 1, bins + 1) * 100) / 100]
    edges = exact_percentiles(c, c.score, probs[1:-1]).agg(F.array_sort(F.collect_list("value")).alias("_edges"))
    s = F.col(c.score).cast("double")
    binned = c.points.crossJoin(F.broadcast(edges)).select(F.size(F.filter("_edges", lambda e: e < s)).cast("long").alias("bin"), s.alias("s"), "pos", "neg")
    rows = F.sum(F.col("pos") + F.col("neg"))
    return binned.groupBy("bin").agg(rows.alias("n"), ratio(F.sum(F.col("s") * (F.col("pos") + F.col("neg"))), rows).alias("mean_score"),
                                     ratio(F.sum("pos"), rows).alias("observed_rate"))
