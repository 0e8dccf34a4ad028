"""Model operators: scores in [0, 1], save/load is exact, learning beats chance."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelscore.operators import boosting, fold, metrics, models, split
from panelscore.sources import bindings as B


@pytest.fixture(scope="module")
def mart(spark, sf_dir):
    m = fold.fold_history(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC)
    # a label that depends on a feature, so a working model must rank better than chance
    labelled = m.withColumn("flag", (F.col("qty_mean") > 25).cast("int"))
    path = os.path.join(tempfile.mkdtemp(prefix="models-"), "mart")
    split.hash_split(labelled).drop("u").write.parquet(path)
    return spark.read.parquet(path)


def _features(df):
    return models.model_features(df, exclude=("is_valid", "qty_mean"))


def test_baseline_learns_and_scores_are_probabilities(spark, mart):
    train = split.with_class_weights(mart.where(~F.col("is_valid")))
    model = models.baseline_pipeline(_features(mart), maxIter=20).fit(train)
    preds = models.score(model, mart.where(F.col("is_valid")))
    lo, hi = preds.agg(F.min("y_score"), F.max("y_score")).first()
    assert 0.0 <= lo <= hi <= 1.0
    assert metrics.ranking_metrics(preds).first()["roc_auc"] > 0.8


def test_workflow_writes_every_report_and_passes_its_gates(spark, sf_dir, tmp_path):
    import json
    from panelscore.plans.workflow import run_on_test_tables
    # the primary model's leaves hold 300 rows at least: smaller tables give too few distinct scores for the gate
    out = run_on_test_tables(spark, sf_dir.replace("sf0.001", "sf0.01"), str(tmp_path), rounds=20)
    assert out["submission_check"]["passed"] and out["rounds"]["gbt_primary"] > 1 and out["metrics"]["rounds"] == out["rounds"]["gbt_primary"]
    read = lambda name: [json.loads(x) for x in spark.read.text(f"{tmp_path}/reports/{name}").toPandas()["value"]]
    for name in ("eda_summary", "baseline_metrics", "comparison_metrics", "metrics", "submission_check"):
        assert len(read(name)) == 1, name
    assert {"baseline", "comparison", "top10_features"} <= set(read("metrics")[0])
    base = read("baseline_metrics")[0]
    assert 0 < base["train_pos"] < base["total_pos"]
    for name in ("roc", "pr", "ks", "histogram", "calibration", "confusion", "importance", "model_comparison", "split"):
        assert spark.read.parquet(f"{tmp_path}/reports/{name}").count() > 0, name
    assert spark.read.parquet(f"{tmp_path}/reports/histogram").count() == 59
    models.load_model(f"{tmp_path}/models/logistic_regression")
    for name in ("gbt_primary", "gbt_comparison"):
        assert boosting.load(spark, f"{tmp_path}/models/{name}").rounds == out["rounds"][name]
    learned = spark.read.parquet(f"{tmp_path}/features/train").select("id")
    scored = spark.read.parquet(f"{tmp_path}/features/test").select("id")
    assert learned.intersect(scored).count() == 0 and scored.count() == out["submission_check"]["rows"]


def test_save_load_scores_identically(spark, mart):
    model = models.baseline_pipeline(_features(mart), weight=None, maxIter=5).fit(mart)
    path = os.path.join(tempfile.mkdtemp(prefix="model-"), "m")
    models.save_model(model, path)
    a = models.score(model, mart, out="a")
    b = models.score(models.load_model(path), mart, label=None, out="b")
    assert a.join(b, "id").where(F.col("a") != F.col("b")).count() == 0


def test_comparison_skips_absent_models(spark, mart):
    rec = spark.createDataFrame([("m", 0.5)], "model string, roc_auc double")
    out = models.comparison([("baseline", None), ("m", rec)]).collect()
    assert [r["model"] for r in out] == ["m"]


def test_gradient_is_zero_at_the_optimum_only(spark, mart):
    train = split.with_class_weights(mart.where(~F.col("is_valid")))
    cols = _features(mart)
    fitted = models.baseline_gradient(models.baseline_pipeline(cols, maxIter=200, tol=1e-10).fit(train), train, cols)
    assert fitted.count() == len(cols) + 1 and fitted.where(~F.col("at_optimum")).count() == 0
    early = models.baseline_gradient(models.baseline_pipeline(cols, maxIter=1).fit(train), train, cols)
    assert early.where(~F.col("at_optimum")).count() > 0


def test_random_split_does_not_depend_on_partitions(spark, mart):
    parts = [sorted(r["id"] for r in split.random_split(mart.repartition(n))[1].select("id").collect()) for n in (3, 7)]
    train, valid = split.random_split(mart)
    assert parts[0] == parts[1] and 0.15 < len(parts[0]) / mart.count() < 0.25
    assert train.count() + valid.count() == mart.count() and train.columns == mart.columns
    assert parts[0] != sorted(r["id"] for r in mart.where("is_valid").select("id").collect())
    assert parts[0] != sorted(r["id"] for r in split.random_split(mart, seed=7)[1].select("id").collect())
