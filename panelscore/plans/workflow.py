"""The reference's stages end to end, as Spark jobs.

ingest -> profile -> client mart -> hash split and weights -> models -> evaluate -> score -> validate.
Stages hand over written tables under ``out_dir`` (as the reference hands over files): raw tables, marts, models, one
prediction table and one curve table per model. Reports are one-row DataFrames, computed once and written as JSON. Plain function calls: Spark
orders the work inside each stage; the stage order is this function's body.

    python -m panelscore.plans.workflow /root/testdata/sf0.01 /path/to/out
"""
from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting, fold, gates, metrics, models, split
from ..session import checkpoint_dir
from ..sources import bindings as B
from ..sources import io
from . import reports


def run_workflow(spark: SparkSession, history: DataFrame, target: DataFrame, test_history: DataFrame,
                 out_dir: str, spec: fold.FoldSpec, code_cols: list[str], test_ids: DataFrame | None = None, rounds: int | None = None,
                 n_parts: int | None = None, enforce_gates: bool = True) -> dict:
    """``history`` (key, seq, features) and ``target`` (key, flag) to learn from; ``test_history`` of the clients to be
    scored, ``test_ids`` (key; default: the clients of ``test_history``) those a score is due for. ``rounds`` limits the boosted models below their parameter
    sets' own limits. Returns the stage timings, the rounds kept and the one-row reports as dicts."""
    timings: dict[str, float] = {}
    out = out_dir.rstrip("/")
    checkpoint_dir(spark)

    def stage(name, fn):
        t0 = time.perf_counter()
        r = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return r

    # ingest: the canonical layer
    def ingest():
        hist, _ = io.materialize(spark, history, f"{out}/raw/history", n_parts)
        new, _ = io.materialize(spark, test_history, f"{out}/raw/test_history", n_parts)
        tgt, _ = io.materialize(spark, target, f"{out}/raw/target", n_parts)
        due, _ = io.materialize(spark, new.select(spec.key).distinct() if test_ids is None else test_ids, f"{out}/raw/test_target", n_parts)
        return hist, new, tgt, due
    hist, new, tgt, due = stage("ingest", ingest)
    feats = spec.feature_list(hist)

    # profile (A1-A12)
    eda = stage("profile", lambda: io.write_report(reports.eda_report(hist, tgt, feats, code_cols, spec.key), f"{out}/reports/eda_summary"))

    # client marts, each computed once (A17, J1, S7); the hash split and its report
    def build_marts():
        labelled = split.hash_split(fold.fold_history(hist, spec).join(tgt, spec.key, "inner"), spec.key).drop("u")
        train, _ = io.materialize(spark, labelled, f"{out}/features/train", n_parts)
        test, _ = io.materialize(spark, fold.fold_history(new, spec).join(due, spec.key, "left_semi"), f"{out}/features/test", n_parts)
        split.split_report(train).write.mode("overwrite").parquet(f"{out}/reports/split")
        return train, test
    marts, test = stage("features", build_marts)
    cols = models.model_features(marts, key=spec.key, exclude=("is_valid",))
    train, valid = marts.where(~F.col("is_valid")), marts.where(F.col("is_valid"))

    # models (M3, M6-M8) on the same hash split
    def fit_all():
        base = models.baseline_pipeline(cols).fit(split.with_class_weights(train, counted_on=marts))
        primary = boosting.fit(cols, train, valid, key=spec.key, settings=boosting.PRIMARY, rounds=rounds)
        second = boosting.fit(cols, train, valid, key=spec.key, settings=boosting.COMPARISON, rounds=rounds)
        models.save_model(base, f"{out}/models/logistic_regression")
        for name, m in (("gbt_primary", primary), ("gbt_comparison", second)):
            boosting.save(spark, m, f"{out}/models/{name}")
        return base, primary, second
    base, primary, second = stage("train", fit_all)
    kept = {"gbt_primary": primary.rounds, "gbt_comparison": second.rounds}

    # evaluate (M11-M14, W3-W5, A21, A22, A28, M5, M10, U3): one curve table per model
    def evaluate():
        preds, curves = {}, {}
        scored = (("logistic_regression", models.score(base, valid, key=spec.key)), ("gbt_comparison", boosting.score(second, valid, key=spec.key)),
                  ("gbt_primary", boosting.score(primary, valid, key=spec.key)))
        for name, df in scored:
            path = f"{out}/predictions/{name}"
            io.write_predictions(df, path, spec.key)
            preds[name] = spark.read.parquet(path)
            curves[name] = metrics.score_curve(preds[name])
        main = curves["gbt_primary"]
        importance = boosting.feature_importance(spark, primary, top=30).drop("gain", "splits")
        binned = reports.baseline_report(models.binned_metrics(base, valid), train, valid)
        compared = reports.model_report(curves["gbt_comparison"], "gbt_comparison", second.rounds)
        io.write_report(binned, f"{out}/reports/baseline_metrics")
        io.write_report(compared, f"{out}/reports/comparison_metrics")
        blocks = {"baseline": binned, "comparison": compared}
        rep = io.write_report(reports.metrics_report(main, "gbt_primary", importance, others=blocks, rounds=primary.rounds), f"{out}/reports/metrics")
        for name, df in (("roc", metrics.roc_curve(main)), ("pr", metrics.pr_curve(main)),
                         ("ks", metrics.ks_curve(main)), ("histogram", metrics.score_histogram(main)),
                         ("calibration", metrics.calibration_table(main)),
                         ("confusion", metrics.confusion_at_ks(main)), ("importance", importance)):
            df.write.mode("overwrite").parquet(f"{out}/reports/{name}")
        comparison = models.comparison([(n, metrics.metric_record(c, n)) for n, c in curves.items()])
        comparison.write.mode("overwrite").parquet(f"{out}/reports/model_comparison")
        return rep, preds["gbt_primary"], main
    metrics_rep, main_preds, main_curve = stage("evaluate", evaluate)

    # score the test clients
    def score_test():
        sub = boosting.score(boosting.load(spark, f"{out}/models/gbt_primary"), test, key=spec.key, label=None, out="score")
        io.write_submission_csv(sub, f"{out}/submission", spec.key)
        return io.read_submission_csv(spark, f"{out}/submission")
    submission = stage("predict", score_test)

    # validate (Q1-Q12)
    check = stage("validate", lambda: io.write_report(reports.submission_report(submission, due, main_preds, main_curve), f"{out}/reports/submission_check"))
    if enforce_gates and check["errors"]:
        raise gates.GateError(f"submission failed: {', '.join(check['errors'])}")
    return {"timings": timings, "rounds": kept, "eda": eda, "metrics": metrics_rep, "submission_check": check}


def run_on_test_tables(spark: SparkSession, sf_dir: str, out_dir: str, rounds: int | None = None, **kw) -> dict:
    """The workflow on the lineitem/orders binding: learn on the orders placed before ``B.SCORING_FROM``, score the later ones."""
    history = B.lineitem_history(spark, sf_dir)
    old, new = B.clients_by_date(spark, sf_dir)
    return run_workflow(spark, history.join(old, "id", "left_semi"), B.value_target(spark, sf_dir).join(old, "id", "left_semi"),
                        history.join(new, "id", "left_semi"), out_dir, B.LINEITEM_SPEC, ["rflag", "disc"], rounds=rounds, **kw)


if __name__ == "__main__":
    import json

    from ..session import get_spark
    s = get_spark("panelscore-workflow")
    s.sparkContext.setLogLevel("ERROR")
    print(json.dumps(run_on_test_tables(s, sys.argv[1], sys.argv[2]), default=str, indent=2))
