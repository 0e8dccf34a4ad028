"""One-row reports in the reference's shapes (S10, F5): EDA summary, model metrics, submission check.

Each report is assembled from small aggregates through scalar subqueries, so no partial result passes
through the driver; ``io.write_report`` writes it as JSON and ``io.report_dict`` turns it into a dict.
Floats are rounded as Python's ``round`` does in the reference's reports.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_report
from ..operators import gates, metrics, profile


MAX_CODES = 10_000


def _one_row(spark: SparkSession, **fields) -> DataFrame:
    return spark.range(1).select(*[c.alias(name) for name, c in fields.items()])


def eda_report(history: DataFrame, target: DataFrame, feature_cols: list[str], code_cols: list[str],
               key: str = "id", label: str = "flag") -> DataFrame:
    """Class balance, default rate, history length summary, class means, code distributions, nulls.

    ``code_cols`` must be codes: a column's distinct values become one array of the report (more than ``MAX_CODES`` fail)."""
    spark = history.sparkSession
    bal = profile.class_balance(target, label)
    rate = profile.default_rate(target, label)
    lengths = profile.history_length(history.select(key), key)
    summ = profile.history_summary(lengths)
    means = profile.feature_means_by_class(history, target, feature_cols, key, label)
    nulls = profile.null_profile(history)
    dist = None
    for c in code_cols:
        d = profile.code_distribution(history, target, c, key, label)
        codes = F.array_sort(F.collect_list(F.struct("code", "neg_pct", "pos_pct")))
        few = F.when(F.count(F.lit(1)) > MAX_CODES, F.raise_error(F.lit(f"{c} has more than {MAX_CODES} codes"))).otherwise(codes)
        entry = d.select(few.alias("a")).select(
            F.struct(F.transform("a", lambda x: x["code"]).alias("codes"),
                     F.transform("a", lambda x: round_report(x["neg_pct"], 3)).alias("neg_pct"),
                     F.transform("a", lambda x: round_report(x["pos_pct"], 3)).alias("pos_pct")))
        pair = F.struct(F.lit(c).alias("k"), entry.scalar().alias("v"))
        dist = [pair] if dist is None else dist + [pair]
    return _one_row(
        spark,
        target_balance=bal.select(F.map_from_entries(F.collect_list(F.struct(F.col(label).cast("string"), "n"))))
        .scalar(),
        default_rate=round_report(F.coalesce(rate.select("default_rate").scalar(), F.lit(0.0)), 4),
        history_len=summ.select(F.struct("mn", "mx", round_report(F.col("avg"), 2).alias("avg"),
                                         "p50", "p90", "p99")).scalar(),
        feature_means_by_class=means.select(F.map_from_entries(F.collect_list(F.struct(
            "feature", F.struct(round_report(F.col("neg"), 4).alias("neg"),
                                round_report(F.col("pos"), 4).alias("pos")))))).scalar(),
        code_distribution=F.map_from_entries(F.array(*dist)) if dist else F.lit(None),
        rows_train_data=history.select(F.count(F.lit(1))).scalar(),
        columns=F.lit(len(history.columns)),
        nulls=nulls.select(F.map_from_entries(F.collect_list(F.struct("column_name", "null_count")))).scalar(),
    )


def eda_rows(report: DataFrame) -> DataFrame:
    """The profile report as (section, name, value) rows."""
    row = lambda section, name, value: F.struct(F.lit(section).alias("section"), name.cast("string").alias("name"), value.cast("double").alias("value"))
    entries = lambda section, m: F.transform(F.map_entries(m), lambda e: row(section, e["key"], e["value"]))
    single = [row("default_rate", F.lit(""), F.col("default_rate")), row("rows", F.lit(""), F.col("rows_train_data")), row("columns", F.lit(""), F.col("columns"))]
    single += [row("history_len", F.lit(k), F.col(f"history_len.{k}")) for k in ("mn", "mx", "avg", "p50", "p90", "p99")]

    def means(t: str) -> Column:
        return F.transform(F.map_entries("feature_means_by_class"), lambda e: row(f"mean_{t}", e["key"], e["value"][t]))

    def codes(t: str) -> Column:
        def of(e: Column) -> Column:
            return F.zip_with(e["value"]["codes"], e["value"][f"{t}_pct"], lambda c, p: F.struct(
                F.concat(e["key"], F.lit(f"_{t}")).alias("section"), c.cast("string").alias("name"), p.cast("double").alias("value")))
        return F.flatten(F.transform(F.map_entries("code_distribution"), of))

    return report.select(F.inline(F.concat(F.array(*single), entries("target_balance", F.col("target_balance")), entries("null", F.col("nulls")), *[f(t) for t in ("neg", "pos") for f in (means, codes)])))


def baseline_report(binned: dict, train: DataFrame, valid: DataFrame, model: str = "logistic_regression", label: str = "flag", digits: int = 5) -> DataFrame:
    """The baseline's report (M5): MLlib's binned areas, the validation rows, and the positives of both parts
    (``total_pos``) and of the train part (``train_pos``), which the reference does not tell apart (SURVEY D4)."""
    pos = F.sum(F.col(label).cast("long"))
    t, v = train.agg(pos.alias("train_pos")), valid.agg(F.count(F.lit(1)).alias("valid_rows"), pos.alias("valid_pos"))
    r = lambda k: round_report(F.lit(float(binned[k])), digits)
    return t.crossJoin(v).select(F.lit(model).alias("model"), r("roc_auc").alias("roc_auc"), r("gini").alias("gini"),
                                 r("pr_auc_trapezoid").alias("pr_auc_trapezoid"), "valid_rows", "train_pos",
                                 (F.coalesce("train_pos", F.lit(0)) + F.coalesce("valid_pos", F.lit(0))).alias("total_pos"))


def model_report(preds: DataFrame | metrics.Curve, model: str, rounds: int, digits: int = 5) -> DataFrame:
    """The short report of a further model: its areas and how many boosting rounds were kept."""
    r = lambda c: round_report(F.col(c), digits)
    return metrics.metric_record(preds, model).select("model", r("roc_auc").alias("roc_auc"), r("gini").alias("gini"),
                                                      r("average_precision").alias("pr_auc"), F.lit(rounds).alias("rounds"))


def metrics_report(preds: DataFrame | metrics.Curve, model: str, importance: DataFrame | None = None,
                   digits: int = 5, others: dict[str, DataFrame] | None = None, rounds: int | None = None) -> DataFrame:
    """The evaluation record (M14) rounded for the report, with the ten most important features, the boosting rounds
    kept, and a block for each of the ``others`` (one-row reports of further models, by block name)."""
    rec = metrics.metric_record(preds, model)
    r = lambda c: round_report(F.col(c), digits).alias(c)
    out = rec.select("model", r("roc_auc"), r("gini"), F.col("average_precision").alias("pr_auc"),
                     r("ks"), r("ks_threshold"), "valid_rows", "valid_pos", r("base_rate"), "unscored_rows")
    out = out.withColumn("pr_auc", round_report(F.col("pr_auc"), digits))
    if importance is not None:
        top = importance.orderBy(F.desc("importance"), "feature").limit(10)
        ranked = top.select(F.transform(F.array_sort(F.collect_list(
            F.struct((-F.col("importance")).alias("k"), F.col("feature").alias("f")))),
            lambda x: x["f"])).scalar()
        out = out.withColumn("top10_features", ranked)
    if rounds is not None:
        out = out.withColumn("rounds", F.lit(rounds))
    for name, rep in (others or {}).items():
        block = rep.select(F.struct(*[c for c in rep.columns if c.startswith(("roc_auc", "gini", "pr_auc"))]).alias(name))
        out = out.crossJoin(F.broadcast(block))  # one row each
    return out


def submission_report(sub: DataFrame, target: DataFrame, valid: DataFrame | None = None, curve: metrics.Curve | None = None) -> DataFrame:
    """The gate report (Q11) with the reference's rounding and the p50/p90/p99 of both score sets. ``curve``: that of
    ``valid``, if there is one already."""
    rep = gates.gate_report(sub, target, valid)
    probs = [0.5, 0.9, 0.99]
    test_pct = metrics.exact_percentiles(sub, "score", probs)
    valid_pct = metrics.exact_percentiles(valid if curve is None else curve, "y_score", probs) if valid is not None else None
    rep = gates.with_percentiles(rep, valid_pct, test_pct)
    rounded = {"unique_ratio": 4, "score_min": 5, "score_mean": 5, "score_max": 5, "valid_score_mean": 5,
               "mean_drift": 4}
    rep = rep.withColumns({c: round_report(F.col(c), d) for c, d in rounded.items()})
    return rep.withColumn("percentiles", F.struct(
        F.transform("percentiles.valid", lambda x: round_report(x, 5)).alias("valid"),
        F.transform("percentiles.test", lambda x: round_report(x, 5)).alias("test")))
