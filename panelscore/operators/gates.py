"""Quality gates on a scored submission.

Each check is a DataFrame; ``gate_report`` folds them into one row with ``errors`` and ``warnings``
arrays and ``passed``. Every count is an aggregate or an anti join on the key; nothing is collected
except the one-row report by ``assert_gates``.

NaN and NULL (H3): a CSV field that is empty reads as NULL in Spark and NaN in pandas, so the NaN gate
counts both; NaN is not "out of range" (numpy compares it False), and min/mean/max use the valid scores.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio

# The reference's gate thresholds and the expected submission columns.
DRIFT_TOLERANCE = 0.20
MIN_UNIQUE_RATIO = 0.50
SUBMISSION_COLUMNS = ("id", "score")


class GateError(Exception):
    """Raised by ``assert_gates`` when a report carries errors (Q12)."""


def format_ok(sub: DataFrame) -> bool:
    return tuple(sub.columns) == SUBMISSION_COLUMNS


def format_check(sub: DataFrame) -> DataFrame:
    """The columns, in order, must be exactly id, score; with the rows that were read under them."""
    return sub.agg(F.lit(",".join(sub.columns)).alias("columns"), F.lit(format_ok(sub)).alias("format_ok"), F.count(F.lit(1)).alias("rows"))


def _nan(s: Column) -> Column:
    return s.isNull() | F.isnan(s)


def row_counts(sub: DataFrame, target: DataFrame) -> DataFrame:
    """Q2: submission rows and target rows."""
    return sub.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", target.select(F.count(F.lit(1))).scalar().alias("expected_rows"))


def duplicate_count(sub: DataFrame, key: str = "id") -> DataFrame:
    """Rows minus first occurrences; all NULL keys count as one key, as in pandas; 0 for an empty submission."""
    return sub.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def missing_ids(sub: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Distinct target keys without a score. Both sides are de-duplicated first (map-side), so
    a key repeated a billion times reaches the join once per task."""
    left, right = target.select(F.col(key).alias("_t")).distinct(), sub.select(F.col(key).alias("_s")).distinct()
    return left.join(right, F.col("_t").eqNullSafe(F.col("_s")), "left_anti").select(F.col("_t").alias(key))


def extra_ids(sub: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Distinct submission keys that are not in the target; a missing (NULL) key is one of them, unless the target has it."""
    left, right = sub.select(F.col(key).alias("_s")).distinct(), target.select(F.col(key).alias("_t")).distinct()
    return left.join(right, F.col("_s").eqNullSafe(F.col("_t")), "left_anti").select(F.col("_s").alias(key))


def score_values(sub: DataFrame, score: str = "score") -> DataFrame:
    """Q6, Q7, P10, F8: NaN-or-NULL scores, and valid scores outside [0, 1]."""
    s = F.col(score)
    return sub.agg(F.count(F.when(_nan(s), 1)).alias("nan"),
                   F.count(F.when(~_nan(s) & ((s < 0) | (s > 1)), 1)).alias("out_of_range"))


def _score_groups(sub: DataFrame, score: str) -> DataFrame:
    """One row per distinct score with its rows; NaN and NULL together are the NULL group."""
    s = F.col(score)
    return sub.groupBy(F.when(~_nan(s), s).alias("_score")).agg(F.count(F.lit(1)).alias("_n"))


def unique_ratio(sub: DataFrame, score: str = "score") -> DataFrame:
    """Distinct scores / rows (NaN and NULL together are one value, as ``np.unique``); 0 if empty."""
    return _score_groups(sub, score).agg(F.coalesce(ratio(F.count(F.lit(1)), F.sum("_n")), F.lit(0.0)).alias("unique_ratio"))


def mean_drift(sub: DataFrame, valid: DataFrame, score: str = "score", valid_score: str = "y_score") -> DataFrame:
    """|mean(test) - mean(valid)| / mean(valid)."""
    t = sub.where(~_nan(F.col(score))).agg(F.avg(score).alias("score_mean"))
    v_mean = valid.where(~_nan(F.col(valid_score))).select(F.avg(valid_score)).scalar()
    return t.select("score_mean", v_mean.alias("valid_score_mean"),
                    ratio(F.abs(F.col("score_mean") - v_mean), v_mean).alias("mean_drift"))


def _key_counts(sub: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """One row: duplicates, missing_ids, extra_ids, expected_rows, from one full outer join of the distinct keys with their counts."""
    a = sub.groupBy(F.col(key).alias("_s")).agg(F.count(F.lit(1)).alias("_sn"))
    b = target.groupBy(F.col(key).alias("_t")).agg(F.count(F.lit(1)).alias("_tn"))
    both = a.join(b, F.col("_s").eqNullSafe(F.col("_t")), "full_outer")
    none = lambda c: F.count(F.when(F.col(c).isNull(), 1))
    return both.agg(F.coalesce(F.sum(F.col("_sn") - 1), F.lit(0)).alias("duplicates"), none("_sn").alias("missing_ids"),
                    none("_tn").alias("extra_ids"), F.coalesce(F.sum("_tn"), F.lit(0)).alias("expected_rows"))


def gate_report(sub: DataFrame, target: DataFrame, valid: DataFrame | None = None, key: str = "id",
                score: str = "score", valid_score: str = "y_score") -> DataFrame:
    """Q11: one row with every count, ``errors`` and ``warnings`` (codes) and ``passed``.

    Keys and scores are aggregated separately, each once, and the one-row results are put together. ``valid``
    (validation predictions) is optional (S16, Q10): without it the drift fields are NULL and a warning says so.
    Columns other than id, score are an error (Q1); the other checks still need a key and a score column."""
    s = F.col("_score")
    n = F.sum("_n")
    scores = _score_groups(sub, score).agg(
        F.coalesce(n, F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(s.isNull(), F.col("_n"))), F.lit(0)).alias("nan"),
        F.coalesce(F.sum(F.when((s < 0) | (s > 1), F.col("_n"))), F.lit(0)).alias("out_of_range"),
        F.coalesce(ratio(F.count(F.lit(1)), n), F.lit(0.0)).alias("unique_ratio"), F.min(s).alias("score_min"),
        ratio(F.sum(s * F.col("_n")), F.sum(F.when(s.isNotNull(), F.col("_n")))).alias("score_mean"), F.max(s).alias("score_max"))
    r = scores.crossJoin(_key_counts(sub, target, key))  # one row each
    if valid is not None:
        v = valid.where(~_nan(F.col(valid_score))).agg(F.avg(valid_score).alias("valid_score_mean"))
        r = r.crossJoin(v).withColumns({"mean_drift": ratio(F.abs(F.col("score_mean") - F.col("valid_score_mean")), F.col("valid_score_mean")),
                                        "_no_valid": F.lit(False)})
    else:
        r = r.withColumns({"valid_score_mean": F.lit(None).cast("double"), "mean_drift": F.lit(None).cast("double"), "_no_valid": F.lit(True)})
    code = lambda cond, name: F.when(cond, F.lit(name))
    errors = F.array_compact(F.array(
        code(F.lit(not format_ok(sub)), "columns"),
        code(F.col("rows") != F.col("expected_rows"), "row_count"),
        code(F.col("duplicates") > 0, "duplicate_ids"),
        code(F.col("missing_ids") > 0, "missing_ids"),
        code(F.col("extra_ids") > 0, "extra_ids"),
        code(F.col("nan") > 0, "nan_scores"),
        code(F.col("out_of_range") > 0, "scores_out_of_range"),
        code(F.col("unique_ratio") < MIN_UNIQUE_RATIO, "degenerate_scores")))
    warnings = F.array_compact(F.array(
        code(F.col("mean_drift") > DRIFT_TOLERANCE, "mean_drift"),
        code(F.col("_no_valid"), "no_validation_scores")))
    return (r.withColumns({"errors": errors, "warnings": warnings})
            .withColumn("passed", F.size("errors") == 0)
            .select("rows", "expected_rows", "duplicates", "missing_ids", "extra_ids", "nan", "out_of_range",
                    "unique_ratio", "score_min", "score_mean", "score_max", "valid_score_mean", "mean_drift",
                    "errors", "warnings", "passed"))


def with_percentiles(report: DataFrame, valid_pct: DataFrame | None, test_pct: DataFrame) -> DataFrame:
    """Adds the p50/p90/p99 arrays of the validation and test scores (A27) to a report row."""
    arr = lambda d: d.select(F.transform(F.array_sort(F.collect_list(F.struct("p", "value"))),
                                         lambda x: x["value"])).scalar()
    valid_col = arr(valid_pct) if valid_pct is not None else F.lit(None).cast("array<double>")
    return report.withColumn("percentiles", F.struct(valid_col.alias("valid"), arr(test_pct).alias("test")))


def assert_gates(report: DataFrame) -> dict:
    """Q12: collect the one-row report and raise ``GateError`` if it has errors; return it otherwise."""
    row = report.limit(2).collect()
    if len(row) != 1:
        raise ValueError("a gate report has exactly one row")
    rep = row[0].asDict(recursive=True)
    if rep["errors"]:
        raise GateError(f"submission failed: {', '.join(rep['errors'])}")
    return rep
