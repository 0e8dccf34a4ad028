"""Profiling of a history and its target.

Every block is one aggregate job that returns a DataFrame; only the report writer collects, and what it
collects is bounded by the number of classes, codes or columns. Joins of the history with the target are
taken after a per-key pre-aggregate, so a key with a third of all rows reaches the join as one row.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio


def class_balance(target: DataFrame, label: str = "flag") -> DataFrame:
    """Rows per class and their share of all rows in percent (A1, A2), ordered by class."""
    counts = target.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = target.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (F.col("n") * F.lit(100.0) / total).alias("share_pct")).orderBy(label)


def default_rate(target: DataFrame, label: str = "flag") -> DataFrame:
    """Share of positives (A3); 0 when class 1 is absent, NULL on an empty target."""
    return target.agg(F.count(F.lit(1)).alias("rows"),
                      F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positives"),
                      ratio(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)), F.count(F.lit(1)))
                      .alias("default_rate"))


def history_length(history: DataFrame, key: str = "id", out: str = "rn_cnt") -> DataFrame:
    """Rows per key (A4)."""
    return history.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def history_summary(lengths: DataFrame, col: str = "rn_cnt", accuracy: int = 10000) -> DataFrame:
    """min, max, mean and approximate p50/p90/p99 of the history length (A5)."""
    c = F.col(col)
    return lengths.agg(F.min(c).alias("mn"), F.max(c).alias("mx"), F.avg(c).alias("avg"),
                       *[F.percentile_approx(c, p, accuracy).alias(f"p{int(p * 100)}")
                         for p in (0.5, 0.9, 0.99)])


def capped_histogram(lengths: DataFrame, col: str = "rn_cnt", cap: int = 40) -> DataFrame:
    """Keys per history length, lengths above ``cap`` pooled into ``cap``."""
    return (lengths.groupBy(F.least(F.col(col), F.lit(cap)).alias("b"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("b"))


def rate_by_length(lengths: DataFrame, target: DataFrame, key: str = "id", col: str = "rn_cnt",
                   label: str = "flag", cap: int = 20) -> DataFrame:
    """Default rate and key count per capped history length."""
    joined = lengths.join(target, key, "inner")
    return (joined.groupBy(F.least(F.col(col), F.lit(cap)).alias("b"))
            .agg(F.avg(label).alias("dr"), F.count(F.lit(1)).alias("n")).orderBy("b"))


def feature_means_by_class(history: DataFrame, target: DataFrame, features: list[str],
                           key: str = "id", label: str = "flag") -> DataFrame:
    """Record-level mean of each feature per class (A8), long form (feature, neg, pos).

    Sums and counts are taken per key first, so the join with the target is one row per key on both
    sides; the class means are ratios of the summed sums and counts, equal to AVG over the joined rows.
    """
    per_key = history.groupBy(key).agg(
        *[x for c in features for x in (F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}"))])
    joined = per_key.join(target, key, "inner")
    aggs = []
    for c in features:
        for cls, tag in ((0, "neg"), (1, "pos")):
            hit = F.col(label) == cls
            aggs.append(ratio(F.sum(F.when(hit, F.col(f"_s_{c}"))), F.sum(F.when(hit, F.col(f"_n_{c}"))))
                        .alias(f"{c}__{tag}"))
    wide = joined.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}__neg`, `{c}__pos`" for c in features)
    return wide.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, neg, pos)")


def code_distribution(history: DataFrame, target: DataFrame, code_col: str, key: str = "id",
                      label: str = "flag") -> DataFrame:
    """P(code | class) in percent (A9, A10): codes sorted, NULL codes dropped, a code absent from a class
    counts 0, and each class is divided by its own non-null total."""
    per_key = (history.where(F.col(code_col).isNotNull())
               .groupBy(key, code_col).agg(F.count(F.lit(1)).alias("_n")))
    counts = (per_key.join(target, key, "inner")
              .groupBy(F.col(code_col).alias("code"))
              .pivot(label, [0, 1]).agg(F.sum("_n")))
    counts = counts.select("code", F.coalesce(F.col("0"), F.lit(0)).cast("long").alias("n_neg"),
                           F.coalesce(F.col("1"), F.lit(0)).cast("long").alias("n_pos"))
    tot_neg = counts.select(F.sum("n_neg")).scalar()
    tot_pos = counts.select(F.sum("n_pos")).scalar()
    return (counts.select(F.lit(code_col).alias("feature"), "code", "n_neg", "n_pos",
                          (F.col("n_neg") * F.lit(100.0) / tot_neg).alias("neg_pct"),
                          (F.col("n_pos") * F.lit(100.0) / tot_pos).alias("pos_pct"))
            .orderBy("code"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column in one pass, only columns that have nulls."""
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = wide.selectExpr("__rows AS row_count", f"stack({len(df.columns)}, {pairs}) AS (column_name, null_count)")
    return (long.where(F.col("null_count") > 0)
            .select("column_name", "null_count", "row_count",
                    F.lit(len(df.columns)).alias("column_count")))
