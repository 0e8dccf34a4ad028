"""Registered queries: every operator of SURVEY §2 applied to the test tables.

Each function takes (spark, sf_dir) and returns a DataFrame whose column names equal those of the
matching DuckDB query in ``oracle.py``. Floating results that are sums of doubles are rounded to 6 digits
on both sides, because the order of summation differs between the engines.
"""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.numeric import round_doubles, round_report
from ..operators import boosting, fold, gates, metrics, models, profile, split
from ..session import work_path
from ..sources import bindings as B
from ..sources import io
from . import reports

REGISTRY: dict = {}


def query(name: str):
    def wrap(fn):
        REGISTRY[name] = fn
        return fn
    return wrap


# ---------------------------------------------------------------- mart

@query("client_mart")
def client_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the labelled client mart, lineitem history folded per order and joined to the target."""
    mart = fold.fold_history(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC)
    return round_doubles(label_mart(mart, B.orders_target(spark, sf_dir)))


def label_mart(mart: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Inner join of the mart with the target (J1). Both sides are keyed on ``key``; adaptive execution
    broadcasts the target when its measured size is below the broadcast threshold and otherwise joins
    by shuffle, so the plan holds when the target has billions of keys."""
    return mart.join(target, key, "inner")


@query("mart_base")
def mart_base(spark, sf_dir):
    spec = fold.FoldSpec(key="id", seq="rn", trend=(), recent=())
    return round_doubles(fold.fold_history(B.lineitem_history(spark, sf_dir), spec))


@query("mart_trend")
def mart_trend(spark, sf_dir):
    m = fold.fold_history(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC)
    return round_doubles(m.select("id", "rn_cnt", "qty_trend", "disc_trend"))


@query("mart_bucketed")
def mart_bucketed(spark, sf_dir):
    """The mart from a canonical layer that is bucketed by client and sorted by sequence number (S3, S7): no exchange before the aggregate.
    Eight buckets, and more as the rows ask for."""
    buckets = io.parts_for(B.history_rows(spark, sf_dir), 8)
    layer = io.write_bucketed(B.lineitem_history(spark, sf_dir), work_path(spark, "bucketed-history"), "id", ["id", "rn"], buckets)
    return round_doubles(fold.fold_history(layer, B.LINEITEM_SPEC))


@query("mart_recent")
def mart_recent(spark, sf_dir):
    m = fold.fold_history(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC)
    return round_doubles(m.select("id", "qty_recent3", "disc_recent3", "rflag_recent3"))


@query("mart_segmented")
def mart_segmented(spark, sf_dir):
    """The same mart with 4-number segments, so most orders span several segments (skew path)."""
    spec = fold.FoldSpec(key="id", seq="rn", trend=("qty", "disc"), recent=("qty", "disc", "rflag"),
                         recent_n=3, segment=4)
    return round_doubles(fold.fold_history(B.lineitem_history(spark, sf_dir), spec, strategy="segmented"))


@query("mart_hot_key")
def mart_hot_key(spark, sf_dir):
    """A third of all rows under one key: ``auto`` measures it and takes the segmented (skew-safe) plan
    once the key exceeds the 4,096-row segment."""
    spec = fold.FoldSpec(key="id", seq="rn", trend=("qty", "disc"), recent=("qty", "disc", "rflag"),
                         recent_n=3, segment=4096)
    return round_doubles(fold.fold_history(B.lineitem_history_hot(spark, sf_dir), spec))


@query("history_steps")
def history_steps(spark, sf_dir):
    return fold.with_steps(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC).select(
        "id", "rn", "qty", "disc", "rn_max", "qty_step", "disc_step")


@query("history_steps_segmented")
def history_steps_segmented(spark, sf_dir):
    """Row-level steps through the skew-safe plan, 4-number segments."""
    spec = fold.FoldSpec(key="id", seq="rn", trend=("qty", "disc"), recent=(), segment=4)
    return fold.with_steps(B.lineitem_history(spark, sf_dir), spec, strategy="segmented").select(
        "id", "rn", "qty", "disc", "rn_max", "qty_step", "disc_step")


@query("events_mart")
def events_mart(spark, sf_dir):
    """History B: event streams per user folded with the same operator."""
    return round_doubles(fold.fold_history(B.events_history(spark, sf_dir), B.EVENTS_SPEC))


@query("mart_labeled")
def mart_labeled(spark, sf_dir):
    m = fold.fold_history(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC)
    return round_doubles(label_mart(m, B.orders_target(spark, sf_dir)).select("id", "rn_cnt", "flag"))


@query("sequence_duplicates")
def sequence_duplicates(spark, sf_dir):
    """Uniqueness check of (id, rn) (H5) on the raw line number: orders reuse l_linenumber."""
    li = B.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"),
                                                    F.col("l_linenumber").alias("rn"))
    return fold.duplicate_sequences(li, "id", "rn")


def _null_spec():
    return fold.FoldSpec(key="id", seq="rn", trend=("qty", "disc"), recent=("qty", "disc", "rflag"), recent_n=3, segment=1024)


@query("mart_null_keys")
def mart_null_keys(spark, sf_dir):
    """A third of all rows under a NULL key, some without a sequence number: more rows than a segment, so ``auto`` takes the
    segmented plan."""
    return round_doubles(fold.fold_history(B.lineitem_history_nulls(spark, sf_dir), _null_spec()))


@query("steps_null_keys")
def steps_null_keys(spark, sf_dir):
    return fold.with_steps(B.lineitem_history_nulls(spark, sf_dir), _null_spec()).select(
        "id", "rn", "qty", "disc", "rn_max", "qty_step", "disc_step")


@query("mart_nulls")
def mart_nulls(spark, sf_dir):
    """The mart over a history with NULL codes: means skip them, ``last`` keeps them, steps skip them."""
    return round_doubles(fold.fold_history(B.lineitem_history(spark, sf_dir, sparse=True), B.LINEITEM_SPEC))


# ---------------------------------------------------------------- profiling

def _lines(spark, sf_dir):
    return B.lineitem_coded(spark, sf_dir).select("id", *B.LINEITEM_FEATURES)


@query("class_balance")
def class_balance(spark, sf_dir):
    return profile.class_balance(B.orders_target(spark, sf_dir))


@query("class_balance_sql")
def class_balance_sql(spark, sf_dir):
    """The same block through temp views and Spark SQL text."""
    views = io.register_views({"train_target": B.orders_target(spark, sf_dir)})
    return spark.sql(f"""
        SELECT flag, COUNT(*) AS n, COUNT(*) * 100.0D / SUM(COUNT(*)) OVER () AS share_pct
        FROM {views['train_target']} GROUP BY flag ORDER BY flag""")


@query("default_rate")
def default_rate(spark, sf_dir):
    return profile.default_rate(B.orders_target(spark, sf_dir))


@query("history_length")
def history_length(spark, sf_dir):
    return profile.history_length(_lines(spark, sf_dir))


@query("history_summary")
def history_summary(spark, sf_dir):
    return round_doubles(profile.history_summary(profile.history_length(_lines(spark, sf_dir))))


@query("history_histogram")
def history_histogram(spark, sf_dir):
    return profile.capped_histogram(profile.history_length(_lines(spark, sf_dir)), cap=40)


@query("rate_by_history_len")
def rate_by_history_len(spark, sf_dir):
    lengths = profile.history_length(_lines(spark, sf_dir))
    return round_doubles(profile.rate_by_length(lengths, B.orders_target(spark, sf_dir), cap=20))


@query("feature_means_by_class")
def feature_means_by_class(spark, sf_dir):
    return round_doubles(profile.feature_means_by_class(
        _lines(spark, sf_dir), B.orders_target(spark, sf_dir), list(B.LINEITEM_FEATURES)))


@query("code_distribution")
def code_distribution(spark, sf_dir):
    lines, target = _lines(spark, sf_dir), B.orders_target(spark, sf_dir)
    parts = [profile.code_distribution(lines, target, c) for c in ("rflag", "disc")]
    return round_doubles(parts[0].unionByName(parts[1]))


@query("null_profile")
def null_profile(spark, sf_dir):
    sparse = B.lineitem_coded(spark, sf_dir).select(
        "id", *[F.expr(f"nullif({c}, 0)").alias(c) if c in ("disc", "tax") else F.col(c)
                for c in B.LINEITEM_FEATURES])
    return profile.null_profile(sparse)


# ---------------------------------------------------------------- split and weights

@query("hash_split")
def hash_split(spark, sf_dir):
    return split.hash_split(B.orders_target(spark, sf_dir)).select("id", "u", "is_valid")


@query("split_report")
def split_report(spark, sf_dir):
    return round_doubles(split.split_report(split.hash_split(B.orders_target(spark, sf_dir))))


@query("class_weights")
def class_weights(spark, sf_dir):
    return split.class_weights(B.orders_target(spark, sf_dir))


@query("row_weights")
def row_weights(spark, sf_dir):
    """Per-row weights on the train part, class sizes counted before the split as in the reference."""
    target = B.orders_target(spark, sf_dir)
    train = split.hash_split(target).where(~F.col("is_valid"))
    return split.with_class_weights(train, counted_on=target).select("id", "flag", "w")


@query("random_split")
def random_split(spark, sf_dir):
    """Validation part of the seeded random split by key (M4), the same whatever the number of partitions."""
    _, valid = split.random_split(B.orders_target(spark, sf_dir).repartition(7))
    return valid


# ---------------------------------------------------------------- metrics

def _preds(spark, sf_dir):
    return B.orders_predictions(spark, sf_dir)


@query("roc_curve")
def roc_curve(spark, sf_dir):
    return metrics.roc_curve(_preds(spark, sf_dir))


@query("pr_curve")
def pr_curve(spark, sf_dir):
    return metrics.pr_curve(_preds(spark, sf_dir))


@query("ks_curve")
def ks_curve(spark, sf_dir):
    return metrics.ks_curve(_preds(spark, sf_dir))


@query("score_metrics")
def score_metrics(spark, sf_dir):
    return round_doubles(metrics.metric_record(_preds(spark, sf_dir), "price_share"))


@query("ks_stat")
def ks_stat(spark, sf_dir):
    return metrics.ranking_metrics(_preds(spark, sf_dir)).select("ks", "ks_threshold")


@query("score_summary")
def score_summary(spark, sf_dir):
    return round_doubles(metrics.score_summary(_preds(spark, sf_dir)))


@query("confusion_at_ks")
def confusion_at_ks(spark, sf_dir):
    return metrics.confusion_at_ks(_preds(spark, sf_dir))


@query("score_histogram")
def score_histogram(spark, sf_dir):
    return metrics.score_histogram(_preds(spark, sf_dir))


@query("score_histogram_sparse")
def score_histogram_sparse(spark, sf_dir):
    """Unscaled scores: negative ones are in no bin, and bins stay empty in the thin upper tail."""
    return metrics.score_histogram(B.unscaled_predictions(spark, sf_dir))


@query("score_percentiles")
def score_percentiles(spark, sf_dir):
    probs = [0.5, 0.9, 0.99]
    valid = metrics.exact_percentiles(_preds(spark, sf_dir), "y_score", probs)
    test = metrics.exact_percentiles(B.orders_scores(spark, sf_dir), "score", probs)
    return (valid.select(F.lit("valid").alias("part"), "p", "value")
            .unionByName(test.select(F.lit("test").alias("part"), "p", "value")))


@query("calibration")
def calibration(spark, sf_dir):
    return round_doubles(metrics.calibration_table(_preds(spark, sf_dir)))


# ---------------------------------------------------------------- scans and sinks

@query("ingest_history")
def ingest_history(spark, sf_dir):
    """Parquet parts matched by a file-name glob in the table folder, copied into the canonical layer and read back."""
    out, _ = io.ingest_parquet(spark, sf_dir, work_path(spark, "history"), glob="lineitem*.parquet")
    return out


@query("ingest_target")
def ingest_target(spark, sf_dir):
    """The target as CSV (written by Spark from orders), loaded with its declared schema."""
    csv = work_path(spark, "target-csv")
    io.write_counted(B.orders_target(spark, sf_dir), csv, fmt="csv", header=True)
    out, _ = io.ingest_target(spark, csv, work_path(spark, "target"), io.target_schema())
    return out


@query("ingest_counts")
def ingest_counts(spark, sf_dir):
    """Rows of each ingested table as the ingest returns them (``loaded``), beside a count of the copy."""
    parts = []
    for name in ("lineitem", "orders"):
        copy, loaded = io.ingest_parquet(spark, f"{sf_dir}/{name}.parquet", work_path(spark, name))
        parts.append(copy.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")).withColumn("loaded", F.lit(loaded).cast("long")))
    return parts[0].unionByName(parts[1])


@query("mart_materialized")
def mart_materialized(spark, sf_dir):
    """The labelled mart computed once and copied from the written table (S7); the copy is read back."""
    copy = work_path(spark, "mart-copy")
    io.materialize(spark, client_mart(spark, sf_dir), work_path(spark, "mart"), copy_path=copy)
    return spark.read.parquet(copy)


@query("compact_types")
def compact_types(spark, sf_dir):
    """The written mart read back as one multi-file scan and narrowed to float/int."""
    out, _ = io.materialize(spark, mart_base(spark, sf_dir), work_path(spark, "mart-base"))
    return io.compact_types(out)


@query("submission_csv")
def submission_csv(spark, sf_dir):
    """Scores sorted by id into a headed CSV and scanned back (S12, S13, O2). ``misplaced`` counts the rows of a
    part file whose id is under an earlier row's or under the largest of the earlier files (0: the written order is total)."""
    path = work_path(spark, "submission")
    io.write_submission_csv(B.orders_scores(spark, sf_dir), path)
    return B.with_file_order(io.read_submission_csv(spark, path))


@query("predictions_sink")
def predictions_sink(spark, sf_dir):
    path = work_path(spark, "predictions")
    io.write_predictions(B.orders_predictions(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("report_json")
def report_json(spark, sf_dir):
    """The metric record written as JSON and read back."""
    path = work_path(spark, "report")
    record = round_doubles(metrics.metric_record(B.orders_predictions(spark, sf_dir), "price_share"))
    io.write_report(record, path)
    return io.read_report(spark, path, record.schema)


# ---------------------------------------------------------------- gates (Q1-Q13)

@query("gate_format")
def gate_format(spark, sf_dir):
    path = work_path(spark, "submission")
    io.write_submission_csv(B.orders_scores(spark, sf_dir), path)
    return gates.format_check(io.read_submission_csv(spark, path))


@query("gate_rows")
def gate_rows(spark, sf_dir):
    return gates.row_counts(B.history_client_scores(spark, sf_dir), B.orders_target(spark, sf_dir))


@query("gate_duplicates")
def gate_duplicates(spark, sf_dir):
    return gates.duplicate_count(B.line_grain_scores(spark, sf_dir))


@query("gate_missing_ids")
def gate_missing_ids(spark, sf_dir):
    return gates.missing_ids(B.history_client_scores(spark, sf_dir), B.orders_target(spark, sf_dir))


@query("gate_extra_ids")
def gate_extra_ids(spark, sf_dir):
    return gates.extra_ids(B.orders_scores(spark, sf_dir), B.history_clients(spark, sf_dir))


@query("gate_score_values")
def gate_score_values(spark, sf_dir):
    return gates.score_values(B.unscaled_scores(spark, sf_dir))


@query("gate_unique_ratio")
def gate_unique_ratio(spark, sf_dir):
    full = gates.unique_ratio(B.orders_scores(spark, sf_dir))
    floored = gates.unique_ratio(B.orders_predictions(spark, sf_dir), score="y_score")
    return (full.select(F.lit("score").alias("part"), "unique_ratio")
            .unionByName(floored.select(F.lit("floored").alias("part"), "unique_ratio")))


@query("gate_drift")
def gate_drift(spark, sf_dir):
    return round_doubles(gates.mean_drift(B.orders_scores(spark, sf_dir), B.orders_predictions(spark, sf_dir)))


@query("gate_report")
def gate_report(spark, sf_dir):
    rep = gates.gate_report(B.history_client_scores(spark, sf_dir), B.orders_target(spark, sf_dir),
                            B.orders_predictions(spark, sf_dir))
    return round_doubles(rep)


@query("gate_report_empty")
def gate_report_empty(spark, sf_dir):
    """Nothing was scored (no order has a negative price share): no duplicates, every client missing."""
    return round_doubles(gates.gate_report(B.orders_scores(spark, sf_dir).where("score < 0"), B.orders_target(spark, sf_dir), None))


@query("gate_report_columns")
def gate_report_columns(spark, sf_dir):
    """Right scores under a third column: the column list is an error of the report (Q1, Q11)."""
    sub = B.orders_scores(spark, sf_dir).withColumn("source", F.lit("model"))
    return gates.gate_report(sub, B.orders_target(spark, sf_dir), None).select("rows", "duplicates", "errors", "passed")


@query("rounded_report")
def rounded_report(spark, sf_dir):
    """Report rounding (F5) of every order's price share and total at 2 to 5 digits."""
    o = B.orders_scores(spark, sf_dir).join(B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice"), "id")
    return o.select("id", *[round_report(F.col("score"), d).alias(f"s{d}") for d in (3, 5)], round_report(F.col("o_totalprice") / 100, 3).alias("p3"),
                    round_report(F.col("o_totalprice") / 8, 1).alias("p1"))


@query("gates_no_valid")
def gates_no_valid(spark, sf_dir):
    """Without validation scores the drift check is skipped with a warning."""
    return round_doubles(gates.gate_report(B.orders_scores(spark, sf_dir), B.orders_target(spark, sf_dir), None))


# ---------------------------------------------------------------- models
# ``feature_importance``, ``gbt_scores``, ``score_test`` and ``model_comparison`` boost to the models' own limits and patience. The queries that show single trees and rounds
# (``gbt_trees``, ``gbt_history``, ``gbt2_scores``, ``boosted_comparison``) fit ML_ROUNDS of them.

ML_ROUNDS = 10
#: a patience that the early-stopping query spends, and a rate at which its metric stops getting better
EARLY = {"rate": 1.0, "patience": 2}


def _ml_input(spark, sf_dir, mart=None, finish=lambda df: df) -> DataFrame:
    """The labelled mart (or ``mart``) with the hash split, written once (after ``finish``) and read back (S7) for iterative training."""
    mart = fold.fold_history(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC) if mart is None else mart
    labelled = split.hash_split(label_mart(mart, B.value_target(spark, sf_dir))).drop("u")
    out, _ = io.materialize(spark, finish(labelled), work_path(spark, "ml-input"))
    return out


def _rounded(spark, data) -> DataFrame:
    """What boosting learns from, written once: features rounded to six digits, since means of the same rows are the same value in any engine then."""
    return io.materialize(spark, round_doubles(data), work_path(spark, "ml-rounded"))[0]


def _features(df):
    return models.model_features(df, exclude=("is_valid",))


def _baseline(spark, sf_dir, data=None):
    data = _ml_input(spark, sf_dir) if data is None else data
    train = split.with_class_weights(data.where(~F.col("is_valid")), counted_on=data)  # before the split (D4)
    return models.baseline_pipeline(_features(data)).fit(train), data.where(F.col("is_valid")), data


def _boosted(spark, sf_dir, settings, data=None, rounds=None, borders=None):
    """A boosted model and its validation rows; ``rounds``: a limit below the settings' own. ``data``: rounded (``_rounded``); ``borders``: those of its training rows (``_borders``)."""
    data = _ml_input(spark, sf_dir, finish=round_doubles) if data is None else data
    valid = data.where(F.col("is_valid"))
    return boosting.fit(_features(data), data.where(~F.col("is_valid")), valid, settings=settings, rounds=rounds, borders=borders, alone=boosting.ALONE if rounds is None else 0), valid


def _borders(data):
    """The borders of both boosted models, by their number."""
    return boosting.shared_borders(data.where(~F.col("is_valid")), _features(data), [boosting.PRIMARY.borders, boosting.COMPARISON.borders])


@query("assemble")
def assemble(spark, sf_dir):
    """The scaled vector (M1, M2), one row per client and feature, rounded to 6 digits."""
    data = _ml_input(spark, sf_dir)
    cols = _features(data)
    out = models.assemble(data, cols).select("id", vector_to_array("features").alias("v"))
    names = F.array(*[F.lit(c) for c in cols])
    return out.select("id", F.posexplode("v").alias("i", "value")).select("id", F.get(names, "i").alias("feature"), F.round("value", 6).alias("value"))


@query("baseline_scores")
def baseline_scores(spark, sf_dir):
    model, valid, _ = _baseline(spark, sf_dir)
    return models.score(model, valid)


@query("mllib_metrics")
def mllib_metrics(spark, sf_dir):
    model, valid, _ = _baseline(spark, sf_dir)
    m = models.binned_metrics(model, valid)
    return spark.createDataFrame([(m["roc_auc"], m["gini"], m["pr_auc_trapezoid"], valid.count())],
                                 "roc_auc double, gini double, pr_auc_trapezoid double, valid_rows long")


@query("baseline_gradient")
def baseline_gradient(spark, sf_dir):
    """Whether the baseline's coefficients are where the regularised loss has no slope (M3): one row per feature and the intercept."""
    model, _, data = _baseline(spark, sf_dir)
    train = split.with_class_weights(data.where(~F.col("is_valid")), counted_on=data)
    return models.baseline_gradient(model, train, _features(data)).select("feature", "at_optimum")


@query("binned_metrics")
def binned_metrics(spark, sf_dir):
    """Areas through 100 points of the curves of a score with about 1,000 distinct values (M5)."""
    return round_doubles(metrics.binned_areas(_preds(spark, sf_dir), bins=100))


@query("gbt_scores")
def gbt_scores(spark, sf_dir):
    """Validation scores of the leaf-wise model at its best round (M6, M8, M9)."""
    b, valid = _boosted(spark, sf_dir, boosting.PRIMARY)
    return round_doubles(boosting.score(b, valid)).withColumn("rounds", F.lit(b.rounds))


@query("gbt2_scores")
def gbt2_scores(spark, sf_dir):
    """Validation scores of the symmetric model at its best round (M7, M8, M9)."""
    b, valid = _boosted(spark, sf_dir, boosting.COMPARISON, rounds=ML_ROUNDS)
    return round_doubles(boosting.score(b, valid)).withColumn("rounds", F.lit(b.rounds))


def _split_rows(spark, model) -> DataFrame:
    """The splits of a model: (tree, path: root 1, children 2i and 2i + 1, feature, bin, gain, rows)."""
    rows = []
    for number, t in enumerate(model.trees):
        path = {0: 1}
        for i in range(len(t.feature)):  # children have higher numbers than their node
            if t.feature[i] >= 0:
                path[int(t.left[i])], path[int(t.right[i])] = 2 * path[i], 2 * path[i] + 1
                rows.append((number, path[i], model.features[t.feature[i]], int(t.bin[i]), float(t.gain[i]), int(t.rows[i])))
    return spark.createDataFrame(rows, "tree int, path long, feature string, bin int, gain double, rows long")


@query("gbt_trees")
def gbt_trees(spark, sf_dir):
    """Every split of the leaf-wise trees that are kept (M6): where, on which bin, with which regularised gain and how many rows."""
    b, _ = _boosted(spark, sf_dir, boosting.PRIMARY, rounds=ML_ROUNDS)
    return round_doubles(_split_rows(spark, b))


@query("gbt_history")
def gbt_history(spark, sf_dir):
    """Validation AUC after each round of both models (M8), and whether it is the round kept."""
    data = _ml_input(spark, sf_dir, finish=round_doubles)
    rows, borders = [], _borders(data)
    for name, settings in (("primary", boosting.PRIMARY), ("comparison", boosting.COMPARISON)):
        b, _ = _boosted(spark, sf_dir, settings, data, rounds=ML_ROUNDS, borders=borders[settings.borders])
        rows += [(name, i + 1, auc, i + 1 == b.rounds) for i, auc in enumerate(b.history)]
    return round_doubles(spark.createDataFrame(rows, "model string, round int, auc double, best boolean"), 9)


@query("gbt_early_stop")
def gbt_early_stop(spark, sf_dir):
    """A fit under the symmetric model's own limit of 1,500 rounds that its patience ends (M8): metric by round, best round, stopped early."""
    b, _ = _boosted(spark, sf_dir, replace(boosting.COMPARISON, **EARLY), rounds=boosting.COMPARISON.rounds)
    rows = [(i + 1, auc, b.rounds, b.trained < boosting.COMPARISON.rounds) for i, auc in enumerate(b.history)]
    return round_doubles(spark.createDataFrame(rows, "round int, auc double, best int, stopped boolean"), 9)


@query("score_test")
def score_test(spark, sf_dir):
    """Learns on the clients placed before ``B.SCORING_FROM`` and scores the later ones, in training column order (P3, M9), as a
    submission (id, score)."""
    old, new = B.clients_by_date(spark, sf_dir)
    mart = _rounded(spark, fold.fold_history(B.lineitem_history(spark, sf_dir), B.LINEITEM_SPEC))  # a client's row depends on its own lines: folded once for both
    b, _ = _boosted(spark, sf_dir, boosting.PRIMARY, _ml_input(spark, sf_dir, mart.join(old, "id", "left_semi")))
    return round_doubles(boosting.score(b, mart.join(new, "id", "left_semi"), label=None, out="score")).orderBy("id")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Share of all gain by feature, the 30 highest."""
    b, _ = _boosted(spark, sf_dir, boosting.PRIMARY)
    return round_doubles(boosting.feature_importance(spark, b, top=30))


@query("boosted_comparison")
def boosted_comparison(spark, sf_dir):
    """Exact metric rows of the two boosted models on the same hash-split validation rows."""
    data = _ml_input(spark, sf_dir, finish=round_doubles)
    records, borders = [], _borders(data)
    for name, settings in (("gbt_comparison", boosting.COMPARISON), ("gbt_primary", boosting.PRIMARY)):
        b, valid = _boosted(spark, sf_dir, settings, data, rounds=ML_ROUNDS, borders=borders[settings.borders])
        records.append((name, metrics.metric_record(boosting.score(b, valid), name)))
    return round_doubles(models.comparison(records))


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Saved and reloaded pipeline scores the validation rows identically."""
    model, valid, _ = _baseline(spark, sf_dir)
    path = work_path(spark, "baseline-model")
    models.save_model(model, path)
    before = models.score(model, valid, out="before")
    after = models.score(models.load_model(path), valid, label=None, out="after")
    return before.join(after, "id").select("id", (F.col("before") == F.col("after")).alias("same"))


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """Exact metric rows of the three models on the same hash-split validation rows."""
    base, valid, data = _baseline(spark, sf_dir)
    records = [("logistic_regression", metrics.metric_record(models.score(base, valid), "logistic_regression"))]
    data = _rounded(spark, data)
    borders = _borders(data)
    for name, settings in (("gbt_comparison", boosting.COMPARISON), ("gbt_primary", boosting.PRIMARY)):
        b, rounded = _boosted(spark, sf_dir, settings, data, borders=borders[settings.borders])
        records.append((name, metrics.metric_record(boosting.score(b, rounded), name)))
    return models.comparison(records)


# ---------------------------------------------------------------- reports in the reference's shapes

@query("eda_report")
def eda_report(spark, sf_dir):
    """The profile report, one row per figure."""
    rep = reports.eda_report(_lines(spark, sf_dir), B.orders_target(spark, sf_dir),
                             list(B.LINEITEM_FEATURES), ["rflag", "disc"])
    return reports.eda_rows(rep)


@query("metrics_report")
def metrics_report(spark, sf_dir):
    return reports.metrics_report(B.orders_predictions(spark, sf_dir), "price_share")


@query("submission_report")
def submission_report(spark, sf_dir):
    rep = reports.submission_report(B.orders_scores(spark, sf_dir), B.orders_target(spark, sf_dir),
                                    B.orders_predictions(spark, sf_dir))
    return rep.select("*", F.col("percentiles.valid").alias("valid_percentiles"), F.col("percentiles.test").alias("test_percentiles")).drop("percentiles")
