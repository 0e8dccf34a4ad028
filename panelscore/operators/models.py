"""Model operators on Spark ML (M1-M5, M9, M10, O4, P3, S9, S14, U3): the linear baseline, a Spark ML ``Pipeline`` trained on
the distributed mart. The boosted models are in ``boosting``.
"""
from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import metrics

# The reference's settings of its linear baseline.
BASELINE_PARAMS = {"maxIter": 50, "regParam": 0.01}


def model_features(df: DataFrame, key: str = "id", label: str = "flag", exclude=()) -> list[str]:
    """Every mart column but the key and the label, in table order (P1); saved with the model."""
    skip = {key, label, *exclude}
    return [c for c in df.columns if c not in skip]


def assembler(features: list[str], out: str = "features_raw") -> VectorAssembler:
    """M1: NULL/NaN kept as NaN."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """M1 + M2: assembled and scaled to unit deviation without centring."""
    raw = assembler(features).transform(df)
    return StandardScaler(inputCol="features_raw", outputCol="features", withMean=False).fit(raw).transform(raw)


def baseline_pipeline(features: list[str], label: str = "flag", weight: str | None = "w",
                      **overrides) -> Pipeline:
    """M3: assembler -> scaler -> weighted logistic regression."""
    params = {**BASELINE_PARAMS, **overrides}
    lr = LogisticRegression(featuresCol="features", labelCol=label, **params)
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[assembler(features),
                            StandardScaler(inputCol="features_raw", outputCol="features", withMean=False),
                            lr])


def score(model: PipelineModel, df: DataFrame, key: str = "id", label: str | None = "flag",
          out: str = "y_score") -> DataFrame:
    """M9: P(label = 1) per row; with a label the result is a prediction table (id, y_true, y_score)."""
    pred = model.transform(df)
    cols = [key]
    if label:
        cols.append(F.col(label).alias("y_true"))
    return pred.select(*cols, vector_to_array("probability")[1].alias(out))


def binned_metrics(model: PipelineModel, df: DataFrame, label: str = "flag", num_bins: int = 1000) -> dict:
    """M5 for a fitted model: the areas of ``metrics.binned_areas`` over its scores."""
    row = metrics.binned_areas(score(model, df, label=label), num_bins).first()
    return {k: row[k] for k in ("roc_auc", "gini", "pr_auc_trapezoid")}


def baseline_gradient(model: PipelineModel, train: DataFrame, features: list[str], label: str = "flag", weight: str | None = "w", bound: float = 1e-3) -> DataFrame:
    """M3's certificate of optimality: the gradient of the weighted, regularised loss at the returned coefficients, one row per feature and
    one for the intercept (coefficient, gradient, at_optimum: at most ``bound`` in size).

    The loss is the weighted mean of the log losses plus regParam / 2 times the squared coefficients, both in units of a feature's weighted standard
    deviation, in which the optimiser works. At its minimum the gradient is zero; it is one aggregate over the training rows."""
    lr = model.stages[-1]
    scaled = model.transform(train)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = scaled.select(w.alias("w"), (vector_to_array("probability")[1] - F.col(label)).alias("e"), vector_to_array("features").alias("x"))
    x = [F.col("x")[i] for i in range(len(features))]
    sums = [F.sum("w"), F.sum(F.col("w") * F.col("w")), F.sum(F.col("w") * F.col("e"))]
    for c in x:
        sums += [F.sum(F.col("w") * F.col("e") * c), F.sum(F.col("w") * c), F.sum(F.col("w") * c * c)]
    total, squares, error, *rest = rows.agg(*sums).first()
    out = [("(intercept)", float(lr.intercept), error / total)]
    for i, name in enumerate(features):
        g, mean, second = (v / total for v in rest[3 * i:3 * i + 3])
        deviation = max(0.0, (second - mean * mean) * total / (total - squares / total)) ** 0.5
        b = float(lr.coefficients[i])
        out.append((name, b, g / deviation + lr.getRegParam() * b * deviation if deviation > 0 else 0.0))
    frame = train.sparkSession.createDataFrame(out, "feature string, coefficient double, gradient double")
    return frame.withColumn("at_optimum", F.abs("gradient") <= bound)


def feature_importance(model: PipelineModel, features: list[str], top: int | None = 30) -> DataFrame:
    """|coefficient| per feature, descending."""
    values = [abs(v) for v in model.stages[-1].coefficients.toArray().tolist()]
    spark = SparkSession.active()
    df = spark.createDataFrame(list(zip(features, [float(v) for v in values])), "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def save_model(model: PipelineModel, path: str) -> None:
    """The fitted pipeline, feature order included (the assembler's input columns)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def comparison(records: list[tuple[str, DataFrame | None]]) -> DataFrame:
    """Metric rows of the models that exist, in the given order (absent models are skipped)."""
    present = [(i, df) for i, (_, df) in enumerate(records) if df is not None]
    if not present:
        raise ValueError("no model records")
    rows = [df.select(F.lit(i).alias("position"), *df.columns) for i, df in present]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy("position")
