"""Train/validation split and class weights."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.splitmix import with_unit_hash

# The reference's split seed and validation share.
SPLIT_SEED = 42
VALID_FRACTION = 0.2


def hash_split(df: DataFrame, key: str = "id", seed: int = SPLIT_SEED,
               valid_fraction: float = VALID_FRACTION, flag: str = "is_valid") -> DataFrame:
    """Adds ``u`` (the key's hash in [0, 1)) and ``is_valid`` = u < valid_fraction.

    A pure function of the key: the same clients land in the same part whatever the row order,
    partitioning or number of files, and every model uses the same split (SURVEY D1). A NULL key has no hash
    and would fall out of both parts, so it fails the job."""
    key_or_fail = F.when(F.col(key).isNull(), F.raise_error(F.lit("NULL key in the table to split"))).otherwise(F.col(key))
    df = df.withColumn(key, key_or_fail)
    return with_unit_hash(df, key, seed, out="u").withColumn(flag, F.col("u") < F.lit(valid_fraction))


#: another stream of the hash than the shared split's, so that the two splits are independent
RANDOM_STREAM = 1 << 32


def random_split(df: DataFrame, key: str = "id", seed: int = SPLIT_SEED, valid_fraction: float = VALID_FRACTION) -> tuple[DataFrame, DataFrame]:
    """A seeded random split of rows into (train, valid) by key (M4). Spark's ``randomSplit`` draws by partition and place, so the same seed gives
    other rows for another number of files (SURVEY D1); here a row's part depends on its key and the seed alone."""
    hashed = hash_split(df, key, seed + RANDOM_STREAM, valid_fraction, "_part").drop("u")
    return hashed.where(~F.col("_part")).drop("_part"), hashed.where(F.col("_part")).drop("_part")


def split_report(df: DataFrame, label: str = "flag", flag: str = "is_valid") -> DataFrame:
    """Rows and positive share of each part."""
    return (df.groupBy(flag).agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("pos_share"))
            .orderBy(flag))


def class_weights(df: DataFrame, label: str = "flag") -> DataFrame:
    """Balanced weight n / (2 * n_class) per class (A18, P7): one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", ratio(total, F.col("n") * 2).alias("weight")).orderBy(label)


def with_class_weights(df: DataFrame, label: str = "flag", weight_col: str = "w",
                       counted_on: DataFrame | None = None) -> DataFrame:
    """Per-row balanced weight for a 0/1 label (P7). The class sizes are two scalar subqueries over
    ``counted_on`` (default: ``df`` itself, i.e. train rows only; pass the whole labelled table to count
    before the split as the reference does, SURVEY D4). A class that is absent gives NULL (H11)."""
    src = df if counted_on is None else counted_on
    n = src.select(F.count(F.lit(1))).scalar()
    pos = src.where(F.col(label) == 1).select(F.count(F.lit(1))).scalar()  # P4: filter reaches the scan
    w = F.when(F.col(label) == 1, ratio(n, pos * 2)).otherwise(ratio(n, (n - pos) * 2))
    return df.withColumn(weight_col, w)
