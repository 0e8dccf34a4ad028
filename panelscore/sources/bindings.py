"""Roles of the engine bound to the generated test tables.

history A  lineitem: id = l_orderkey, rn = row number within the order in tie-break order (1, 2, 3, ... per
           client, as in the reference); coded features from the line columns.
history B  events: id = user_id, rn = row number within the user in (ts, event_id) order.
           The window behind both shares its exchange with the fold, in parts whose number follows the rows. A history whose key may be hot is numbered by a
           global rank instead, which is unique and consecutive within a key too and needs no window per key.
target     orders: id = o_orderkey, flag = 1 for priority '1-URGENT'.
scores     orders: o_totalprice / max(o_totalprice); predictions floor it to 1/1000 so that ties occur.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.fold import FoldSpec
from ..operators.ordered import with_global_rank
from .io import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LINEITEM_ORDER = ("id", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
LINEITEM_SPEC = FoldSpec(key="id", seq="rn", trend=("qty", "disc"), recent=("qty", "disc", "rflag"),
                         recent_n=3)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENTS_SPEC = FoldSpec(key="id", seq="rn", trend=("value",), recent=("value", "etype"), recent_n=3)


def lineitem_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the order key as ``id``, the tie-break columns and the coded features."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("id"),  # rename before ranking (SURVEY T1b)
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        F.col("l_quantity").cast("int").alias("qty"),
        F.round(F.col("l_discount") * 100).cast("int").alias("disc"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
         .when(F.col("l_returnflag") == "R", 2).alias("rflag"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("lstatus"),
    )


LINEITEM_FEATURES = ("qty", "disc", "tax", "price", "rflag", "lstatus")


def history_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of history A (the footers answer it)."""
    return table(spark, sf_dir, "lineitem").count()


def lineitem_history(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """History A. ``sparse`` turns zero discount and zero tax into NULL codes ("none given")."""
    coded = lineitem_coded(spark, sf_dir)
    if sparse:
        coded = coded.withColumns({"disc": F.expr("nullif(disc, 0)"), "tax": F.expr("nullif(tax, 0)")})
    rn = F.row_number().over(Window.partitionBy("id").orderBy(*LINEITEM_ORDER[1:]))
    return spread(coded, "id", history_rows(spark, sf_dir)).select("id", rn.cast("long").alias("rn"), *LINEITEM_FEATURES)


def events_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    codes = F.array(*[F.lit(t) for t in EVENT_TYPES])
    coded = ev.select(F.col("user_id").alias("id"), "ts", "event_id", "value",
                      F.array_position(codes, F.col("event_type")).cast("int").alias("etype"))
    rn = F.row_number().over(Window.partitionBy("id").orderBy("ts", "event_id"))
    return spread(coded, "id", ev.count()).select("id", rn.cast("long").alias("rn"), "value", "etype")


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("flag"))


def _price_share(o: DataFrame) -> F.Column:
    top = o.select(F.max("o_totalprice")).scalar()
    return F.col("o_totalprice") / top


def orders_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y_true, y_score): a deterministic score with ties, the input of every metric operator."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("y_true"),
                    (F.floor(_price_share(o) * 1000) / 1000).alias("y_score"))


def orders_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, score) for every order: the submission of a model that ranks by order value."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), _price_share(o).alias("score"))


SCORING_FROM = "1999-01-01"


def clients_by_date(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders placed before ``SCORING_FROM`` (to learn from) and later ones (to score), as ids."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderdate") < F.lit(SCORING_FROM).cast("timestamp_ntz")).alias("old"))
    return o.where("old").select("id"), o.where("NOT old").select("id")


def value_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, flag): flag = 1 for orders whose discounted line value is over 1.5 times the mean. Unlike the priority, which is
    independent of the lines in the generated tables, it can be learned from the history."""
    li = table(spark, sf_dir, "lineitem")
    value = li.groupBy(F.col("l_orderkey").alias("id")).agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"))
    mean = value.select(F.avg("v")).scalar()
    return value.select("id", (F.col("v") > 1.5 * mean).cast("int").alias("flag"))


# Gate scenarios. Each is a realistic defect that the data itself produces, not an injected one:
# scoring only the clients that have a history misses the orders without lines; scoring at line grain
# repeats ids; an unscaled linear score leaves [0, 1].

def history_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys of history A (orders that have at least one line)."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()


def history_client_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_scores(spark, sf_dir).join(history_clients(spark, sf_dir), "id", "left_semi")


def line_grain_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    top = li.select(F.max("l_extendedprice")).scalar()
    return li.select(F.col("l_orderkey").alias("id"), (F.col("l_extendedprice") / top).alias("score"))


def unscaled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised order value: a linear score that was never squashed into [0, 1]."""
    o = table(spark, sf_dir, "orders")
    mean = o.select(F.avg("o_totalprice")).scalar()
    sd = o.select(F.stddev_samp("o_totalprice")).scalar()
    return o.select(F.col("o_orderkey").alias("id"), ((F.col("o_totalprice") - mean) / sd).alias("score"))


HOT_KEY = -1


def lineitem_history_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History A with every returned line (l_returnflag 'R', about a third of all lines) filed under one
    pseudo-client ``HOT_KEY``: a key holding a third of all rows, made by the data itself. Its sequence
    follows (original order key, tie-break)."""
    coded = lineitem_coded(spark, sf_dir).withColumn("src", F.col("id")).withColumn(
        "id", F.when(F.col("rflag") == 2, F.lit(HOT_KEY).cast("long")).otherwise(F.col("id")))
    ranked = with_global_rank(coded, ["id", "src", *LINEITEM_ORDER[1:]], out="rn",
                              keep=["id", *LINEITEM_FEATURES])
    return ranked.select("id", "rn", *LINEITEM_FEATURES)


def lineitem_history_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hot history with the pseudo-client's key missing (NULL for a third of all rows), and no sequence number
    for the lines that have neither discount nor tax."""
    h = lineitem_history_hot(spark, sf_dir)
    return h.withColumns({"id": F.when(F.col("id") != HOT_KEY, F.col("id")), "rn": F.when((F.col("disc") + F.col("tax")) > 0, F.col("rn"))})


def unscaled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y_true, y_score) with the standardised order value, cubed, as score: negative values and a thin upper tail."""
    s = unscaled_scores(spark, sf_dir).join(orders_target(spark, sf_dir), "id")
    return s.select("id", F.col("flag").alias("y_true"), (F.floor(F.col("score") * F.col("score") * F.col("score") * 1000) / 1000).alias("y_score"))


def with_file_order(sub: DataFrame) -> DataFrame:
    """``sub`` (read from part files) with ``misplaced``: 1 for rows that break the id order of the files as written."""
    read = sub.select("*", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_row"))
    name = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")
    read = read.withColumn("_part", name)
    ends = read.groupBy("_part").agg(F.max("id").alias("_top"))  # one row per file
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("_part").alias("_p"), F.max("_top").over(before).alias("_under"))
    inside = Window.partitionBy("_part").orderBy("_row")
    late = (F.col("id") < F.lag("id").over(inside)) | (F.col("id") < F.col("_under"))
    return read.join(F.broadcast(ends), F.col("_part") == F.col("_p")).select("id", "score", F.coalesce(late.cast("int"), F.lit(0)).alias("misplaced"))
